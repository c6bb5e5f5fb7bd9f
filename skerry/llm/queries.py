"""Queries p6 to p9 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skerry.llm.bpe import decode_ids, encode_texts
from skerry.llm.garbled import find_garbled, restore_garbled
from skerry.llm.leaks import find_leaks, remove_leaks
from skerry.llm.nearest import match_nearest
from skerry.operators.regular import finite
from skerry.runtime import table


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    obs = table(spark, d, "obs")
    m = match_nearest(table(spark, d, "overpass"), obs, right_ok=finite(F.col("value")))
    return m.select("overpass_id", "obs_id")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_texts(table(spark, d, "documents"))


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The texts after encoding and decoding."""
    return decode_ids(p7_ids(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_item")).select("item_id", "doc_id").distinct()


def p8_by_item(spark: SparkSession, d: str) -> DataFrame:
    """Documents and longest shared stretch of each leaked item."""
    f = find_leaks(table(spark, d, "documents"), table(spark, d, "eval_item"))
    return f.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("longest").cast("long").alias("longest"))


def p8_scrubbed(spark: SparkSession, d: str) -> DataFrame:
    """The documents without their leaked stretches."""
    return remove_leaks(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return find_garbled(table(spark, d, "documents")).select("doc_id")


def p9_restored(spark: SparkSession, d: str) -> DataFrame:
    """The garbled documents with their text restored as far as it can be."""
    return restore_garbled(table(spark, d, "documents")).select("doc_id", "restored", "complete")


P6_SQL = """
WITH o AS (SELECT DISTINCT overpass_id, trim(station_id, ' \t') AS s, epoch_us(time) AS t FROM overpass
           WHERE overpass_id IS NOT NULL AND station_id IS NOT NULL AND time IS NOT NULL),
     r AS (SELECT DISTINCT obs_id, trim(station_id, ' \t') AS s, epoch_us(time) AS t FROM obs
           WHERE obs_id IS NOT NULL AND time IS NOT NULL AND isfinite(value)),
     m AS (SELECT o.overpass_id, r.obs_id, row_number() OVER (PARTITION BY o.overpass_id ORDER BY abs(r.t - o.t), r.t, r.obs_id) AS n
           FROM o JOIN r ON o.s = r.s AND r.t BETWEEN o.t - 3600000000 AND o.t + 3600000000)
SELECT overpass_id, obs_id FROM m WHERE n = 1
"""

QUERIES = {"p6_found": p6_found, "p7_ids": p7_ids, "p7_decoded": p7_decoded, "p8_found": p8_found, "p8_by_item": p8_by_item, "p8_scrubbed": p8_scrubbed, "p9_found": p9_found, "p9_restored": p9_restored}
SQL = {"p6_found": P6_SQL, "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
