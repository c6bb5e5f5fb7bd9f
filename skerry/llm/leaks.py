"""Held-out evaluation texts that occur within training texts, by a generalised suffix automaton over words."""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from skerry.runtime import cut, spread

BITS = 1 << 27  # of the bitmap of the items' stretches

WORDS = regex.compile(r"[\p{L}\p{N}]+")
ASCII_WORDS = re.compile(r"[a-z0-9]+")
FORMAT = regex.compile(r"\p{Cf}+")


def words_of(text: str) -> list[str]:
    """Longest stretches of letters and digits after NFKC, full case folding and removal of format characters."""
    if text.isascii():
        return ASCII_WORDS.findall(text.lower())
    return WORDS.findall(FORMAT.sub("", unicodedata.normalize("NFKC", text).casefold()))


class Automaton:
    """Generalised suffix automaton of the items' words.

    ``items[s]``: the items that hold the words of state s. For a match of at least ``track`` words at a state, ``anchor`` is the
    state of its last ``track`` words: the items there are all that share these words.
    """

    def __init__(self, items: list[tuple[int, list[str]]], track: int) -> None:
        self.track = track
        self.code: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        own: list[set[int]] = [set()]
        self.words = {}
        for item, words in items:
            self.words[item] = len(words)
            last = 0
            for w in words:
                last = self._add(last, self.code.setdefault(w, len(self.code)), own)
                own[last].add(item)
        for s in sorted(range(1, len(self.len)), key=lambda s: -self.len[s]):
            if self.link[s] > 0:
                own[self.link[s]] |= own[s]
        self.items = [tuple(sorted(x)) for x in own]
        self.anchor = [0] * len(self.len)
        for s in sorted(range(1, len(self.len)), key=lambda s: self.len[s]):
            if self.len[s] >= track:
                up = self.link[s]
                self.anchor[s] = self.anchor[up] if self.len[up] >= track else s

    def _add(self, last: int, w: int, own: list[set[int]]) -> int:
        nxt, link, length = self.next, self.link, self.len

        def split(p: int, q: int) -> int:
            c = len(length)
            nxt.append(dict(nxt[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            own.append(set())
            link[q] = c
            while p >= 0 and nxt[p].get(w) == q:
                nxt[p][w] = c
                p = link[p]
            return c

        if w in nxt[last]:  # another item has been here
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else split(last, q)
        cur = len(length)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        own.append(set())
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else split(p, q)
        return cur

    def matches(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """(position of the last word, state, length) wherever the longest match has at least ``track`` words."""
        track = self.track
        if len(words) < track:
            return
        nxt, link, length, code = self.next, self.link, self.len, self.code.get
        s = n = 0
        for i, word in enumerate(words):
            w = code(word)
            if w is None:
                s = n = 0
                continue
            while s and w not in nxt[s]:
                s = link[s]
                n = length[s]
            to = nxt[s].get(w)
            if to is None:
                continue
            s, n = to, n + 1
            if n >= track:
                yield i, s, n

    def found(self, words: list[str]) -> dict[int, int]:
        """Items that share at least ``track`` words in a row with the text, with the longest such stretch."""
        best: dict[int, int] = {}
        for _, s, n in self.matches(words):
            while s > 0 and self.len[s] >= self.track:
                m = min(n, self.len[s])
                for item in self.items[s]:
                    if best.get(item, 0) < m:
                        best[item] = m
                if s == self.anchor[s]:
                    break
                s = self.link[s]
        return best

    def spans(self, words: list[str], least: int, share: float) -> list[tuple[int, int]]:
        """Stretches [from, to) of the text's words to remove: matches of ``least`` words, or of that share of an item."""
        out: list[tuple[int, int]] = []
        for i, s, n in self.matches(words):
            cut = n if n >= least else 0
            while not cut and s > 0 and self.len[s] >= self.track:
                m = min(n, self.len[s])
                if any(m >= share * self.words[x] for x in self.items[s]):
                    cut = m
                if s == self.anchor[s]:
                    break
                s = self.link[s]
            if cut:
                a = i + 1 - cut
                while out and out[-1][1] >= a:
                    a = min(a, out.pop()[0])
                out.append((a, i + 1))
        return out


def _segments(text: str) -> list[str]:
    """The text in the smallest parts that normalise independently: nothing composes or is reordered across their ends."""
    out: list[str] = []
    for c in text:
        own = unicodedata.normalize("NFKD", c)
        if out and (unicodedata.combining(own[0]) or not (c.isascii() and out[-1].isascii()) and unicodedata.normalize("NFKC", out[-1] + c) != unicodedata.normalize("NFKC", out[-1]) + unicodedata.normalize("NFKC", c)):
            out[-1] += c
        else:
            out.append(c)
    return out


def word_ranges(text: str) -> list[tuple[int, int]]:
    """Where the words of :func:`words_of` are in the text itself: [from, to). A character that normalises to several words
    (``½``) is in the range of each."""
    if text.isascii():
        return [m.span() for m in ASCII_WORDS.finditer(text.lower())]
    folded, where, at = [], [], 0
    for part in _segments(text):
        f = FORMAT.sub("", unicodedata.normalize("NFKC", part).casefold())
        folded.append(f)
        where += [(at, at + len(part))] * len(f)
        at += len(part)
    return [(where[m.start()][0], where[m.end() - 1][1]) for m in WORDS.finditer("".join(folded))]


def _cut_words(text: str, gone: bytes) -> tuple[str, int]:
    """The text without the marked ones of its words, and how many went: each stretch of them up to the next word that stays.
    A character shared with a word that stays is kept."""
    at = word_ranges(text)
    out, done, n, i = [], 0, 0, 0
    while i < len(at):
        j = i
        while j < len(at) and gone[j]:
            j += 1
        if j > i:
            a = max(at[i][0], at[i - 1][1] if i else 0)
            b = at[j][0] if j < len(at) else at[-1][1]
            if a < b:
                out.append(text[done:a])
                done = b
                n += sum(r[0] < b and r[1] > a for r in at[i:j])
        i = max(j, i + 1)
    return "".join([*out, text[done:]]), n


def words_in_pieces(text: str) -> list[str]:
    """The words of the blank-delimited pieces, in order: those that :func:`scrub` counts by."""
    return [w for p in regex.split(r"\s+", text) for w in words_of(p)]


def scrub(text: str, spans: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the leaked stretches [from, to) of its words, and how many words went. Blank-delimited pieces of nothing else go whole, with the
    blanks after; within other pieces only the words of a stretch go, with what divides them from the next word."""
    if not spans:
        return text, 0
    parts = regex.split(r"(\s+)", text)
    own = [words_of(p) for p in parts[::2]]
    gone = bytearray(sum(map(len, own)))
    for a, b in spans:
        gone[a:b] = b"\1" * (b - a)
    out, at, n = [], 0, 0
    for k, x in enumerate(own):
        here = gone[at : at + len(x)]
        if x and all(here):
            n += len(x)
        elif x or out or parts[2 * k]:
            left, m = _cut_words(parts[2 * k], here) if any(here) else (parts[2 * k], 0)
            out += [left, *parts[2 * k + 1 : 2 * k + 2]]
            n += m
        at += len(x)
    return "".join(out), n


_built: dict[str, Automaton] = {}


def _automaton_of(name: str, items: tuple[tuple[int, str], ...], track: int) -> Automaton:
    """The automaton of a broadcast set of items, built once a process."""
    if name not in _built:
        _built.clear()
        _built[name] = Automaton([(i, words_of(t)) for i, t in items], track)
    return _built[name]


def _hashes(words: list[str], n: int) -> list[int]:
    """64-bit hashes of all stretches of n words."""
    own = [xxhash.xxh3_64_intdigest(w) for w in words]
    size = len(words) - n + 1
    if size <= 0:
        return []
    at = np.array(own, np.uint64)
    h = np.zeros(size, np.uint64)
    for k in range(n):
        h = (h ^ at[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64).tolist()


def _windows(items: DataFrame, track: int) -> DataFrame:
    """``h, block``: the stretches of ``track`` words of the items of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(h, k) for k, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True) for h in _hashes(words_of(t), track)]
            h, k = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(k, pa.int32())], names=["h", "block"])

    return items.mapInArrow(run, "h long, block int").distinct()


def _by_blocks(docs: DataFrame, items: DataFrame, track: int, tell, schema: str, per_task: int) -> DataFrame:
    """``tell(automaton, row, text)`` of each document (``row, text``) with each block of items (``block, item_id, text``) that it shares
    a stretch of ``track`` words with.

    The hashes of the items' stretches make a bitmap of fixed size (16 MB), which tells the documents' stretches worth looking up;
    these are joined to the items' hashes, which gives the blocks that a document has to meet. A block's automaton is built where
    its documents are, ``per_task`` of them at a time; no task or driver holds all items.
    """
    spark = docs.sparkSession
    windows = cut(_windows(items, track))
    bit = F.pmod("h", F.lit(BITS))
    maps = windows.groupBy(F.expr(f"CAST(pmod(h, {BITS}) DIV 32768 AS INT)").alias("k")).agg(F.bitmap_construct_agg((bit % 32768).cast("long")).alias("bits"))
    bitmap = np.zeros(BITS // 8, np.uint8)
    for r in maps.toLocalIterator():  # at most 4,096 rows of 4 KB
        bitmap[r["k"] * 4096 : (r["k"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    sent = spark.sparkContext.broadcast(bitmap.tobytes())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(sent.value, np.uint8)
        for b in batches:
            rows, hits = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = np.array(_hashes(words_of(t), track), np.int64)
                at = h % BITS
                h = np.unique(h[(known[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0])
                rows += [i] * h.size
                hits += h.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(hits, pa.int64())], names=["row", "h"])

    meets = cut(docs.mapInArrow(look, "row long, h long").join(windows, "h").select("row", "block").distinct())
    tasks = meets.groupBy("block").agg(F.ceil(F.count("*") / per_task).cast("int").alias("tasks"))
    salted = docs.join(meets, "row").join(F.broadcast(tasks), "block").select("block", F.pmod(F.xxhash64("row"), "tasks").cast("int").alias("salt"), "row", "text")
    copies = items.join(F.broadcast(tasks), "block").select("block", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("salt"), "item_id", F.col("text").alias("item_text"))
    out = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(schema).fields])

    def run(d: pa.Table, i: pa.Table) -> pa.Table:
        if not d.num_rows or not i.num_rows:
            return out.empty_table()
        auto = Automaton([(x["item_id"], words_of(x["item_text"])) for x in i.select(["item_id", "item_text"]).to_pylist()], track)
        got = [r for x in d.select(["row", "text"]).to_pylist() for r in tell(auto, x["row"], x["text"])]
        return pa.Table.from_pylist([dict(zip(out.names, r, strict=True)) for r in got], out)

    return salted.groupBy("block", "salt").cogroup(copies.groupBy("block", "salt")).applyInArrow(run, schema)


def _items(items: DataFrame, ident: str, text: str, block_words: int) -> tuple[DataFrame, int]:
    """``block, item_id, text`` of the items, and in how many blocks they are."""
    i = items.select(F.col(ident).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(words_of(t)) for t in b.column(0).to_pylist())], pa.int64())], names=["n"])

    total = i.select("text").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_words) or 1
    return i.select(F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block"), "item_id", "text"), blocks


def _sent(items: DataFrame):
    """The items of the only block, broadcast under a name."""
    return items.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, tuple((r["item_id"], r["text"]) for r in items.orderBy("item_id", "text").collect())))


def find_leaks(docs: DataFrame, items: DataFrame, *, length: int = 13, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = 200_000, per_task: int = 20_000) -> DataFrame:
    """``item_id, doc_id, longest``: documents that hold ``length`` or more consecutive words of an item, each pair once a row.

    Words are those of :func:`words_of`. Documents stream past the automaton of the items, whole. Items of up to ``block_words`` words
    (counted) make one automaton, which goes to the tasks. More lie in blocks of about as many words, and each
    document meets only the blocks that it shares a stretch with, by hashes of all stretches (:func:`_by_blocks`). NULL and empty texts,
    and items shorter than ``length`` words, match nothing; a doc_id given twice comes out for each of its rows that match (with
    several blocks once for the doc_id); rows with a NULL doc_id are dropped.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    i, blocks = _items(items, item_id, item_text, block_words)
    if blocks > 1:
        found = _by_blocks(spread(d.withColumnRenamed("doc_id", "row")), i, length, lambda a, row, t: [(x, row, n) for x, n in a.found(words_of(t)).items()], "item_id long, doc_id long, longest int", per_task)
        return found.groupBy("item_id", "doc_id").agg(F.max("longest").alias("longest"))
    sent = _sent(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton_of(*sent.value, length)
        for b in batches:
            rows = [(i, d, n) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for i, n in auto.found(words_of(t)).items()]
            i, d, n = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(d, pa.int64()), pa.array(n, pa.int32())], names=["item_id", "doc_id", "longest"])

    return spread(d).mapInArrow(run, "item_id long, doc_id long, longest int")


def remove_leaks(docs: DataFrame, items: DataFrame, *, length: int = 13, share: float = 0.9, track: int = 8, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = 200_000, per_task: int = 20_000) -> DataFrame:
    """``doc_id, text, words_removed``: every document, without stretches of ``length`` words shared with an item, or of at least
    ``track`` words that make up ``share`` of an item. Untouched texts stay as they are, NULL stays NULL. Items in several blocks
    (see :func:`find_leaks`) first give the stretches of each text, which are then removed together."""
    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).cast("string").alias("text"))
    i, blocks = _items(items, item_id, item_text, block_words)
    schema = "doc_id long, text string, words_removed int"

    def scrubbed(b: pa.RecordBatch, spans_of) -> pa.RecordBatch:
        got = [(None, 0) if t is None else scrub(t, spans_of(k, t)) for k, t in enumerate(b.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([t for t, _ in got], pa.string()), pa.array([n for _, n in got], pa.int32())], names=["doc_id", "text", "words_removed"])

    if blocks > 1:
        out = out.withColumn("row", F.xxhash64("text"))  # equal texts have equal stretches
        texts = out.where("text IS NOT NULL").groupBy("row").agg(F.first("text").alias("text"))
        spans = _by_blocks(spread(texts), i, track, lambda a, row, t: [(row, *x) for x in a.spans(words_in_pieces(t), length, share)], "row long, a int, b int", per_task)
        spans = spans.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans"))

        def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                own = b.column(2).to_pylist()
                yield scrubbed(b, lambda k, t, own=own: [(x["a"], x["b"]) for x in own[k] or ()])

        return out.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(cut_out, schema)
    sent = _sent(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton_of(*sent.value, track)
        for b in batches:
            yield scrubbed(b, lambda k, t: auto.spans(words_in_pieces(t), length, share))

    return spread(out).mapInArrow(run, schema)
