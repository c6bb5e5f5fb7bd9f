"""Byte-pair encoding against the vocabulary's own library, and round trips."""

import os
import random

import pytest

from skerry.llm.bpe import VOCABULARIES, Encoder, decode_ids, encode_texts, encoder

PATH = os.path.join(VOCABULARIES, "byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files here")

TEXTS = ["", " ", "\n\n \t x", "Hello  world's it'll 1234 ...", "<|endoftext|>", "naïve café — “quoted” …", "水温は平年より高い。", "Το νερό είναι ζεστό", "👍🏽🌊", "a" * 5000, "海" * 3000, "​\xad﻿", "\x00\x01", "é", "x" * 70 + " " + "x" * 70]


@pytest.fixture(scope="module")
def enc():
    return Encoder(PATH)


def test_equals_the_library(enc):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(os.path.join(VOCABULARIES, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rnd = random.Random(0)
    texts = TEXTS + ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(160, 0x2000), rnd.randrange(0x3040, 0x9FFF), 32, 10])) for _ in range(rnd.randrange(200))) for _ in range(300)]
    for x in texts:
        assert enc.encode(x) == t.encode(x, add_special_tokens=False).ids, x[:50]


def test_every_token_is_reached_by_its_merges(enc):
    rnd = random.Random(1)
    for i in rnd.sample(sorted(enc.tokens), 3000):
        assert enc.merge(enc.tokens[i]) == [i]


def test_plain_merging_gives_the_same(enc):
    rnd = random.Random(2)
    for _ in range(200):
        word = bytes(rnd.choice(b"abcdefghilnoprstu ") for _ in range(rnd.randrange(1, 30)))
        sym = [enc.byte[b] for b in word]
        while True:
            pairs = [(enc.merged(a, b), i) for i, (a, b) in enumerate(zip(sym, sym[1:], strict=False)) if enc.merged(a, b) >= 0]
            if not pairs:
                break
            rank, i = min(pairs)
            sym[i : i + 2] = [rank]
        assert enc.merge(word) == sym


def test_frames(spark):
    data = [(i, t, "en", [i]) for i, t in enumerate(TEXTS)] + [(900, None, None, None), (None, "null id", "x", None), (3, TEXTS[3], "again", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, ids array<int>")
    got = encode_texts(df)
    assert got.columns == ["doc_id", "ids"]
    ids = [(r["doc_id"], r["ids"]) for r in got.collect()]
    assert len(ids) == len(data)
    by = dict(ids)
    assert by[900] == [] and by[0] == [] and by[3] == encoder(PATH).encode(TEXTS[3])
    back = {r["doc_id"]: r["text"] for r in decode_ids(got).collect()}
    assert all(back[i] == t for i, t in enumerate(TEXTS))
    assert encode_texts(df.limit(0)).count() == 0
