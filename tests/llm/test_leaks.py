"""Leaked passages against plain comparison of word sequences."""

import random

from skerry.llm.leaks import Automaton, find_leaks, remove_leaks, scrub, word_ranges, words_in_pieces, words_of


def test_words():
    assert words_of("It​s  the ｆｕｌｌ Straße—ﬁn, x2 ½ Δt_1") == ["its", "the", "full", "strasse", "fin", "x2", "1⁄2".replace("⁄", " ").split()[0], "2", "δt", "1"]
    assert words_of("Plain ASCII, with 12 words.") == ["plain", "ascii", "with", "12", "words"]
    assert words_of("") == []


def texts(rnd, n, words):
    return [[rnd.choice(words) for _ in range(rnd.randrange(0, n))] for _ in range(60)]


def test_automaton_against_plain_search():
    for seed in range(30):
        rnd = random.Random(seed)
        vocab = [f"w{k}" for k in range(rnd.choice([2, 3, 8]))]
        items = list(enumerate(texts(rnd, 25, vocab)[:12]))
        items += [(50, items[3][1]), (51, items[4][1][2:])]
        k = rnd.choice([1, 3, 5])
        a = Automaton(items, k)
        for doc in texts(rnd, 40, [*vocab, "other"])[:20]:
            want = {}
            for i, w in items:
                best = 0
                for p in range(len(doc)):
                    for q in range(len(w)):
                        n = 0
                        while p + n < len(doc) and q + n < len(w) and doc[p + n] == w[q + n]:
                            n += 1
                        best = max(best, n)
                if best >= k:
                    want[i] = best
            assert a.found(doc) == want


def without(text, automaton):
    return scrub(text, automaton.spans(words_in_pieces(text), 13, 0.9))


PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def test_frames_with_rows_of_any_kind(spark, rows):
    docs = [(1, f"Before. {PASSAGE.upper()}! After"), (2, PASSAGE.replace(" ", "   ")), (3, " ".join(PASSAGE.split()[:12])), (4, None), (5, ""), (None, PASSAGE), (1, "nothing"), (6, PASSAGE.replace("seven", "se­ven")), (7, "x " * 100_000 + PASSAGE), (8, PASSAGE.replace("seven", "se_ven"))]
    items = [(10, PASSAGE), (11, PASSAGE + " fifteen"), (12, "too short"), (13, None), (None, PASSAGE), (10, PASSAGE)]
    d = spark.createDataFrame([(*r, "t", 1) for r in docs], "doc_id long, text string, item_id string, longest int")
    i = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, doc_id int")
    want = sorted((item, doc) for doc in (1, 2, 6, 7) for item in (10, 11))
    assert rows(find_leaks(d, i).select("item_id", "doc_id")) == want
    assert rows(find_leaks(d, i, block_words=5).select("item_id", "doc_id")) == want
    assert {r[0] for r in find_leaks(d, i).select("longest").collect()} == {14}
    assert find_leaks(d.limit(0), i).count() == 0
    assert find_leaks(d, i.limit(0)).count() == 0
    assert {r[0] for r in find_leaks(d, i, block_words=5, per_task=1).select("longest").collect()} == {14}
    one = remove_leaks(d, i).select("doc_id", "text", "words_removed")
    assert rows(remove_leaks(d, i, block_words=5, per_task=2)) == rows(one)
    clean = {r["doc_id"]: r for r in remove_leaks(d.where("doc_id > 1"), i, block_words=5).collect()}
    assert clean[3]["text"] == docs[2][1] and clean[4]["text"] is None and clean[5]["text"] == ""
    assert clean[2]["text"] == "" and clean[2]["words_removed"] == 14
    assert clean[7]["text"].strip() == ("x " * 100_000).strip()


def test_scrub_keeps_the_rest():
    a = Automaton([(1, words_of(PASSAGE)), (2, words_of("a short but whole item of nine words"))], 5)
    got, n = without(f"Keep  this.\n{PASSAGE} And\tthat; a short but whole item of nine words end", a)
    assert got == "Keep  this.\nAnd\tthat; end" and n == 22
    assert without("one two three four five six", a) == ("one two three four five six", 0)


CHINESE = "海水温度、盐度、流速、风向、气压、湿度、云量、潮位、波高、能见度、降水、辐射、浊度、叶绿素"


def test_scrub_within_pieces():
    assert len(words_of(CHINESE)) == 14
    a = Automaton([(1, words_of(PASSAGE)), (2, words_of(CHINESE))], 8)
    assert without(f"今天的报告。{CHINESE}。明天再报。", a) == ("今天的报告。明天再报。", 14)
    for by in ",/_":
        assert without(f"a keep{by}{PASSAGE.replace(' ', by)}{by}stay b", a) == (f"a keep{by}stay b", 14)
    assert without(f"Ärger,{PASSAGE.replace('five', 'ｆｉ­ｖｅ')},Maß x", a) == ("Ärger, Maß x", 14)
    half = Automaton([(1, words_of(f"{PASSAGE} 1"))], 8)
    assert without(f"x,{PASSAGE},½", half) == ("x, ½", 14)


def test_word_ranges_are_those_words():
    rnd = random.Random(2)
    chars = "ab1 ,_éßİﬁ½가각ㄱㅏᄀ\u1161\u11a8ｶﾞが\u3099\u0301\u0315\u0323\u00ad\u200bΔσς海、。ﷺ②"
    for _ in range(3000):
        t = "".join(rnd.choice(chars) for _ in range(rnd.randrange(14)))
        got = word_ranges(t)
        assert len(got) == len(words_of(t))
        for (p, q), w in zip(got, words_of(t), strict=True):
            assert w in words_of(t[p:q]) and 0 <= p < q <= len(t)


def test_many_items_give_what_one_automaton_gives(spark, rows):
    rnd = random.Random(8)
    vocab = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(5, 60)))) for k in range(80)]
    docs = []
    for k in range(120):
        part = rnd.choice(items)[1].split()
        a = rnd.randrange(len(part))
        docs.append((k, " ".join([*(rnd.choice(vocab) for _ in range(30)), *part[a : a + rnd.randrange(30)], *(rnd.choice(vocab) for _ in range(20)), *rnd.choice(items)[1].split()])))
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = rows(find_leaks(d, i), "item_id", "doc_id", "longest")
    assert len(whole) > 100
    assert rows(find_leaks(d, i, block_words=300, per_task=10), "item_id", "doc_id", "longest") == whole
    assert rows(remove_leaks(d, i, block_words=300, per_task=10)) == rows(remove_leaks(d, i))
