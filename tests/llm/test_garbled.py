"""Wrongly decoded text: what is evident, what the corpus tells, and what is restored."""

import pytest

from skerry.llm.garbled import Usual, corpus_counts, evident, find_garbled, forms_of, garbled_keys, keys_and_wide, keys_of, punctuation_pair, restore_garbled, restore_text

CORRECT = [
    "CAÑON ½ DAY, £15; PÂTISSERIE", "À Ça « où » l’été — “fine” … 12 °C ±0.3", "São João, MANHÃ” e AMANHÃ…", "Größere „Lücken“ über Straße", "zażółć gęślą jaźń", "Tại ngoái độ vịnh ấm",
    "Температура воды; «В» ВПЕРЁД ТРЁХ Рёбра поезії фантазії", "Το νερό είναι ζεστό: 5 °C", "水温は平年より0.3度高い。", "卫星过境后9分钟", "Δt = 9 min, σ≈0.3 K, α, Ω, ∞, √2", "ｆｕｌｌ ﬁle glo​w t­he é", "👍🏽🌊🌡️", "│ 9.9 │ table", "Ærø, Ångström, Łódź, Çeşme, Đà Nẵng", "naïve coöperation", "", "plain",
]
ORIGINAL = ["12 °C", "isn’t", "café", "— not", "“quoted”", "Größere Lücken", "estação não", "błędny zegar", "Температура воды", "είναι ζεστό", "水温は高い", "卫星过境", "độ vịnh", "🌊 wave"]


def wrong(text, true, read):
    return text.encode(true).decode(read, "replace") if read != "latin-1" else text.encode(true).decode(read)


@pytest.mark.parametrize("text", CORRECT)
def test_correct_text_is_no_case(text):
    assert not evident(text)


@pytest.mark.parametrize("read", ["latin-1", "cp1252", "cp1250", "cp1251", "cp437", "cp850", "mac_roman", "cp866"])
@pytest.mark.parametrize("text", ORIGINAL)
def test_utf8_read_wrongly_is_evident(text, read):
    garbled = text.encode().decode(read, "ignore")
    if len(garbled.encode(read)) != len(text.encode()):
        pytest.skip("not readable in this encoding")
    assert evident(f"before {garbled} after")


@pytest.mark.parametrize("text", ["caf� here", "isn\x92t", "\x93quoted\x94", "íåâåðíûå ÷àñû", "êáôáãñáöÝáò", "¹ÊÕÏÔ­Òò¿ÉÄÜ"])
def test_other_evidence(text):
    assert evident(text)


def test_restoring():
    for text in ORIGINAL:
        assert restore_text(f"a {wrong(text, 'utf-8', 'latin-1')} b", {}) == f"a {text} b"
    twice = wrong(wrong("l’été — fine", "utf-8", "latin-1"), "utf-8", "latin-1")
    assert restore_text(twice, {}) == "l’été — fine"
    mixed = f"Größe bleibt, {wrong('über', 'utf-8', 'cp1252')} wird"
    assert restore_text(mixed, {}) == "Größe bleibt, über wird"


def corpus():
    good = ["La station a relevé la marée, l’écart était de 9.1 °C à la jetée.", "Сегодня датчик показал температуру воды", "It isn’t the sensor’s fault, 4 °C"]
    docs = [(i, good[i % 3]) for i in range(60)]
    bad = [wrong(good[0], "cp1252", "cp437"), wrong(good[1], "cp1251", "koi8-r"), wrong(good[2], "cp1252", "mac_roman"), wrong(good[1], "koi8-r", "cp1251")]
    return docs, [(100 + i, t) for i, t in enumerate(bad)]


def test_corpus_counts(spark, rows):
    docs, bad = corpus()
    rare = [(200, "Ærø ôstentatious Δ ш ù"), (201, None), (202, ""), (None, bad[0][1]), (203, "plain"), (100, bad[0][1]), (204, "д" * 100_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in docs + bad + rare], "doc_id long, text string, key string, n int")
    want = [(i,) for i, _ in bad]
    assert rows(find_garbled(df).select("doc_id")) == want
    assert rows(find_garbled(df, small=1).select("doc_id")) == want
    got = {r["key"]: (r["restored"], r["wrong"]) for r in garbled_keys(corpus_counts(df)[0]).where("strong").collect()}
    assert got["marΘe"][0] == "marée"
    for small in (200_000, 7):
        back = {r["doc_id"]: (r["restored"], r["complete"]) for r in restore_garbled(df, small=small).select("doc_id", "restored", "complete").collect()}
        assert set(back) == {i for i, _ in bad}
        assert back[100] == (docs[0][1], True) and back[101] == (docs[1][1], True) and back[103][0] == docs[1][1]
    assert find_garbled(df.limit(0)).count() == 0


def test_keys():
    assert keys_of("a 12.5 °C, x — 30 y") == {"°C", "x — 9", "—"}
    assert keys_of("— a\n  — ü") == {" — a", "a — ü", "— ü ", "—", "ü"}
    assert keys_and_wide("水温は平年より高い。été") == ({"été"}, {"水温は平年より高い"})
    assert keys_of("plain text") == set()


@pytest.mark.parametrize("read", ["latin-1", "cp1252", "cp437", "mac_roman", "cp850"])
@pytest.mark.parametrize("text", ["\ufeffHello", "word\u200bword", "a\u202fb", "cafe\u0301", "• first", "✔ done", "【注】", "한국어", "قياس", "מים", "ไทย", "हिन्दी"])
def test_marks_and_other_scripts_are_evident(text, read):
    garbled = text.encode().decode(read, "ignore")
    if len(garbled.encode(read)) != len(text.encode()):
        pytest.skip("not readable in this encoding")
    assert evident(f"before {garbled} after")
    assert restore_text(f"before {garbled} after", {}) == f"before {text} after"


@pytest.mark.parametrize("text", ["l’été\xa0» et café\xa0— fin", "дом\xa0— море\xa0— «где…» окно…»", "в\xa0«Правде» С\xa0другой Я\xa0был", "9 кН·м, 5 мМ±1, 5 кВА, Tagen\xa0öffnet, la\xa0écluse", "Í\xa0dag, AQUÍ…", "Ші, Чёрный, Шість", "قياس 5", "מים", "ไทย हिन्दी 한국어"])
def test_correct_typography_is_no_case(text):
    assert not evident(text)


def test_long_tokens_are_tried():
    good = "marée/" * 60 + "x"
    assert wrong(good, "cp1252", "cp437") in forms_of(good)


@pytest.mark.parametrize("read,true", [("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp1252", "mac_roman")])
def test_punctuation_of_plain_english(read, true):
    good = "It’s “fine” — the crew’s words… at 12 °C."
    bad = wrong(good, true, read)
    assert bad != good and punctuation_pair(bad) is not None and restore_text(bad, {}) == good


@pytest.mark.parametrize("text", ["El país y la estación, ahí; días fríos", "Il est là, voilà déjà où", "maíz, país, raíz — fin", "Fähre ù the", "ñ", "“fine” it’s", "ông thành gö"])
def test_accents_are_no_punctuation(text):
    assert punctuation_pair(text) is None


ZH = ["观测站的水温比去年同期略高", "海面上的风速逐渐减小", "仪器故障导致数据缺失", "卫星图像显示海岸附近有藻类", "渔民报告说潮水来得更早", "研究人员检查了所有的记录", "这个季节的温度变化很大", "浮标每小时发送一次数据"]
JA = ["観測所の水温は去年より少し高い", "海上の風は次第に弱くなった", "機器の故障でデータが失われた", "衛星の画像に海岸の藻が見える", "漁師は潮が早く来たと報告した", "研究者はすべての記録を調べた", "この季節の温度は大きく変わる", "ブイは毎時データを送っている"]


def one_sentence(lines, k):
    """A sentence that occurs once: halves of two lines."""
    a, b = lines[k % 8], lines[(k * 3 + 1) % 8]
    return a[: len(a) // 2] + b[len(b) // 2 :]


@pytest.mark.parametrize("lines,true,read", [(ZH, "gbk", "big5"), (ZH, "utf-8", "gbk"), (JA, "euc_jp", "gbk"), (JA, "euc_jp", "big5"), (JA, "cp932", "gbk"), (JA, "euc_jp", "euc_kr"), (JA, "utf-8", "cp932"), (ZH, "gbk", "euc_kr")])
def test_a_sentence_between_east_asian_encodings(lines, true, read):
    counts = {}
    for t in ZH + JA:
        for c in t:
            counts[c] = counts.get(c, 0) + 20
    usual, tried = Usual(counts), 0
    for k in range(8):
        good = one_sentence(lines, k)
        try:
            bad = good.encode(true).decode(read)
        except UnicodeError:
            continue
        tried += 1
        assert usual.pair(bad) is not None and restore_text(f"{bad}。{good}", {}, usual) == f"{good}。{good}"
        assert usual.pair(good) is None
    if not tried:
        pytest.skip("not readable in this encoding")


def test_a_source_with_a_third_of_all_rows_read_wrongly(spark, rows):
    words = ["für", "größer", "Küste", "Nähe", "während", "schön", "Möwe", "Wärme", "Böen", "Übergang"]
    good = [" ".join(words[(i + j) % 10] for j in range(5)) for i in range(60)]
    docs = [(i, wrong(t, "cp1252", "cp437") if i % 3 == 0 else t) for i, t in enumerate(good)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(find_garbled(df).select("doc_id")) == [(i,) for i in range(0, 60, 3)]
    assert rows(find_garbled(df, small=1).select("doc_id")) == [(i,) for i in range(0, 60, 3)]
    assert rows(restore_garbled(df).select("doc_id", "restored")) == [(i, good[i]) for i in range(0, 60, 3)]
