"""Text decoded with a wrong character encoding: finding it, and restoring what can be restored.

Garbled sequences are precomputed and matched by multi-pattern automata:

* **UTF-8 read in a single-byte encoding** gives sequences that don't depend on the words. All are in one automaton. A match
  counts by itself where correct text can't look so: several restored characters in a row, or one whose parts break the case or
  the word around them. So do replacement characters, C1 controls and long runs of accented letters without a plain one.
* **All other pairs** turn one possible letter into another (``CAÃ‘ON``, ``isnÆt``, ``hß``), so there the sequences are those
  of the corpus's own words: every word known to the corpus is taken through all pairs of encodings, and the forms that occur
  go into a second automaton. A form counts by itself if its word is much better known; else three forms of one pair in a
  document have to agree.
* **Text between East Asian encodings** has no blanks and so no repeated words. A stretch counts if the characters it is restored to
  are much more usual, among those of their script in the corpus, than its own.
* **English punctuation** (apostrophes, quotes, dashes) in texts whose every character beyond ASCII stands where its image belongs.

Only matched spans are replaced; correct text beside them stays as it is.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.runtime import cut, spread

#: encodings that text may wrongly have been read in (single byte)
WRONG = ("latin-1", "cp1252", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "cp437", "cp850", "cp852", "cp866", "koi8-r", "mac_roman", "mac_latin2", "mac_cyrillic", "iso8859-2", "iso8859-5", "iso8859-7", "iso8859-15")
#: multi-byte encodings that text may wrongly have been read in
WRONG_WIDE = ("gbk", "cp932", "big5", "euc_kr")
#: encodings that the bytes may really have been in
TRUE = ("utf-8", "cp1252", "cp1250", "cp1251", "cp1253", "cp437", "cp850", "cp852", "cp866", "koi8-r", "mac_roman", "mac_latin2", "mac_cyrillic", "iso8859-2", "iso8859-5", "iso8859-7", "gbk", "cp932", "euc_jp", "big5", "euc_kr")
#: characters whose UTF-8 sequences are looked for, as ranges of code points
REPERTOIRE = ((0x80, 0x17F), (0x1A0, 0x1A1), (0x1AF, 0x1B0), (0x218, 0x21B), (0x386, 0x3CE), (0x400, 0x45F), (0x490, 0x491), (0x1EA0, 0x1EF9), (0x2010, 0x2026), (0x2030, 0x2033), (0x2039, 0x203A), (0x20AC, 0x20AC), (0x2116, 0x2122), (0x2190, 0x2193), (0x2212, 0x2212), (0x221A, 0x221E), (0x2248, 0x2248), (0x2260, 0x2265), (0x3000, 0x300F), (0x3041, 0x30FF), (0xFF01, 0xFF5E), (0xFE0F, 0xFE0F), (0xFFFD, 0xFFFD))
#: two-byte characters that by themselves count only within a word: marks, and scripts that come in runs
INNER = ((0x180, 0x36F), (0x460, 0x7FF))
#: characters that are likelier than others where a stretch can be read in two ways
COMMON = ((0x300, 0x30C), (0x327, 0x328), (0x5D0, 0x5EA), (0x620, 0x652), (0x900, 0x97F), (0xE01, 0xE5B), (0x2000, 0x206F), (0x2500, 0x27BF), (0x3000, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7A3), (0xFEFF, 0xFEFF), (0x10000, 0x10FFFF))
#: leading bytes of longer sequences, taken with any continuation that gives an assigned character
LEADS = {**dict.fromkeys(range(0xE0, 0xF0), 3), 0xF0: 4}

ACCENTED = re.compile(r"[À-ÖØ-öø-ÿ]{5,}")
MARKED = re.compile(r"[¡-ÿ]{6,}")
LOST = re.compile("�")
CONTROL = re.compile("[\x80-\x84\x86-\x9f]")
TOKEN = regex.compile(r"[^\s、。，！？；：「」]+")
DIGITS = re.compile(r"[0-9]+")
#: punctuation that follows a letter in correct text
AFTER_LETTERS = "»«”“„’‘‚…—–•›‹"
#: what else may follow a capital that is a unit or a word of its own
AFTER_UNITS = AFTER_LETTERS + "\xa0°±·×²³®©™"
EDGE = ".,;:!?()[]{}<>\"'|*_#`-/=+&"
#: characters that make an East Asian stretch
WIDE_LEAST = 4
TYPOGRAPHIC = "’‘“”„—–…"
SIGNS = "°±·×½£€²³«»\xa0"
ASCII = frozenset(map(chr, range(128)))
BEYOND = re.compile(r"[^\x00-\x7f]")
NOT_ASCII = r"[^\x00-\x7F]"
#: true encodings whose bytes only some texts fit
WIDE_TRUE = ("utf-8", "gbk", "cp932", "euc_jp", "big5", "euc_kr")
#: log-likelihood a character above which a stretch is usual, and what undoing a pair has to add a byte
USUAL, GAIN = -6.5, 0.6


@lru_cache(maxsize=64)
def _table(name: str) -> tuple[str, ...]:
    """The character of each byte in a single-byte encoding; undefined bytes stand for themselves."""
    return tuple(bytes([b]).decode(name, "ignore") or chr(b) for b in range(256))


@lru_cache(maxsize=64)
def _bytes_of(name: str) -> dict[str, int]:
    return {c: b for b, c in reversed(list(enumerate(_table(name))))}


def to_bytes(text: str, wrong: str) -> bytes | None:
    """The bytes that read in ``wrong`` give the text; None if there are none."""
    if wrong in WRONG_WIDE:
        try:
            return text.encode(wrong)
        except UnicodeEncodeError:
            return None
    back = _bytes_of(wrong)
    try:
        return bytes([back[c] for c in text])
    except KeyError:
        return None


def decode(data: bytes, true: str) -> str | None:
    try:
        return data.decode(true)
    except UnicodeDecodeError:
        return None


def _letter(c: str) -> bool:
    return unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lm")


def _assigned(c: str) -> bool:
    return c > "\uffff" or unicodedata.category(c) not in ("Cn", "Co", "Cs")


def _inner(c: str) -> bool:
    return not any(lo <= ord(c) <= hi for lo, hi in REPERTOIRE) and any(lo <= ord(c) <= hi for lo, hi in INNER)


def _rare(c: str) -> bool:
    return not any(lo <= ord(c) <= hi for lo, hi in REPERTOIRE + COMMON)


class Sequences:
    """The automaton of the sequences that UTF-8 text turns into."""

    def __init__(self) -> None:
        patterns: dict[str, set[tuple[str, int]]] = {}
        for wrong in WRONG:
            table = _table(wrong)
            for lo, hi in REPERTOIRE + INNER:
                for code in range(lo, hi + 1):
                    if not _assigned(chr(code)):
                        continue
                    data = chr(code).encode()
                    patterns.setdefault("".join(table[b] for b in data), set()).add((wrong, len(data)))
            for lead, size in LEADS.items():
                for second in range({0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80), 0xA0 if lead == 0xED else 0xC0):
                    patterns.setdefault(table[lead] + table[second], set()).add((wrong, size))
        self.automaton = ahocorasick.Automaton()
        for p, what in patterns.items():
            self.automaton.add_word(p, (len(p), tuple(sorted(what))))
        self.automaton.make_automaton()

    def runs(self, text: str) -> list[tuple[int, int, str, int]]:
        """Stretches (from, to, restored, characters) that are UTF-8 read in one wrong encoding; the longest, not overlapping."""
        if text.isascii():
            return []
        at: dict[str, dict[int, int]] = {}
        for end, (size, what) in self.automaton.iter(text):
            start = end + 1 - size
            for wrong, full in what:
                if start + full <= len(text):
                    own = at.setdefault(wrong, {})
                    own[start] = max(own.get(start, 0), full)
        found = []
        for wrong, own in at.items():
            todo = sorted(own)
            done = -1
            for start in todo:
                if start < done:
                    continue
                out, pos = [], start
                while pos in own:
                    data = to_bytes(text[pos : pos + own[pos]], wrong)
                    got = decode(data, "utf-8") if data else None
                    if got is None or len(got) != 1 or not _assigned(got):
                        break
                    out.append(got)
                    pos += own[pos]
                if out:
                    found.append((start, pos, "".join(out), len(out)))
                    done = pos
        found.sort(key=lambda r: (r[0] - r[1], sum(map(_rare, r[2])), r[0]))
        taken: list[tuple[int, int, str, int]] = []
        for r in found:
            if all(r[1] <= t[0] or r[0] >= t[1] for t in taken):
                taken.append(r)
        return sorted(taken)


@lru_cache(maxsize=1)
def sequences() -> Sequences:
    """One automaton a process."""
    return Sequences()


def _script(c: str) -> str:
    return unicodedata.name(c, "?").split()[0]


def certain(text: str, run: tuple[int, int, str, int]) -> bool:
    """Whether correct text can't look like this stretch."""
    a, b, restored, n = run
    part = text[a:b]
    before = text[a - 1] if a else " "
    letters = all(map(_letter, part))
    if letters and (len(set(map(_script, part))) > 1 or before.islower() and part[0].isupper()):
        return True
    if n == 1 and len(part) > 2 and part[0].isalpha() and all(c in AFTER_LETTERS or c == "\xa0" for c in part[1:]):
        return part[0] == "â" and not before.isalpha()  # a word before a blank or closing punctuation
    shaky = n == 1 and (_rare(restored) or "\uac00" <= restored <= "\ud7a3")
    if shaky and len(part) > 2 and part[0].islower() and part[:-1].isalpha() and part[-1] in AFTER_UNITS:
        return False  # a unit
    if n == 1 and not letters and _inner(restored):
        return before.isalpha() and (before.islower() or not part[0].isalpha()) and part[0] not in AFTER_UNITS and part[1] not in AFTER_UNITS
    if n >= 2:
        return not letters or n > 2 and not (part.islower() or part.isupper())
    if letters:
        return restored > "\uffff" or len(part) > 2 and not (part.islower() or part.istitle() or part.isupper()) and (not shaky or before.isalpha())
    if len(part) > 2:
        return True
    if part[1] in AFTER_LETTERS:  # a capital before closing punctuation, unless within a word
        return before.islower()
    return not before.isupper()


def _shows(piece: str) -> bool:
    """Whether a blank-delimited piece shows by itself that it was decoded wrongly."""
    if LOST.search(piece) or CONTROL.search(piece) or ACCENTED.search(piece):
        return True
    for m in MARKED.finditer(piece):  # at least six letters, each but the first marks after a letter
        if sum("À" <= c <= "ÿ" for c in m.group()) >= 6:
            return True
    return any(certain(piece, r) for r in sequences().runs(piece))


def _pieces(text: str) -> list[str]:
    """The text between ASCII blanks."""
    for c in "\n\t\r\v\f":
        text = text.replace(c, " ")
    return [p for p in text.split(" ") if p]


class Seen:
    """Results of a function of a piece of text; pieces recur, so most are looked up. Bounded; long pieces aren't kept."""

    def __init__(self, f, most: int = 1 << 17, longest: int = 200) -> None:
        self.f, self.most, self.longest, self.known = f, most, longest, {}

    def __call__(self, piece: str):
        got = self.known.get(piece, self)
        if got is self:
            got = self.f(piece)
            if len(piece) <= self.longest:
                if len(self.known) >= self.most:
                    self.known.clear()
                self.known[piece] = got
        return got


_shown = Seen(_shows)


def evident(text: str) -> bool:
    """Whether the text shows by itself that it was decoded wrongly."""
    return not text.isascii() and any(_shown(p) for p in {p for p in _pieces(text) if not p.isascii()})


def _core(token: str) -> str:
    return DIGITS.sub("9", token).strip(EDGE)


def _is_wide(c: str) -> bool:
    return "\u3040" <= c <= "\u30ff" or "\u3400" <= c <= "\u9fff" or "\uac00" <= c <= "\ud7a3" or "\uf900" <= c <= "\ufaff" or "\uff66" <= c <= "\uff9f"


def _tokens(piece: str) -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    """Of a piece: its words with characters beyond ASCII; its single such characters; its East Asian stretches (these are judged
    by their characters, not counted)."""
    words, single, wide = [], [], []
    for t in TOKEN.findall(piece):
        if t.isascii():
            continue
        t = _core(t)
        if t.isascii():
            continue
        if len(t) == 1:
            single.append(t)
        elif sum(map(_is_wide, t)) >= WIDE_LEAST:
            wide.append(t)
        else:
            words.append(t)
    return tuple(words), tuple(single), tuple(wide)


_split = Seen(_tokens)


def _beside(pieces: list[str], i: int) -> set[str]:
    """The keys of the single characters in piece i: with the tokens beside them."""
    around = [x for j in (i - 1, i, i + 1) if 0 <= j < len(pieces) for x in ([_core(t) for t in TOKEN.findall(pieces[j])] if not pieces[j].isascii() else [_core(pieces[j])])]
    first = len(TOKEN.findall(pieces[i - 1])) if i and not pieces[i - 1].isascii() else int(i > 0)
    last = first + len(TOKEN.findall(pieces[i]))
    return {f"{around[k - 1] if k else ''} {around[k]} {around[k + 1] if k + 1 < len(around) else ''}" for k in range(first, last) if len(around[k]) == 1 and not around[k].isascii()}


def keys_and_wide(text: str) -> tuple[set[str], set[str]]:
    """What is counted over the corpus, and the East Asian stretches.

    Keys are the tokens with characters beyond ASCII, digits as one 9, without plain punctuation at their ends; a token of
    one such character is a key by itself and also with the tokens beside it.
    """
    keys: set[str] = set()
    wide: set[str] = set()
    if text.isascii():
        return keys, wide
    pieces = _pieces(text)
    for p in {p for p in pieces if not p.isascii()}:
        words, single, own = _split(p)
        keys.update(words)
        wide.update(own)
        if single:
            keys.update(single)
            for i, q in enumerate(pieces):
                if q == p:
                    keys |= _beside(pieces, i)
    return keys, wide


def keys_of(text: str) -> set[str]:
    return keys_and_wide(text)[0]


@lru_cache(maxsize=1)
def _images() -> dict[str, dict[int, str]]:
    """What a character may be the image of, were it punctuation or a sign: image -> {number of the map: original}. Maps are
    those of the pairs of single-byte encodings, alike ones once (:func:`_pair`)."""
    out: dict[str, dict[int, str]] = {}
    for k, (one, _) in enumerate(_maps()):
        for image, c in one:
            out.setdefault(image, {})[k] = c
    return out


@lru_cache(maxsize=1)
def _maps() -> list[tuple[tuple[tuple[str, str], ...], tuple[str, str]]]:
    out: dict[tuple[tuple[str, str], ...], tuple[str, str]] = {}
    for true in (t for t in TRUE if t in WRONG):
        back = _bytes_of(true)
        for wrong in WRONG:
            one = tuple((_table(wrong)[back[c]], c) for c in TYPOGRAPHIC + SIGNS if c in back and _table(wrong)[back[c]] != c)
            if one:
                out.setdefault(one, (wrong, true))
    return [(one, pair) for one, pair in out.items()]


def _weight(text: str, at: int, c: str) -> str | None:
    """The stretch that shows that punctuation ``c`` belongs at this position (empty: it may stand there); None: it may not."""
    before, after = text[max(0, at - 24) : at], text[at + 1 : at + 25]
    if c == "’":
        head, tail = re.search("[A-Za-z]+$", before), re.match("[A-Za-z]+", after)
        if not head or not tail:
            return "" if head and not after[:1].isalnum() else None
        if tail.group() in ("s", "t", "re", "ll", "ve", "d", "m") and len(head.group() + tail.group()) > 2:
            return head.group() + c + tail.group()
        return "" if head.group().lower() in ("l", "d", "j", "qu", "n", "c", "m", "t", "s") else None
    if c in "‘“„":
        return c if (not before or before[-1] in " \n\t(") and after[:1].isalnum() and after[:1].isascii() else None
    if c == "”":
        return c if before[-1:].isascii() and before[-1:] not in ("", " ") and (not after or after[0] in " \n\t.,;:!?)") else None
    if c in "—–":
        return "" if before[-1:] in ("", " ") and after[:1] in ("", " ") or before[-1:].isdigit() and after[:1].isdigit() else None
    if c == "…":
        return "" if before[-1:].isalnum() and after[:1] in ("", " ", "\n", ")") else None
    return "" if before[-1:] in ("", " ") or before[-1:].isdigit() else None


def punctuation_pair(text: str, own: Iterable[str] | None = None) -> tuple[str, str] | None:
    """The pair of single-byte encodings under which every character of the text beyond ASCII is punctuation or a sign that
    stands where it belongs, among them quotation marks on both sides or three words with an apostrophe."""
    if text.isascii():
        return None
    images, maps = _images(), None
    for c in set("".join(own or [text])) - ASCII:  # own: the text's pieces that aren't ASCII, each once
        here = images.get(c)
        if here is None:
            return None
        maps = set(here) if maps is None else maps & set(here)
        if not maps:
            return None
    for k in sorted(maps or ()):
        shown, ok = set(), True
        for m in BEYOND.finditer(text):
            w = _weight(text, m.start(), images[m.group()][k])
            if w is None:
                ok = False
                break
            shown.add(w)
        words = len({w for w in shown if len(w) > 1})
        if ok and ({"“", "”"} <= shown or words >= 3):
            return _maps()[k][1]
    return None


def forms_of(word: str) -> dict[str, tuple[str, str]]:
    """Garbled form -> (wrong, true) of a word, over all pairs of encodings; UTF-8 also twice."""
    out: dict[str, tuple[str, str]] = {}
    for true in TRUE:
        try:
            data = word.encode(true)
        except UnicodeEncodeError:
            continue
        if data.isascii():
            continue
        for wrong in WRONG + WRONG_WIDE:
            try:
                got = data.decode(wrong)
                forms = (got, got.encode().decode(wrong)) if true == "utf-8" else (got,)
            except UnicodeError:
                continue
            for f in forms:
                f = f.strip(EDGE)
                # one character for one says nothing without the words beside it
                if f != word and f and not f.isascii() and not CONTROL.search(f) and len(f) + len(word) > 2:
                    out.setdefault(f, (wrong, true))
    return out


def undo(key: str, wrong: str, true: str) -> str | None:
    """The text that was read wrongly; of UTF-8 that went wrong twice the innermost."""
    data = to_bytes(key, wrong)
    return decode(data, true) if data else None


class Usual:
    """How usual each character is within its script, from counts over the corpus (one a character, so bounded)."""

    def __init__(self, counts: dict[str, int]) -> None:
        size = {"Han": 21_000, "Kana": 180, "Hangul": 11_172, "Cyrillic": 100, "Greek": 80, "Latin": 250, "other": 1_000}
        total = Counter()
        for c, n in counts.items():
            total[self.script(c)] += n
        self.none = {s: math.log(0.5 / (total[s] + 0.5 * k)) for s, k in size.items()}
        self.log = {c: math.log((n + 0.5) / (total[s] + 0.5 * size[s])) for c, n in counts.items() for s in (self.script(c),)}

        self.pair = Seen(self._pair)

    @staticmethod
    def script(c: str) -> str:
        if "\u3400" <= c <= "\u9fff" or "\uf900" <= c <= "\ufaff":
            return "Han"
        if "\u3040" <= c <= "\u30ff" or "\uff66" <= c <= "\uff9f":
            return "Kana"
        if "\uac00" <= c <= "\ud7a3":
            return "Hangul"
        if "\u0400" <= c <= "\u052f":
            return "Cyrillic"
        if "\u0370" <= c <= "\u03ff":
            return "Greek"
        return "Latin" if "\xc0" <= c <= "\u024f" else "other"

    def score(self, text: str) -> float:
        """Log-likelihood of the text's characters; plain ASCII counts alike in all readings."""
        return sum(-3.0 if c < "\x80" else self.log.get(c) or self.none[self.script(c)] for c in text)

    def _pair(self, stretch: str) -> tuple[str, str] | None:
        """The pair of encodings whose undoing makes an East Asian stretch much more usual; None for a stretch that is usual, or of
        which no reading is."""
        marks = [c for c in stretch if self.script(c) != "Kana"]  # kana lie alike in several encodings
        if len(marks) < 2 or self.score("".join(marks)) > USUAL * len(marks):
            return None
        best = None
        for wrong in WRONG_WIDE:
            data = to_bytes(stretch, wrong)
            if data is None:
                continue
            for true in TRUE:
                if true == wrong:
                    continue
                got = decode(data, true)
                if not got or got == stretch or CONTROL.search(got) or LOST.search(got):
                    continue
                if true not in WIDE_TRUE:  # any bytes can be read so: ask for lower-case words
                    letters = [c for c in got if c.isalpha()]
                    if len(data) < 12 or len(letters) < 0.8 * len(got) or len({self.script(c) for c in letters if c > "\x7f"}) > 1 or sum(c.islower() for c in letters) < 0.8 * len(letters):
                        continue
                changed = [(a, b) for a, b in zip(stretch, got, strict=True) if a != b] if len(got) == len(stretch) else [(stretch, got)]
                old, new = ("".join(x) for x in zip(*changed, strict=True))
                if len(old) < 3:
                    continue
                gain = (self.score(new) - self.score(old)) / (2 * len(old))
                if gain >= GAIN and (best is None or gain > best[0]):
                    best = gain, wrong, true
        return best[1:] if best else None


def _emit(n: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["key", "n"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, documents), and with a leading NUL (character, its occurrences in keys and stretches)."""
    n: Counter[str] = Counter()
    stretches: Counter[str] = Counter()
    held = 0

    def flush() -> pa.RecordBatch:
        chars: Counter[str] = Counter()
        for k, m in (*n.items(), *stretches.items()):
            for c in k:
                if c > "\x7f":
                    chars["\0" + c] += m
        out = _emit(n + chars)
        n.clear(), stretches.clear()
        return out

    for b in batches:
        for t in b.column(0).to_pylist():
            keys, wide = keys_and_wide(t)
            n.update(keys)
            stretches.update(wide)
            held += len(t)
        if len(n) + len(stretches) > 200_000 or held > 50_000_000:  # keys may be long: what they hold together counts too
            yield flush()
            held = 0
    yield flush()


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())

    def batch(rows: list[tuple[str, str, int, str, str]]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["form", "word", "n_word", "wrong", "true"])

    for b in batches:
        rows, size = [], 0
        for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            for f, pair in forms_of(k).items():
                rows.append((f, k, n, *pair))
                size += len(k)
                if size > 1_000_000:
                    yield batch(rows)
                    rows, size = [], 0
        yield batch(rows)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each key, and where its first or last character may be garbled punctuation, also without it."""
    images = _images()
    marks = {c: {_maps()[k][1] for k, o in own.items() if o in TYPOGRAPHIC} for c, own in images.items()}
    marks = {c: p for c, p in marks.items() if p}
    for b in batches:
        form, key, num, head, tail = [], [], [], [], []
        for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            for i in (0, 1) if k[0] in marks and len(k) > 2 else (0,):
                for j in (0, 1) if k[-1] in marks and len(k) > 2 + i else (0,):
                    if i + j == 0 or not k[i : len(k) - j].isascii():
                        form.append(k[i : len(k) - j]), key.append(k), num.append(n), head.append(k[:i]), tail.append(k[len(k) - j :])
        yield pa.RecordBatch.from_arrays([pa.array(form, pa.string()), pa.array(key, pa.string()), pa.array(num, pa.int64()), pa.array(head, pa.string()), pa.array(tail, pa.string())], names=["form", "key", "n", "head", "tail"])


def corpus_counts(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, int]]:
    """Documents of each key (computed once, checkpointed), and occurrences of each character beyond ASCII."""
    texts = docs.select(F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull() & F.col("text").rlike(NOT_ASCII))
    counts = cut(spread(texts).mapInArrow(_count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")))
    nul = F.col("key").startswith("\0")
    chars = counts.where(nul).toPandas()  # at most one row a character of Unicode
    return counts.where(~nul), {k[1:]: int(n) for k, n in zip(chars["key"], chars["n"], strict=True)}


def garbled_keys(counts: DataFrame, *, times: float = 4, least: int = 5) -> DataFrame:
    """``key, restored, wrong, true, n, n_restored, strong``: keys that are a garbled form of a word of the corpus.

    ``strong``: the word is in at least ``least`` documents and in at least ``times`` as many as the key. Others, whose word is
    in two documents and half as many again as the key, count only where three of one pair are in a document.
    """
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # making the forms is the costly step: spread the words evenly, however few tasks the counting left
    forms = counts.where("n >= 2").repartition(tasks, "key").mapInArrow(_forms, "form string, word string, n_word long, wrong string, true string")
    keys = counts.mapInArrow(_variants, "form string, key string, n long, head string, tail string")
    strong = (F.col("n_word") >= least) & (F.col("n_word") >= times * F.col("n"))
    # both sides grow with the corpus: a sort-merge join, which spills and which adaptive execution may split
    good = keys.hint("merge").join(forms, "form").where(strong | (F.col("n_word") >= 1.5 * F.col("n"))).withColumn("strong", strong)
    best = F.max(F.struct("strong", (-F.length("head") - F.length("tail")).alias("full"), "n_word", "word", "wrong", "true", "n")).alias("b")
    return good.groupBy("key").agg(best).select("key", F.col("b.word").alias("restored"), "b.wrong", "b.true", "b.n", F.col("b.n_word").alias("n_restored"), "b.strong")


class Known:
    """The garbled keys: an automaton over them, and the pair of each."""

    def __init__(self, rows: Iterable[tuple[str, str, str, bool]]) -> None:
        self.pair: dict[str, tuple[str, str, bool]] = {k: (w, t, s) for k, w, t, s in rows}
        self.automaton = ahocorasick.Automaton()
        for k in self.pair:
            self.automaton.add_word(k, k)
        if self.pair:
            self.automaton.make_automaton()
        self.hits = Seen(self._hits)
        self.beside = any(" " in k for k in self.pair)

    def _hits(self, piece: str) -> tuple[str, ...]:
        """The garbled keys among the tokens of a piece: matched by the automaton, then held against the token's ends."""
        if not self.pair:
            return ()
        some = {k for _, k in self.automaton.iter(DIGITS.sub("9", piece))}
        return tuple(some.intersection(*[_split(piece)[0] + _split(piece)[1]])) if some else ()

    def of(self, pieces: list[str], own: set[str]) -> set[str]:
        """The garbled keys of a text: its pieces, and which of them are not ASCII."""
        out: set[str] = set()
        for p in own:
            hits = self.hits(p)
            if hits:
                out.update(hits)
            if self.beside and _split(p)[1]:
                for i, q in enumerate(pieces):
                    if q == p:
                        out |= _beside(pieces, i) & self.pair.keys()
        return out


def by_keys(found: Iterable[tuple[str, str, bool]]) -> bool:
    """Whether garbled keys (wrong, true, strong) of one document are enough."""
    votes: Counter[tuple[str, str]] = Counter()
    for wrong, true, strong in found:
        if strong:
            return True
        votes[wrong, true] += 1
    return max(votes.values(), default=0) >= 3


def judge(text: str, known: Known, usual: Usual) -> str | None:
    """The evidence that a text was decoded wrongly."""
    if text.isascii():
        return None
    pieces = _pieces(text)
    own = {p for p in pieces if not p.isascii()}
    if any(map(_shown, own)):
        return "text"
    if by_keys(known.pair[k] for k in known.of(pieces, own)):
        return "corpus"
    if any(usual.pair(w) for p in own for w in _split(p)[2]):
        return "characters"
    return "punctuation" if punctuation_pair(text, own) else None


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Documents that may be garbled: not NULL and not plain ASCII (told in the JVM)."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(NOT_ASCII))


def _evidence(docs: DataFrame, doc_id: str, text: str, small: int, how: dict, restore: bool) -> DataFrame:
    """``doc_id, by, text, restored`` (the texts only if ``restore``) of the garbled documents, a row for each of their rows."""
    spark = docs.sparkSession
    counts, chars = corpus_counts(docs, text)
    keys = cut(garbled_keys(counts, **how).select("key", "wrong", "true", "strong"))
    usual = Usual(chars)
    d = spread(_texts(docs, doc_id, text))
    out = "doc_id long, by string, text string, restored string"

    def rows(b: pa.RecordBatch, known_of) -> pa.RecordBatch:
        ids, by, before, after = [], [], [], []
        for j, (i, t) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
            known = known_of(j)
            why = judge(t, known, usual)
            if why:
                ids.append(i), by.append(why), before.append(t if restore else None), after.append(restore_text(t, known.pair, usual) if restore else None)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(x, pa.string()) for x in (by, before, after))], names=["doc_id", "by", "text", "restored"])

    if keys.count() <= small:
        sent = spark.sparkContext.broadcast(tuple(keys.toPandas().itertuples(index=False, name=None)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Known(sent.value)
            for b in batches:
                yield rows(b, lambda j: known)

        return d.mapInArrow(run, out)

    def own_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [(i, k) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for k in keys_of(t)]
            ids, own = zip(*pairs, strict=True) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(own, pa.string())], names=["doc_id", "key"])

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = [Known((k["key"], k["wrong"], k["true"], k["strong"]) for k in ks or ()) for ks in b.column(2).to_pylist()]
            yield rows(b, known.__getitem__)

    per_doc = d.mapInArrow(own_keys, "doc_id long, key string").join(keys, "key").groupBy("doc_id").agg(F.collect_set(F.struct("key", "wrong", "true", "strong")).alias("known"))
    return d.join(per_doc, "doc_id", "left").select("doc_id", "text", "known").mapInArrow(run_joined, out)


def find_garbled(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", small: int = 200_000, **how) -> DataFrame:
    """``doc_id, by``: documents that hold wrongly decoded characters anywhere, with the evidence (``text``, ``corpus``,
    ``characters`` or ``punctuation``).

    A text is judged whole. Whether the original can be restored doesn't matter. NULL and empty texts, plain ASCII, and rows with a
    NULL id give no row; a doc_id given twice comes out once. At most ``small`` garbled keys (counted) go to the tasks as
    an automaton; more are joined to the documents' keys. ``how``: ``times`` and ``least`` of :func:`garbled_keys`.
    """
    return _evidence(docs, doc_id, text, small, how, False).groupBy("doc_id").agg(F.max("by").alias("by"))


def restore_text(text: str, known: dict[str, tuple[str, str, bool]], usual: Usual | None = None) -> str:
    """The text with its garbled spans replaced; ``known``: garbled key -> (wrong, true encoding, strong)."""
    if text.isascii():
        return text
    keys, wide = keys_and_wide(text)
    found = {k: known[k] for k in keys if k in known}
    votes = Counter(p[:2] for p in found.values())
    pairs = Counter({p[:2]: 0 for p in found.values() if p[2] or votes[p[:2]] >= 3})
    for p in found.values():
        if p[:2] in pairs:
            pairs[p[:2]] += 1
    for w in wide if usual else ():
        if p := usual.pair(w):
            pairs[p] += 1
    if not pairs and not evident(text) and (p := punctuation_pair(text)):
        return "".join(c if c.isascii() else undo(c, *p) or c for c in text)
    main, n = pairs.most_common(1)[0] if pairs else (None, 0)
    single = main is not None and main[1] != "utf-8"
    whole = single and 2 * n >= len(keys) + len(wide)  # then all of the text went through the pair

    def token(m: regex.Match) -> str:
        t = m.group()
        if t.isascii():
            return t
        core = _core(t)
        if core in found and found[core][:2] in pairs:
            pair = found[core][:2]
        elif usual and core in wide:
            pair = usual.pair(core)
            if pair is None and whole and (back := undo(core, *main)) and usual.score(back) > usual.score(core):
                pair = main
        else:
            pair = main if whole or single and (ACCENTED.search(t) or any(f" {core} " in k for k in found)) else None
        return (undo(t, *pair) if pair else None) or t

    def utf8_known(at: int) -> bool:
        m = next((m for m in TOKEN.finditer(text) if m.start() <= at < m.end()), None)
        core = _core(m.group()) if m else ""
        return core in found and found[core][1] == "utf-8"

    text = TOKEN.sub(token, text)
    for _ in range(0 if whole else 3):  # text that went wrong twice takes two rounds
        out, at = [], 0
        runs = sequences().runs(text)
        sure = [certain(text, r) for r in runs]
        for r, c in zip(runs, sure, strict=True):
            part = text[r[0] : r[1]]
            # beside a certain one the doubtful ones count too, but for a capital before punctuation
            if c or utf8_known(r[0]) or any(sure) and not all(map(_letter, part)) and not (len(part) == 2 and part[1] in AFTER_LETTERS):
                out += [text[at : r[0]], r[2]]
                at = r[1]
        if not out:
            break
        text = "".join(out) + text[at:]
    return text


def restore_garbled(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", small: int = 200_000, **how) -> DataFrame:
    """``doc_id, text, restored, complete``: the garbled documents, their text with the garbled spans replaced, and whether no
    sign of garbling is left. Texts whose characters were lost (replacement characters) stay incomplete. A doc_id given
    twice comes out for each of its rows that is garbled.
    """
    found = _evidence(docs, doc_id, text, small, how, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left = [not evident(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(left, pa.bool_())], names=["doc_id", "text", "restored", "complete"])

    return found.select("doc_id", "text", "restored").mapInArrow(run, "doc_id long, text string, restored string, complete boolean")
