"""Personal data in texts, seen through disguises, with offsets into the original text.

Detectors for e-mail, IP, card and phone run on the text itself (base spans) and on a
normalised form of it. The normalised form comes from transducers: homoglyphs and full-width
forms become ASCII, runs of spelled digits become digits, ``[at]``/``(dot)`` and spelled
``at .. dot`` become ``@`` and ``.``. Each replaced piece remembers its source bounds, so a
span of the normalised form maps back to code points of the source. Spans that touch a
replaced piece and overlap no base span are added.

Defined cases: a null or empty text has no spans. Texts of any length are read whole, every
detector is linear in it (possessive or anchored patterns). Repeated rows each get their
result. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOUBLE = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            found.append((start, last))
        else:
            last = max(last, at)
        at = text.find("@", at + 1 if not domain else last)
    return found


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(_small(p) for p in m[0].split("."))]


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(_DOUBLE[int(d)] for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]


def detect(text: str) -> dict[str, list[Span]]:
    """Spans of each kind, leftmost and not overlapping within a kind."""
    return {
        "email": emails(text) if "@" in text else [],
        "ip": ips(text),
        "card": cards(text),
        "phone": phones(text) if "+" in text else [],
    }


# Look-alike letters of other scripts; digit words, signs and plus in English,
# French, German and Spanish.
HOMOGLYPHS = dict(
    zip(
        "аеорсухіјѕԁһкмтвнАВЕКМНОРСТУХІЈЅαοερικντυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijsdhkmtbhABEKMHOPCTYXIJSaoepikvtuxABEZHIKMNOPTYX",
        strict=True,
    )
)
DIGIT_WORDS = {
    **dict(zip("zero one two three four five six seven eight nine".split(), "0123456789", strict=True)),
    **dict(zip("zéro un deux trois quatre cinq six sept huit neuf".split(), "0123456789", strict=True)),
    **dict(zip("null eins zwei drei vier fünf sechs sieben acht neun".split(), "0123456789", strict=True)),
    **dict(zip("cero uno dos tres cuatro cinco seis siete ocho nueve".split(), "0123456789", strict=True)),
    "oh": "0",
    "une": "1",
    "zwo": "2",
}
AT_WORDS = ("at", "arobase", "arroba", "klammeraffe")
DOT_WORDS = ("dot", "point", "punkt", "punto")
PLUS_WORDS = ("plus", "más")

# longer words first, so that none hides behind its beginning
_DIGIT = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_AT, _DOT_WORD, _PLUS = "|".join(AT_WORDS), "|".join(DOT_WORDS), "|".join(PLUS_WORDS)
_SIGN = f"{_AT}|{_DOT_WORD}"
_GLYPHS = "".join(HOMOGLYPHS) + "！-～"
_LETTER = "A-Za-zÀ-ÿ"
# a word of look-alikes counts when it also holds, or touches, ASCII letters, digits or address signs
_MIXED = re.compile(rf"[A-Za-z0-9@._+-]*[{_GLYPHS}][A-Za-z0-9@._+{_GLYPHS}-]*")
_SPELLED = re.compile(
    rf"(?<![{_LETTER}])(?:(?:{_PLUS})[ -]+)?(?:{_DIGIT})(?:(?:[ ,-]{{1,2}}|[ ](?:{_DOT_WORD})[ ])(?:{_DIGIT}))+(?![{_LETTER}])", re.I
)
_SPELLED_PART = re.compile(rf"(?:{_PLUS})[ -]+|{_DIGIT}|[ ](?:{_DOT_WORD})[ ]|[ ,-]+", re.I)
_BRACKET = re.compile(rf"[ ]{{0,2}}(?:\[[ ]?({_SIGN})[ ]?\]|\([ ]?({_SIGN})[ ]?\)|\{{[ ]?({_SIGN})[ ]?\}}|<[ ]?({_SIGN})[ ]?>)[ ]{{0,2}}", re.I)
_WORDED = re.compile(
    rf"(?<=[A-Za-z0-9_%+])([ ](?:{_AT})[ ])[A-Za-z0-9-]+(?:(?:[ ](?:{_DOT_WORD})[ ]|\.)[A-Za-z0-9-]+)*[ ](?:{_DOT_WORD})[ ][A-Za-z]{{2,}}(?![A-Za-z])",
    re.I,
)
_DOT = re.compile(rf"[ ](?:{_DOT_WORD})[ ]", re.I)


def _tree(words: list[str]) -> str:
    """A pattern for any of the words, by common beginnings, so that few branches are tried at a place."""
    out = []
    for first in sorted({w[0] for w in words if w}):
        rest = [w[1:] for w in words if w[:1] == first]
        out.append(first + (f"(?:{_tree([r for r in rest if r])})" + ("?" if "" in rest else "") if any(rest) else ""))
    return "|".join(out)


# What lower-cased text must hold for each transducer to be worth running: cheap, and never narrower.
_GLYPH_HINT = re.compile(f"[{_GLYPHS}]")
_SPELLED_HINT = re.compile(rf"[^{_LETTER}](?:{_tree(list(DIGIT_WORDS))})(?:[ ,-]{{1,2}}|[ ](?:{_DOT_WORD})[ ])(?:{_tree(list(DIGIT_WORDS))})")
_BRACKET_HINT = re.compile(rf"[\[({{<][ ]?(?:{_SIGN})[ ]?[\])}}>]")
_WORDED_HINT = re.compile(rf"[ ](?:{_tree(list(AT_WORDS))})[ ][a-z0-9-]+(?:(?:[ ](?:{_DOT_WORD})[ ]|\.)[a-z0-9-]+)*[ ](?:{_DOT_WORD})[ ][a-z]{{2}}")

Piece = tuple[int, int, str]


def _pieces(text: str) -> list[Piece]:
    """Source bounds and replacement of every disguised piece, in order, not overlapping."""
    found: list[Piece] = []
    low = f" {text.lower()}"
    if not text.isascii() and _GLYPH_HINT.search(text):
        for m in _MIXED.finditer(text):
            for i in range(m.start(), m.end()):
                c = text[i]
                plain = HOMOGLYPHS.get(c) or (unicodedata.normalize("NFKC", c) if "！" <= c <= "～" else None)
                if plain:
                    found.append((i, i + 1, plain))
    if _SPELLED_HINT.search(low):
        for m in _SPELLED.finditer(text):
            for p in _SPELLED_PART.finditer(text, m.start(), m.end()):
                word = p[0].lower().strip(" ,-")
                plain = "+" if word in PLUS_WORDS else "." if word in DOT_WORDS else DIGIT_WORDS.get(word, "")
                found.append((p.start(), p.end(), plain))
    if _BRACKET_HINT.search(low):
        for m in _BRACKET.finditer(text):
            sign = next(g for g in m.groups() if g).lower()
            found.append((m.start(), m.end(), "@" if sign in AT_WORDS else "."))
    if any(f" {w} " in low for w in DOT_WORDS) and _WORDED_HINT.search(low):
        for m in _WORDED.finditer(text):
            found.append((m.start(1), m.end(1), "@"))
            found += [(d.start(), d.end(), ".") for d in _DOT.finditer(text, m.end(1) - 1, m.end())]
    kept, last = [], 0
    for piece in sorted(set(found)):
        if piece[0] >= last:
            kept.append(piece)
            last = piece[1]
    return kept


def normalise(text: str) -> tuple[str, list[int], list[Piece]]:
    """The normalised text, the start of each piece in it, and the pieces."""
    pieces = _pieces(text)
    if not pieces:
        return text, [], []
    out, starts, at, length = [], [], 0, 0
    for start, end, plain in pieces:
        out += (text[at:start], plain)
        length += start - at
        starts.append(length)
        length += len(plain)
        at = end
    out.append(text[at:])
    return "".join(out), starts, pieces


def _source(span: Span, starts: list[int], pieces: list[Piece]) -> tuple[Span, bool]:
    """A span of the normalised text in the source, and whether it holds a replaced piece."""

    def place(at: int, upper: bool) -> int:
        i = bisect_right(starts, at) - 1
        if i < 0:
            return at
        start, end, plain = pieces[i]
        into = at - starts[i]
        if into < len(plain):
            return end if upper else start
        return end + into - len(plain)

    i = bisect_right(starts, span[1] - 1) - 1
    last = place(span[1] - 1, True)
    if i < 0 or span[1] - 1 - starts[i] >= len(pieces[i][2]):
        last += 1  # an ordinary character; a piece gives its own end
    first = place(span[0], False)
    return (first, last), i >= 0 and pieces[i][1] > first


def spans(text: str) -> tuple[dict[str, list[Span]], list[tuple[str, int, int]]]:
    """Base spans by kind, and the added ones as (kind, start, end)."""
    base = detect(text)
    plain, starts, pieces = normalise(text)
    added: list[tuple[str, int, int]] = []
    if pieces:
        taken = sorted(s for found in base.values() for s in found)
        reach = list(accumulate((end for _, end in taken), max))
        for kind, found in detect(plain).items():
            for span in found:
                (start, end), inside = _source(span, starts, pieces)
                before = bisect_left(taken, (end, -1))
                if inside and not (before and reach[before - 1] > start):
                    added.append((kind, start, end))
    return base, added


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _join(found: list[tuple[str, int, int]]) -> str:
    order = sorted(found, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in order)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {**{f"n_{k}": pa.int64() for k in KINDS}, "base_sha256": pa.string(), "spans": pa.string(), "n_added": pa.int64()}
    for batch in batches:
        rows = []
        for text in batch["text"]:
            base, added = spans(text.as_py() or "")
            listed = [(k, s, e) for k in KINDS for s, e in base[k]]
            digest = hashlib.sha256(_join(listed).encode()).hexdigest()
            rows.append((*(len(base[k]) for k in KINDS), digest, _join(listed + added), len(added)))
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        found = [pa.array(c, kind) for c, kind in zip(columns, kinds.values(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *found], names=["doc_id", *kinds])


def find_pii(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts and digest of the base spans, and all spans as ``kind:start:end``."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")
