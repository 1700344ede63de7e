"""Unicode folding and Indic transliteration: the two text steps Spark has no built-in for.

Both run as one Arrow UDF over distinct values (fold_distinct), so a repeated name is folded once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters that NFKD leaves whole.
LIGATURES = {"ß": "ss", "œ": "oe", "Œ": "OE", "æ": "ae", "Æ": "AE", "ø": "o", "Ø": "O", "ł": "l", "đ": "d"}

# The nine scripts lie in parallel blocks of 0x80 code points from U+0900, so one table of offsets serves all.
FIRST, LAST, BLOCK = 0x0900, 0x0D7F, 0x80
_VOWELS = {0x05: "a", 0x06: "aa", 0x07: "i", 0x08: "ii", 0x09: "u", 0x0A: "uu", 0x0B: "ri", 0x0E: "e", 0x0F: "e", 0x10: "ai", 0x12: "o", 0x13: "o", 0x14: "au"}
_SIGNS = {0x3E: "aa", 0x3F: "i", 0x40: "ii", 0x41: "u", 0x42: "uu", 0x43: "ri", 0x46: "e", 0x47: "e", 0x48: "ai", 0x4A: "o", 0x4B: "o", 0x4C: "au"}
_CONSONANTS = dict(zip(range(0x15, 0x3A), "k kh g gh n ch ch j jh n t th d dh n t th d dh n n p ph b bh m y r r l l zh v sh sh s h".split()))
_MARKS = {0x01: "n", 0x02: "n", 0x03: "h"}
_VIRAMA, _NUKTA, _DIGITS = 0x4D, 0x3C, range(0x66, 0x70)


def is_indic(ch: str) -> bool:
    return FIRST <= ord(ch) <= LAST


def strip_accents(text: str) -> str:
    for a, b in LIGATURES.items():
        text = text.replace(a, b)
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def transliterate(token: str) -> str:
    """Latin letters of an Indic token: consonants carry an "a" that a vowel sign or virama replaces; a final one is dropped."""
    out: list[str] = []
    open_ = False  # the last letter is a consonant whose vowel is still to come
    for ch in token:
        k = (ord(ch) - FIRST) % BLOCK if is_indic(ch) else None
        if k in _SIGNS:
            out.append(_SIGNS[k])
            open_ = False
            continue
        if k == _VIRAMA:
            open_ = False
            continue
        if k == _NUKTA:
            continue
        if open_:
            out.append("a")
        open_ = k in _CONSONANTS
        if k is None:
            out.append(ch)
        elif k in _DIGITS:
            out.append(str(k - 0x66))
        else:
            out.append(_VOWELS.get(k) or _CONSONANTS.get(k) or _MARKS.get(k) or "")
    if open_:
        out.append("a")
    t = "".join(c for c in strip_accents("".join(out)).lower() if "a" <= c <= "z" or "0" <= c <= "9")
    return t[:-1] if len(t) > 3 and t.endswith("a") and not t.endswith("aa") else t


def indic_to_latin(text: str, tokens: dict[str, str] | None = None) -> str:
    words = (w.strip(".,;:()[]-") for w in text.split())
    return " ".join((tokens or {}).get(w) or (transliterate(w) if any(map(is_indic, w)) else w) for w in words)


def fold(text: str | None, tokens: dict[str, str] | None = None) -> str:
    if not text:
        return ""
    if text.isascii():
        return text
    if any(map(is_indic, text)):
        text = indic_to_latin(text, tokens)
    return strip_accents(text)


def fold_udf(tokens: dict[str, str] | None = None):
    """tokens: learned replacements of Indic tokens, a bounded dictionary."""

    @F.arrow_udf("string")
    def folded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fold(t, tokens) for t in texts.to_pylist()], pa.string())

    return folded


def fold_distinct(df: DataFrame, column: str, out: str, tokens: dict[str, str] | None = None) -> DataFrame:
    """Adds out, the folded column. ASCII values never leave the JVM; others are folded once a distinct value."""
    plain = F.coalesce(F.col(column), F.lit("")).rlike("^[\\x00-\\x7F]*$")
    odd = df.where(~plain).select(column).distinct().select(F.col(column).alias("__was"), fold_udf(tokens)(column).alias("__now"))
    joined = df.join(odd, F.when(~plain, F.col(column)) == F.col("__was"), "left")
    return joined.withColumn(out, F.coalesce("__now", column, F.lit(""))).drop("__was", "__now")


def latin_fold(text: Column) -> Column:
    """Native folding of the letters in U+0080 to U+024F; anything else stays."""
    table = {chr(c): "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x)) for c in range(0x80, 0x250)}
    single = {k: v for k, v in table.items() if len(v) == 1 and v != k}
    out = F.translate(text, "".join(single), "".join(single.values()))
    for k, v in table.items():
        if len(v) > 1 and k.isalpha():
            out = F.replace(out, F.lit(k), F.lit(v))
    return out
