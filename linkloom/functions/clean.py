"""The second, lighter cleaning: names and addresses for embeddings and pair rules. All native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab
from .fold import latin_fold
from .text import lookup, one_of, squeeze, words_of


def clean_text(text: Column) -> Column:
    """Lower case, Latin accents folded, & @ + spelt out, other signs but - . , / gone."""
    t = latin_fold(F.lower(F.trim(F.coalesce(text, F.lit("")))))
    for sign, word in (("&", " and "), ("@", " at "), ("+", " plus ")):
        t = F.replace(t, F.lit(sign), F.lit(word))
    return squeeze(F.regexp_replace(t, r"(?U)[^\w\s\-.,/̀-ͯऀ-ॿঀ-৿਀-ൿ]", " "))


def _without_noise(text: Column) -> Column:
    for noise in vocab.NAME_NOISE:
        text = F.replace(text, F.lit(noise), F.lit(" "))
    return text


def clean_text_keep_accents(text: Column) -> Column:
    t = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return squeeze(_without_noise(F.replace(t, F.lit("&"), F.lit(" and "))))


def remove_name_noise(name: Column) -> Column:
    name = _without_noise(name)
    for pattern in (r"https?://\S+", r"www\.\S+", r"\S+\.(com|org|net|in|co)\b"):
        name = F.regexp_replace(name, pattern, "")
    return squeeze(name)


def strip_legal_suffixes(name: Column) -> Column:
    bare = lambda w: F.btrim(w, F.lit(".,"))
    return F.array_join(F.filter(words_of(name), lambda w: ~one_of(bare(w), vocab.LEGAL_SUFFIXES)), " ")


def normalize_business_name(name: Column) -> Column:
    return squeeze(F.regexp_replace(strip_legal_suffixes(remove_name_noise(clean_text(name))), r"[.,\-/']", " "))


def name_tokens(clean_name: Column) -> Column:
    """Sorted distinct words, without stop words and single letters."""
    kept = F.filter(words_of(clean_name), lambda w: ~one_of(w, vocab.NAME_STOPWORDS) & (F.length(w) > 1))
    return F.array_join(F.array_sort(F.array_distinct(kept)), " ")


def remove_address_noise(addr: Column) -> Column:
    for pattern, to in (
        (r"##(\d)", "$1"),
        (r"(\d+)\s*1/2", "$1"),
        (r"(?i)\bnear\s+\w+(\s+\w+){0,4}", ""),
        (r"(?i)\bopp\.?\s+\w+(\s+\w+){0,3}", ""),
        (r"(?i)\bbehind\s+\w+(\s+\w+){0,3}", ""),
        (r"(?i)\bbeside\s+\w+(\s+\w+){0,3}", ""),
        (r"\bcdp\b", ""),
        (r"\bcity of\b", ""),
    ):
        addr = F.regexp_replace(addr, pattern, to)
    return squeeze(addr)


def expand_address_abbreviations(addr: Column) -> Column:
    table = lookup(vocab.STREET_ABBR)
    return F.array_join(F.transform(words_of(addr), lambda w: F.coalesce(F.try_element_at(table, F.btrim(w, F.lit(".,"))), w)), " ")


def street_number(addr: Column) -> Column:
    return F.regexp_extract(F.coalesce(addr, F.lit("")), r"\b(\d+)\b", 1)


def postal_code(addr: Column, country: Column) -> Column:
    addr, c = F.coalesce(addr, F.lit("")), F.lower(F.coalesce(country, F.lit("")))
    found = lambda pattern: F.regexp_extract(addr, pattern, 1)
    return F.when(c.isin("us", "france"), found(r"\b(\d{5})\b")).when(c == "india", found(r"\b(\d{6})\b")).otherwise(found(r"\b(\d{5,6})\b"))


def state_or_region(addr: Column, country: Column) -> Column:
    """State code (US) or full name (India, France) in an address; longer names are looked for first."""
    addr, c = F.coalesce(addr, F.lit("")), F.lower(F.coalesce(country, F.lit("")))
    low = F.lower(addr)

    def first(names: dict[str, str]) -> Column:
        out = F.lit(None).cast("string")
        for name in sorted(names, key=lambda n: (len(n), n)):
            out = F.when(F.contains(low, F.lit(name)), F.lit(names[name])).otherwise(out)
        return out

    code = F.regexp_extract(addr, r"\b([A-Z]{2})\b", 1)
    us = F.coalesce(first({v: k for k, v in vocab.US_STATES.items()}), F.when(one_of(F.lower(code), vocab.US_STATES), F.lower(code)))
    by_name = lambda names: first({n: n for n in names})
    found = F.when(c == "us", us).when(c == "india", by_name(vocab.INDIAN_STATES)).when(c == "france", by_name(vocab.FRENCH_REGIONS))
    return F.coalesce(found, F.lit(""))


def normalize_address(addr: Column) -> Column:
    t = expand_address_abbreviations(remove_address_noise(clean_text(addr)))
    t = F.regexp_replace(t, r"\b(unit|p\.?o\.? box)\s*", "")
    return squeeze(F.regexp_replace(t, r"[.,#\-/']", " "))


def preprocess(df: DataFrame, name: str = "business_name", addr: str = "business_address", country: str = "country") -> DataFrame:
    """Adds the eight clean columns of the second cleaning."""
    n, a, c = (F.coalesce(F.col(x), F.lit("")) for x in (name, addr, country))
    out = df.withColumns({"name_clean": normalize_business_name(n), "addr_clean": normalize_address(a)})
    out = out.withColumns({"name_tokens": name_tokens(F.col("name_clean")), "street_number": street_number(F.col("addr_clean"))})
    out = out.withColumns({"postal_code": postal_code(a, c), "state_region": state_or_region(a, c)})
    return out.withColumns(
        {
            "combined_text": F.concat_ws(" ", "name_clean", "addr_clean"),
            "combined_text_for_embedding": F.concat_ws(" | ", clean_text_keep_accents(n), clean_text_keep_accents(a), F.lower(c)),
        }
    )
