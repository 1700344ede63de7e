"""Normal forms of names and addresses as Column functions.

Everything here is a native expression. Unicode folding beyond Latin and transliteration of Indic scripts have no
built-in; fold_text() in ``fold`` provides them on distinct values, and these functions take its output.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab

INDIC = "[\\u0900-\\u0D7F]"


def let(value: Column, body) -> Column:
    """body of a value that is evaluated once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def one_of(word: Column, words) -> Column:
    return word.isin(*words)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def words_of(text: Column) -> Column:
    """Space-separated words, none for an empty text."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def has_indic(text: Column) -> Column:
    return F.coalesce(text.rlike(INDIC), F.lit(False))


def basic(folded: Column) -> Column:
    """Lower-case words of a-z and 0-9; & and + read "and", @ reads "at", dotted initials are glued."""
    t = F.lower(F.coalesce(folded, F.lit("")))
    for sign, word in (("&", " and "), ("+", " and "), ("@", " at ")):
        t = F.replace(t, F.lit(sign), F.lit(word))
    t = F.regexp_replace(t, r"(?<=\w)'s\b", "s")
    t = F.regexp_replace(t, r"(?<=\b[a-z]\.[a-z])\.(?![a-z])|(?<=\b[a-z])\.(?=[a-z](?![a-z]))", "")
    t = F.regexp_replace(t, "['’]", "")
    return squeeze(F.regexp_replace(t, "[^a-z0-9 ]+", " "))


def join_initials(text: Column) -> Column:
    """Runs of single letters become one word."""
    return F.regexp_replace(text, r"(?<=(?:^| )[a-z]) (?=[a-z](?: |$))", "")


def skeleton(word: Column) -> Column:
    """Consonants of a word under a rough phonetic reading; digits stay."""
    t = reduce(lambda c, ab: F.replace(c, F.lit(ab[0]), F.lit(ab[1])), vocab.SKELETON, word)
    t = F.replace(t, F.lit("c"), F.lit("k"))
    s = F.concat(F.substring(t, 1, 1), F.regexp_replace(F.substr(t, F.lit(2)), "[aeiouh]", ""))
    return F.when((word == "") | word.rlike("^[0-9]+$"), word).otherwise(F.regexp_replace(s, r"(.)\1+", "$1"))


def canon_num(digits: Column) -> Column:
    return F.regexp_replace(digits, "^0+(?=.)", "")


def is_digits(word: Column) -> Column:
    return word.rlike("^[0-9]+$")


def norm_name(folded: Column, raw: Column | None = None) -> Column:
    """struct(core, full, legal, nums, is_dom, is_indic) of a name; folded has no accents and no Indic letters left."""
    folded = F.coalesce(folded, F.lit(""))
    low = F.lower(folded)
    label = F.regexp_extract(low, vocab.DOMAIN, 1)
    plain = F.regexp_replace(basic(folded), vocab.ALIAS_PHRASES, " dba ")
    text = F.when(label != "", F.replace(basic(label), F.lit(" "), F.lit(""))).otherwise(squeeze(plain))
    abbr = lookup(vocab.NAME_ABBR)

    def parts(ws: Column) -> Column:
        nums = F.transform(F.filter(ws, lambda w: is_digits(w) & (F.length(w) < 7)), canon_num)
        full = F.flatten(F.transform(F.filter(ws, lambda w: ~is_digits(w)), lambda w: F.split(F.coalesce(F.try_element_at(abbr, w), w), " ")))
        return F.struct(nums.alias("nums"), full.alias("full"))

    def named(p: Column) -> Column:
        full = p["full"]
        is_legal, is_stop = (lambda w: one_of(w, vocab.LEGAL_CANON)), (lambda w: one_of(w, vocab.NAME_STOP))
        core = F.filter(full, lambda w: ~is_legal(w) & ~is_stop(w))
        loose = F.filter(full, lambda w: ~is_stop(w))
        legal = F.array_sort(F.array_distinct(F.transform(F.filter(full, is_legal), lambda w: F.element_at(lookup(vocab.LEGAL_CANON), w))))
        core = F.when(F.size(core) > 0, core).when(F.size(loose) > 0, loose).otherwise(full)
        return F.struct(
            F.array_join(core, " ").alias("core"),
            F.array_join(full, " ").alias("full"),
            F.array_join(legal, " ").alias("legal"),
            F.array_join(p["nums"], " ").alias("nums"),
            (label != "").cast("int").alias("is_dom"),
            has_indic(raw if raw is not None else folded).cast("int").alias("is_indic"),
        )

    return let(parts(words_of(join_initials(text))), named)


def _state_tables() -> tuple[dict[str, str], dict[str, str]]:
    """(full names to the state that they stand for; French departments to regions)."""
    regions = {d: r for r, ds in vocab.FR_REGION_DEPTS.items() for d in ds}
    full = {s: s for s in [*vocab.US_STATES.values(), *vocab.US_TERRITORIES.values(), *vocab.IN_STATES.values(), *vocab.FR_REGION_DEPTS]}
    full |= {d: r for d, r in regions.items() if d not in vocab.NOT_A_STATE}
    full |= {k: v for k, v in vocab.IN_STATES.items()}
    return {k: regions.get(v, v) for k, v in full.items()}, regions


def norm_addr(folded: Column, country: Column) -> Column:
    """struct(core, state, nums) of an address of comma-separated segments."""
    c = F.lower(F.coalesce(country, F.lit("")))
    us, india = lookup(vocab.US_STATES | vocab.US_TERRITORIES), lookup(vocab.IN_STATES)
    names = lookup(_state_tables()[0])
    abbr = lookup(vocab.ADDR_ABBR)

    def segment(t: Column) -> Column:
        code = F.when(c.isin("us", "usa"), F.try_element_at(us, t)).when(c == "india", F.try_element_at(india, t))
        state = F.coalesce(code, F.try_element_at(names, t))
        t = F.regexp_replace(t, r"\b([0-9]+)\s*(st|nd|rd|th|er|e|eme|ème)\b", "$1")
        t = F.regexp_replace(t, "(?<=[a-z])(?=[0-9])|(?<=[0-9])(?=[a-z])", " ")
        out = F.flatten(F.transform(words_of(t), lambda w: words_of(F.coalesce(F.try_element_at(abbr, w), w))))
        return F.struct(state.alias("state"), F.when(state.isNull(), out).otherwise(F.array().cast("array<string>")).alias("out"))

    segments = F.filter(F.transform(F.split(F.coalesce(folded, F.lit("")), ","), basic), lambda t: t != "")

    def told(segs: Column) -> Column:
        out = F.flatten(F.transform(segs, lambda s: s["out"]))
        states = F.array_sort(F.array_distinct(F.array_compact(F.transform(segs, lambda s: s["state"]))))
        canon = lambda w: F.when(is_digits(w), canon_num(w)).otherwise(w)
        return F.struct(
            F.array_join(F.transform(F.filter(out, lambda w: ~one_of(w, vocab.ADDR_STOP)), canon), " ").alias("core"),
            F.array_join(states, " ").alias("state"),
            F.array_join(F.array_distinct(F.transform(F.filter(out, is_digits), canon_num)), " ").alias("nums"),
        )

    return let(F.transform(segments, segment), told)
