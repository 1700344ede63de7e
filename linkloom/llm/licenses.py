"""License scan by ordered signature rules, in DataFrame functions only.

The signature rules are written by hand, one by one (module ``license_signatures``), as regexes over the normal form of a
text (its words, lower-cased and single-spaced). A rule is tried only on texts that contain its keyword, and keywords are looked for only in
texts that contain one of the few roots that every keyword holds. Each match is a detection with an interval of characters; a detection that lies inside a detection of the same
or a higher priority is suppressed, so that "cc by nc 4 0" doesn't also report the plainer "cc by".

All of it happens inside the row: no shuffle, no Python. The base phrases are counted on their own, before any
suppression.

Defined results: null or word-less text has no detection, score 0, null first and last word and empty labels; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, documents
from .license_signatures import ROOTS, SIGNATURES

#: Words are runs of anything but these ASCII characters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases with their label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Rule:
    """priority: higher wins; regex: over single-spaced words, without the spaces around; score: how sure a match is."""

    label: str
    keyword: str
    regex: str
    priority: int
    score: float


def rules() -> list[Rule]:
    """All signature rules in the order in which they are tried."""
    return [Rule(*s) for s in SIGNATURES]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is evaluated once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _count(text: Column, char: str = " ") -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _spans(norm: Column, rule: Column) -> Column:
    """Detections of one rule: the text between matches gives their places."""
    regex = F.concat(F.lit(" "), rule["regex"], F.lit("(?= )"))

    def placed(m: Column) -> Column:
        gaps = F.split(norm, regex, -1)
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,priority:int,score:double,label:string>>").alias("out"))

        def step(a: Column, z: Column) -> Column:
            begin = a["at"] + F.length(z["gap"])
            stop = begin + F.length(z["hit"])
            one = F.struct(begin.alias("start"), stop.alias("stop"), rule["priority"].alias("priority"), rule["score"].alias("score"), rule["label"].alias("label"))
            return F.struct(stop.alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

        pairs = F.arrays_zip(F.slice(gaps, 1, F.size(m)).alias("gap"), m.alias("hit"))
        return F.when(F.size(m) == 0, start["out"]).otherwise(F.aggregate(pairs, start, step, lambda a: a["out"]))

    return _let(F.regexp_extract_all(norm, regex, F.lit(0)), placed)


def _standing(spans: Column, levels: list[int]) -> Column:
    """Detections that no other one of the same or a higher priority contains: one walk by start, the longest first.

    The walk carries, for each priority, how far detections of at least that priority reach.
    """
    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("back"), (-s["priority"]).alias("rank"), s["label"].alias("label"), s["score"].alias("score"))))
    zero = F.struct(F.array(*[F.lit(-1) for _ in levels]).alias("reach"), F.array().cast("array<struct<label:string,score:double>>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        mine = -s["rank"]
        inside = F.get(a["reach"], mine - F.lit(levels[0])) >= -s["back"]
        reach = F.transform(a["reach"], lambda r, k: F.when(k + F.lit(levels[0]) <= mine, F.greatest(r, -s["back"])).otherwise(r))
        out = F.when(inside, a["out"]).otherwise(F.concat(a["out"], F.array(F.struct(s["label"].alias("label"), s["score"].alias("score")))))
        return F.struct(reach.alias("reach"), out.alias("out"))

    return F.aggregate(by_start, zero, step, lambda a: a["out"])


def license_scan(docs: DataFrame, signatures: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    signatures = rules() if signatures is None else signatures
    low = F.regexp_replace(ascii_lower(F.coalesce("text", F.lit(""))), BETWEEN, " ")
    # every word with a space before it and one behind the last
    norm = F.concat(F.lit(" "), F.ltrim(F.rtrim(low)), F.lit(" "))
    base = docs.select("doc_id", norm.alias("norm"))

    phrases = " (?:" + "|".join(BASE) + ")(?= )"
    some_base = F.lit(False)
    for p in BASE:
        some_base = some_base | F.contains(F.col("norm"), F.lit(f" {p} "))

    def base_facts(hits: Column) -> Column:
        gaps = lambda: F.split(F.col("norm"), phrases)
        ends = _let(gaps(), lambda g: F.struct(F.get(g, 0).alias("head"), F.get(g, F.size(g) - 1).alias("tail")))
        n_last = _count(F.get(hits, F.size(hits) - 1))
        return _let(
            ends,
            lambda e: F.struct(
                F.size(hits).alias("n"),
                _count(e["head"]).alias("first"),
                (_count(F.col("norm")) - _count(e["tail"]) - n_last).alias("last"),
                F.array_sort(F.array_distinct(F.transform(hits, _base_label))).alias("labels"),
            ),
        )

    def _base_label(hit: Column) -> Column:
        chosen = F.lit(None).cast("string")
        for p, label in BASE.items():
            chosen = F.when(F.trim(hit) == p, F.lit(label)).otherwise(chosen)
        return chosen

    found_base = F.when(some_base, _let(F.regexp_extract_all("norm", F.lit(phrases), F.lit(0)), base_facts))

    # a gate by root, one by keyword, then the rules of those keywords, each tried by itself
    by_keyword: dict[str, list[Rule]] = {}
    for r in signatures:
        by_keyword.setdefault(r.keyword, []).append(r)
    levels = list(range(min(r.priority for r in signatures), max(r.priority for r in signatures) + 1))
    literal = lambda r: F.struct(F.lit(r.label).alias("label"), F.lit(r.regex).alias("regex"), F.lit(r.priority).alias("priority"), F.lit(r.score).alias("score"))
    groups = F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*map(literal, own)).alias("rules")) for k, own in by_keyword.items()])
    held = lambda word: F.contains(F.col("norm"), word)
    # signatures of the caller's may hold none of the roots; such a keyword is a root of its own
    roots = [*ROOTS, *(k for k in by_keyword if not any(r in k for r in ROOTS))]
    named = F.when(F.exists(F.array(*map(F.lit, roots)), held), F.filter(groups, lambda g: held(g["keyword"])))
    tried = F.coalesce(F.flatten(F.transform(named, lambda g: g["rules"])), F.array().cast("array<struct<label:string,regex:string,priority:int,score:double>>"))
    spans = F.flatten(F.transform(tried, lambda r: _spans(F.col("norm"), r)))
    facts = base.select("doc_id", F.col("norm"), found_base.alias("b"), _let(spans, lambda s: _standing(s, levels)).alias("d"))
    b_labels = F.coalesce(F.col("b.labels"), F.array().cast("array<string>"))
    d_labels = F.transform("d", lambda x: x["label"])
    return facts.select(
        "doc_id",
        F.when(F.length("norm") <= 2, F.lit(0)).otherwise(_count(F.col("norm")) - 1).cast("long").alias("n_words"),
        F.coalesce(F.col("b.n"), F.lit(0)).cast("long").alias("n_base"),
        F.col("b.first").cast("long").alias("first_word"),
        F.col("b.last").cast("long").alias("last_word"),
        F.array_join(b_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(b_labels, d_labels)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("d", lambda x: x["score"])), F.when(F.col("b.n") > 0, F.lit(0.7)), F.lit(0.0)).alias("score"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


QUERIES = {"op3_license_scan": op3_license_scan}
ORACLE: dict[str, str] = {}
