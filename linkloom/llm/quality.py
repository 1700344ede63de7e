"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule compares one statistic of a text with a cutoff. Cutoffs are not set by hand: labelled rows are the
holdout, and for each stratum (language) and rule the most severe cutoff of a fixed grid is selected for which the
exact binomial bound guarantees, at confidence 1 - DELTA over all tests together (Bonferroni over strata and
rules; within a grid the cutoffs are tested in a fixed order, mildest first, up to the first that fails), that at most ``risk`` of the stratum's good documents are rejected by that rule. The
per-rule risk is RISK divided by the number of rules, so all rules together keep the limit. A stratum with too
few labels gets no cutoff and rejects nothing.

Statistics are made in one narrow pass without a shuffle (repeated windows are found by sorting hashes inside
the row) and stored, so the texts are read once. Only counts by (stratum, rule, grid cell) are aggregated, and their table, bounded by strata x rules x
grid, is read by the driver to fix the cutoffs.

Defined results: null text has no words and fails the base rules; a null language is a stratum of its own; an unlabelled
or unknown stratum keeps what the base rules keep; without labels only the base rules act; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, WORD, documents, stored

LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"
#: Share of good documents of a stratum that all rules together may reject, and the chance of breaking that.
RISK = 0.05
DELTA = 0.05
#: Rule: (numerator, denominator); a document is rejected when the ratio is above the cutoff (``high``) or below it.
RULES = {
    "symbols": ("n_symbols", "n_words", "high"),
    "dup_lines": ("n_dup_lines", "n_lines", "high"),
    "repeats": ("n_repeat_words", "n_words", "high"),
    "long_words": ("word_chars", "n_words", "high"),
    "short_words": ("word_chars", "n_words", "low"),
}
#: Cutoffs to choose from, the mildest first: the order in which they are tested.
GRID = {
    "symbols": [2.0, 1.0, 0.7, 0.5, 0.35, 0.25],
    "dup_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
    "repeats": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2],
    "long_words": [20.0, 15.0, 12.0, 10.0, 9.0, 8.0],
    "short_words": [2.0, 2.25, 2.5, 2.75, 3.0],
}


# --- statistics ---------------------------------------------------------------------------------------------------


def _removed(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is evaluated once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _n_repeat_words(words: Column) -> Column:
    """Number of words that lie in a WINDOW-word window found twice or more in the text.

    Windows are hashed; only where the distinct hashes are fewer than the windows are they sorted with their places,
    compared with their neighbours, and the places that stand twice measured for the words they cover together.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    some = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(_repeated(h), _covered)))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(some)


def _repeated(hashes: Column) -> Column:
    """Places, ascending, whose hash stands at another place too."""

    def marked(sorted_: Column) -> Column:
        is_next = lambda p, j: F.get(sorted_, j)["h"] == p["h"]
        return F.transform(sorted_, lambda p, j: F.when(is_next(p, j - 1) | is_next(p, j + 1), p["i"]))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.sort_array(F.array_compact(_let(pairs, marked)))


def _covered(places: Column) -> Column:
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    step = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"))
    return F.aggregate(places, start, step, lambda a: a["n"])


def text_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """keep columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (all long) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    by_words = _let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.struct(F.size(w).alias("n"), _n_repeat_words(w).alias("repeats")))
    lines = F.filter(F.split(text, "\n"), lambda s: _removed(s, SPACES) > 0)
    by_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("copies")))
    found = docs.select(*keep, by_words.alias("w"), by_lines.alias("l"), _removed(text, SPACES).alias("c"), (F.length(text) - _removed(text, SYMBOLS)).alias("s"))
    names = {"n_words": "w.n", "word_chars": "c", "n_symbols": "s", "n_dup_lines": "l.copies", "n_repeat_words": "w.repeats", "n_lines": "l.n"}
    return found.select(*keep, *[F.col(v).cast("long").alias(k) for k, v in names.items()])


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEAT_PERCENT)


# --- thresholds ---------------------------------------------------------------------------------------------------


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exact: terms are summed downwards from k until they no longer count."""
    if k >= n:
        return 1.0
    if k >= p * n:  # the upper tail has the small terms
        return 1.0 - _sum_terms(k + 1, n, p, 1)
    return _sum_terms(k, n, p, -1)


def _sum_terms(k: int, n: int, p: float, step: int) -> float:
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    while 0 <= k <= n and term > 1e-18 * total:
        total += term
        term *= k / (n - k + 1) * (1 - p) / p if step < 0 else (n - k) / (k + 1) * p / (1 - p)
        k += step
    return total


def _ratio(rule: str) -> Column:
    up, down, _ = RULES[rule]
    return F.try_divide(F.col(up).cast("double"), F.col(down).cast("double"))


def _beyond(rule: str, cutoff: Column | float) -> Column:
    value = _ratio(rule)
    return F.coalesce(value > cutoff if RULES[rule][2] == "high" else value < cutoff, F.lit(False))


def select_cutoffs(labelled: DataFrame, stratum: str, risk: float = RISK, delta: float = DELTA) -> dict[tuple[str | None, str], float]:
    """Cutoffs by (stratum, rule) from statistics of labelled rows with their stratum and quality.

    A cutoff is tested by the exact one-sided binomial test of "more than risk/len(RULES) of the good documents are
    rejected"; testing goes on to the next severer cutoff as long as that is refuted at delta over strata x rules.
    """
    good = labelled.where(F.col("quality") == 1)
    passed = ~base_failed()
    counts = [F.count_if(passed & _beyond(rule, c)).alias(f"{rule}_{i}") for rule in RULES for i, c in enumerate(GRID[rule])]
    table = good.groupBy(stratum).agg(F.count_if(passed).alias("n"), *counts).collect()
    tests = max(1, len(table)) * len(GRID)
    cutoffs = {}
    for row in table:
        for rule, grid in GRID.items():
            for i, cutoff in enumerate(grid):
                if binomial_tail(row[f"{rule}_{i}"], row["n"], risk / len(RULES)) > delta / tests:
                    break
                cutoffs[row[stratum], rule] = cutoff
    return cutoffs


def verdict(stratum: str, cutoffs: dict[tuple[str | None, str], float]) -> Column:
    """Whether the rules keep a row, and so whether none of its stratum's cutoffs is passed."""
    kept = F.lit(True)
    for (name, rule), cutoff in sorted(cutoffs.items(), key=lambda x: (x[0][0] or "", x[0][1])):
        kept = kept & ~(F.col(stratum).eqNullSafe(F.lit(name)) & _beyond(rule, cutoff))
    return kept


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Statistics, base_failed and kept of every row of docs; labels: doc_id, quality."""
    stats = stored(text_statistics(docs, "doc_id", stratum), "quality")
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    cutoffs = select_cutoffs(stats.join(known, "doc_id"), stratum, risk, delta)
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & verdict(stratum, cutoffs)).alias("kept")
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op2_quality_rules": op2_quality_rules}


# --- SQL counterpart ----------------------------------------------------------------------------------------------


def _sql() -> str:
    """The whole operator in DuckDB SQL: words by unnesting, and the binomial bound by its sum of terms."""
    grid = ", ".join(f"('{rule}', {i}, {c}, {RULES[rule][2] == 'high'})" for rule, cutoffs in GRID.items() for i, c in enumerate(cutoffs))
    ratio = "CASE rule " + " ".join(f"WHEN '{rule}' THEN CAST({up} AS DOUBLE) / nullif({down}, 0)" for rule, (up, down, _) in RULES.items()) + " END"
    beyond = f"coalesce(CASE WHEN high THEN {ratio} > cutoff ELSE {ratio} < cutoff END, false)"
    p = RISK / len(RULES)
    term = f"exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln({p}) + (n - x) * ln(1 - {p}))"
    return f"""
WITH base AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
words AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS place FROM base),
windows AS (SELECT *, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
again AS (SELECT doc_id, place FROM windows WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, place + unnest([0, 1, 2]) AS spot FROM again) GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM base LEFT JOIN covered USING (doc_id)),
stats AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEAT_PERCENT} * n_words AS base_failed FROM counted),
grid(rule, step, cutoff, high) AS (VALUES {grid}),
good AS (SELECT stats.* FROM stats JOIN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1) USING (doc_id)),
tests AS (SELECT count(*) * {len(GRID)} AS m FROM (SELECT DISTINCT lang FROM good)),
tallies AS (
  SELECT lang, rule, step, cutoff, high, count(*) FILTER (NOT base_failed AND {beyond}) AS k, count(*) FILTER (NOT base_failed) AS n
  FROM good CROSS JOIN grid GROUP BY ALL),
bounds AS (
  SELECT *, CASE WHEN k >= n THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda x: {term})) END > {DELTA} / m AS fails FROM tallies CROSS JOIN tests),
passed AS (SELECT * FROM bounds QUALIFY NOT bool_or(fails) OVER (PARTITION BY lang, rule ORDER BY step)),
cutoffs AS (SELECT * FROM passed QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY step DESC) = 1),
rejected AS (SELECT DISTINCT doc_id FROM stats JOIN cutoffs ON stats.lang IS NOT DISTINCT FROM cutoffs.lang WHERE {beyond})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM stats
"""


ORACLE = {"op2_quality_rules": _sql()}
