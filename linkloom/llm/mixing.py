"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a target number of words. Whole copies of the source come first; what remains of the budget
is fitted from the counts of documents by exact size (words): a proportional share of every size keeps
the draw representative, bounded-knapsack dynamic programming over the left-over counts then meets the budget
to the word where the sizes allow it. Which documents of a size are drawn is decided by a
seeded hash of the id.

Scale: per source and size only counts travel, and per source one row; the sources, however many, stay a table: they are numbered by a range sort, and
the level to which targets are filled is found by one small aggregate a round. The cut inside a size is found from counts by hash bucket,
and only the one bucket in which the cut lies is ranked, so a source or size with a third of all rows is never
gathered in one task.

Defined results: null text has size 0; a null source is a source of its own, the last; sizes of 0 are taken 0
words; rows that share a doc_id are drawn together; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, attach_facts, documents, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2
SEED = 6
BUCKETS = 4096
#: Words of budget that the dynamic program is first tried on.
FIRST_WORDS = 1 << 18


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """totals (source, words) with weight and target: by weight of share * all words, none above most * its words, the excess reshared.

    Weights repeat over the sources in code-point order, null last. Filled to a level, a source gets level * weight or most * words if that
    is less; raising the level by what full sources leave fills more of them, until no further one is full.
    """
    # the order of UTF-8 bytes is the order of code points
    placed = totals.orderBy(F.col("source").asc_nulls_last()).select("source", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id"))
    placed = stored(placed, "mix-sources")
    parts = sorted(placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())  # a row a partition
    if not parts:
        return placed.select("source", "words", F.lit(0.0).alias("weight"), F.lit(0.0).alias("target"))
    before = F.create_map(*[F.lit(x) for (part, _), n in zip(parts, accumulate([0, *(n for _, n in parts)])) for x in (part, n)])
    nth = before[F.col("part")] + F.col("id").bitwiseAND(F.lit(2**33 - 1))
    weighed = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(nth, F.lit(len(weights))) + 1).cast("int"))
    table = stored(placed.select("source", "words", weighed.alias("weight")), "mix-weights")
    every, weight = table.where("words > 0").agg(F.sum("words"), F.sum("weight")).first()
    level, full = (share * every / weight if every else 0.0), -1
    cap = F.col("words") * float(most)
    while every:
        done = F.lit(level) * F.col("weight") >= cap
        n, held, rest = table.where("words > 0").agg(F.count_if(done), F.sum(F.when(done, cap)), F.sum(F.when(~done, F.col("weight")))).first()
        if n == full or not rest:
            break
        level, full = (share * every - (held or 0.0)) / rest, n
    target = F.when(F.col("words") > 0, F.least(cap, F.lit(level) * F.col("weight"))).otherwise(0.0)
    return table.select("source", "words", "weight", target.cast("double").alias("target"))


def _fit_exactly(sizes: np.ndarray, free: np.ndarray, left: int) -> np.ndarray:
    """Documents of each size whose words come nearest to left, by bounded-knapsack dynamic programming over all that are free."""
    take = np.zeros(len(sizes), np.int64)
    usable = [i for i in np.argsort(sizes) if free[i] > 0]
    if not usable or left <= 0:
        return take
    # what lies below is at most the largest size away, so no sum further above can be nearer
    top = left + int(sizes[usable[-1]])
    # items[k] = (index, documents in the item); powers of two make every number up to the free count
    items, reach, first = [], 1, np.full(top + 1, -1, np.int32)
    full = (1 << (top + 1)) - 1
    for i in usable:
        size, n = int(sizes[i]), min(int(free[i]), top // int(sizes[i]))
        step = 1
        while n > 0 and reach != full:
            k = min(step, n)
            fresh = (reach << (k * size)) & full & ~reach
            if fresh:
                bits = np.unpackbits(np.frombuffer(fresh.to_bytes(top // 8 + 1, "little"), np.uint8), bitorder="little")
                first[np.nonzero(bits)[0]] = len(items)
                items.append((i, k))
                reach |= fresh
            n -= k
            step *= 2
    reachable = np.nonzero(np.concatenate([[True], first[1:] >= 0]))[0]
    at = int(reachable[np.argmin(np.abs(reachable - left))])
    while at:
        i, k = items[first[at]]
        take[i] += k
        at -= k * int(sizes[i])
    return take


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, first_words: int = FIRST_WORDS) -> np.ndarray:
    """How many documents of each size to take so that the words taken come as near to budget as they can.

    sizes are distinct and positive. A proportional share of each size is taken; what remains of the budget is a bounded knapsack over
    the documents left. A long remainder is first shortened to ``first_words`` by documents of the largest sizes. That loses nothing if the dynamic program
    then meets the budget, or comes as near as the common divisor of the sizes allows; if it doesn't, more is left to it, in
    the end the whole remainder. The result is the nearest sum there is above the share, at any size.
    """
    take = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    take = np.array([int(c) * budget // total for c in counts], np.int64)
    left, free = budget - int((take * sizes).sum()), counts - take
    divisor = int(np.gcd.reduce(sizes[free > 0])) if (free > 0).any() else 1
    nearest = min(left % divisor, divisor - left % divisor)
    words, best = first_words, None
    while True:
        more, rest = np.zeros(len(sizes), np.int64), left
        for i in np.argsort(-sizes):
            if rest <= words:
                break
            size = int(sizes[i])
            more[i] = min(int(free[i]), -(-(rest - words) // size), rest // size)
            rest -= int(more[i]) * size
        shortened = bool(more.any())
        more += _fit_exactly(sizes, free - more, rest)
        off = abs(left - int((more * sizes).sum()))
        if best is None or off < best[0]:
            best = off, more
        if best[0] == nearest or not shortened:
            return take + best[1]
        words *= 8


def plan_mix(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(per-source table, plan) for sized (doc_id, source, size).

    The plan has a row for each source and size: copies every document of that size is taken, and the last
    hash and id (cut_hash, cut_id) up to which one copy more is taken (null: none).
    """
    hashed = sized.select("doc_id", "source", "size", F.xxhash64(F.lit(seed), F.col("doc_id")).alias("hash"))
    hashed = hashed.withColumn("bucket", F.shiftrightunsigned("hash", 64 - BUCKETS.bit_length() + 1).cast("int"))
    counts = stored(hashed.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    per_size = stored(counts.groupBy("source", "size").agg(F.sum("n").alias("n")), "mix-sizes")
    totals = per_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("words"))
    whole = F.when(F.col("words") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("words")))).otherwise(0).cast("long")
    recipe = with_targets(totals, weights, share, most).select("source", F.col("words").alias("source_size"), "target", whole.alias("whole"))
    recipe = stored(recipe.withColumn("budget", F.rint(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")), "mix-recipe")

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size")
        picks = np.zeros(len(frame), np.int64)
        real = frame["size"].to_numpy() > 0
        picks[real] = fit_budget(frame["size"].to_numpy()[real], frame["n"].to_numpy()[real], int(frame["budget"].iloc[0]))
        return frame.assign(picks=picks)[["source", "size", "n", "whole", "picks"]]

    same = per_size["source"].eqNullSafe(recipe["source"])
    grouped = per_size.join(recipe, same).select(per_size["source"], "size", "n", "whole", "budget")
    fitted = stored(grouped.groupBy("source").applyInPandas(fit, "source string, size long, n long, whole long, picks long"), "mix-fit")
    # the bucket in which the number of picks of a size is reached
    c, f = counts.alias("c"), fitted.where("picks > 0").alias("f")
    running = Window.partitionBy("source", "size").orderBy("bucket")
    cut = (
        c.join(f, F.col("c.source").eqNullSafe(F.col("f.source")) & (F.col("c.size") == F.col("f.size")))
        .select("c.source", "c.size", "bucket", F.col("c.n").alias("n"), "picks")
        .withColumn("upto", F.sum("n").over(running))
        .where((F.col("upto") >= F.col("picks")) & (F.col("upto") - F.col("n") < F.col("picks")))
        .select("source", "size", "bucket", (F.col("picks") - F.col("upto") + F.col("n")).alias("still"))
    )
    h, k = hashed.alias("h"), cut.alias("k")
    inside = h.join(k, F.col("h.source").eqNullSafe(F.col("k.source")) & (F.col("h.size") == F.col("k.size")) & (F.col("h.bucket") == F.col("k.bucket")))
    inside = inside.select("h.source", "h.size", "h.bucket", "hash", "doc_id", "still")
    ranked = inside.withColumn("nth", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("bucket", "hash", "doc_id")))
    cuts = ranked.where(F.col("nth") == F.col("still")).select("source", "size", F.col("hash").alias("cut_hash"), F.col("doc_id").alias("cut_id"), F.col("bucket").alias("cut_bucket"))
    u = cuts.alias("u")
    g = fitted.alias("g")
    plan = g.join(u, F.col("g.source").eqNullSafe(F.col("u.source")) & (F.col("g.size") == F.col("u.size")), "left")
    plan = plan.select("g.source", "g.size", "n", "whole", "cut_bucket", "cut_hash", "cut_id")
    plan = plan.join(recipe.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return recipe, stored(plan, "mix-plan")


def _with_copies(rows: DataFrame, plan: DataFrame, total: int, seed: int) -> DataFrame:
    """rows need doc_id, source, size; adds source_size, target and copies."""
    # one string key for (source, size); a null source can't meet a source of any name
    key = lambda: F.concat_ws("/", F.col("size").cast("string"), F.concat(F.lit("s"), F.col("source")))
    keyed = rows.withColumn("__key", key())
    facts = plan.withColumn("__key", key()).withColumnsRenamed({"n": "__n"})
    out = attach_facts(keyed, facts, "__key", "__n", total, ["whole", "cut_bucket", "cut_hash", "cut_id", "source_size", "target"])
    hash_ = F.xxhash64(F.lit(seed), F.col("doc_id"))
    bucket = F.shiftrightunsigned(hash_, 64 - BUCKETS.bit_length() + 1).cast("int")
    last_id = F.col("doc_id").isNull() | (F.col("doc_id") <= F.col("cut_id"))
    more = (bucket < F.col("cut_bucket")) | ((bucket == F.col("cut_bucket")) & ((hash_ < F.col("cut_hash")) | ((hash_ == F.col("cut_hash")) & last_id)))
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("whole") + F.coalesce(more, F.lit(False)).cast("int"))
    return out.withColumn("copies", copies.cast("int")).drop("__key", "whole", "cut_bucket", "cut_hash", "cut_id")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, copies."""
    sized = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sized")
    _, plan = plan_mix(sized, weights, share, most, seed)
    return _with_copies(sized, plan, sized.count(), seed)


def take_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """The rows of docs that the mix takes, each as often as it is taken. Texts without a word stay as they are: they have no words to weigh."""
    sized = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sized")
    _, plan = plan_mix(sized, weights, share, most, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, "doc_id", "source", n_words(F.col("text")).alias("size"))
    told = _with_copies(rows, plan, sized.count(), seed)
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies"))
    return told.select(F.explode(F.array_repeat("row", times)).alias("row")).select("row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(documents(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


QUERIES = {"op6_mixing": op6_mixing}
ORACLE: dict[str, str] = {}
