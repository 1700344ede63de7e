"""Candidate pairs from the token index, and the two-sided top-k that keeps the best of them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tokens import GROUPS, group_of

#: A query token's document frequency may be at most this times sqrt(e).
QUERY_DF = 300
TOP_FORWARD, TOP_REVERSE = 40, 3


def candidate_pairs(postings: DataFrame, query_df: float = QUERY_DF) -> DataFrame:
    """i (source 1), j (source 2 or 3), bs, b_ntok and bs_<group>: sums of the weights of shared tokens.

    The join meets on (country, type, token); the cap on df bounds what one key can make.
    """
    rare = postings.where(F.col("df") <= query_df * math.exp(0.5))
    key = ["country_n", "typ", "token"]
    one = rare.where("src = 1").select(F.col("idx").alias("i"), *key, "w")
    # sorted, lists compress to a fraction of their ids
    other = rare.where("src <> 1").groupBy(*key).agg(F.sort_array(F.collect_list("idx")).alias("js"))
    # a list of at most the cap travels to its i whole, so that pairs are made and summed where they stay
    met = one.join(other, key).select("i", group_of(F.col("typ")).alias("grp"), "w", "js").repartition("i")
    met = met.select("i", "grp", "w", F.explode("js").alias("j"))
    sums = [F.round(F.sum(F.when(F.col("grp") == g, F.col("w")).otherwise(0.0)), 4).alias(f"bs_{g}") for g in GROUPS]
    return met.groupBy("i", "j").agg(F.round(F.sum("w"), 4).alias("bs"), F.count(F.lit(1)).alias("b_ntok"), *sums)


def rank_in(key: str, other: str, score: str):
    return F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), F.asc(other)))


def two_sided_top(pairs: DataFrame, forward: int = TOP_FORWARD, reverse: int = TOP_REVERSE) -> DataFrame:
    """Pairs among the best ``forward`` of their i or the best ``reverse`` of their j, with ranks clipped one above.

    Two ranked branches, each of which Spark can cut while it sorts, are joined; a disjunction over both
    ranks would rank everything twice.
    """
    best_i = pairs.withColumn("b_rank_i", rank_in("i", "j", "bs")).where(F.col("b_rank_i") <= forward)
    best_j = pairs.withColumn("b_rank_j", rank_in("j", "i", "bs")).where(F.col("b_rank_j") <= reverse)
    data = [c for c in pairs.columns if c not in ("i", "j")]
    a, b = best_i.alias("a"), best_j.alias("b")
    both = a.join(b, ["i", "j"], "full")
    return both.select(
        "i",
        "j",
        *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in data],
        F.coalesce("b_rank_i", F.lit(forward + 1)).alias("b_rank_i"),
        F.coalesce("b_rank_j", F.lit(reverse + 1)).alias("b_rank_j"),
    )


def block_features(pairs: DataFrame, totals: DataFrame) -> DataFrame:
    """Totals of both sides, overlaps with them, gaps to the best of i and j, and candidate counts."""
    ti = totals.select(F.col("idx").alias("i"), *[F.col(f"t_{g}").alias(f"t_{g}_i") for g in GROUPS])
    tj = totals.select(F.col("idx").alias("j"), *[F.col(f"t_{g}").alias(f"t_{g}_j") for g in GROUPS])
    out = pairs.join(ti, "i", "left").join(tj, "j", "left").na.fill(0.0)
    for g in GROUPS:
        for s in "ij":
            out = out.withColumn(f"ov_{g}_{s}", F.col(f"bs_{g}") / (F.col(f"t_{g}_{s}") + 1e-3))
    both = lambda g: F.col(f"ov_{g}_i") + F.col(f"ov_{g}_j")
    out = out.withColumns({"ov_name_s": both("name"), "ov_an_s": both("addr") + both("num")})
    wi, wj = Window.partitionBy("i"), Window.partitionBy("j")
    gaps = {f"{c}_gap_i": F.max(c).over(wi) - F.col(c) for c in ("bs", "ov_name_s", "ov_an_s")}
    return out.withColumns({**gaps, "nc_i": F.count(F.lit(1)).over(wi), "bs_gap_j": F.max("bs").over(wj) - F.col("bs"), "nc_j": F.count(F.lit(1)).over(wj)})
