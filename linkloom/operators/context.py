"""Features of a pair among its rivals: the other candidates of its i and of its j."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CONTEXT = ["na_mean", "n_tset", "a_tset", "sk_tset", "ns_ratio", "p0"]


def add_context(pairs: DataFrame, columns: list[str], prefix: str = "") -> DataFrame:
    """rank (ties share the best), gap to the best, over i and over j, of each column; candidate counts. ``prefix`` keeps them apart from ranks taken earlier.

    All windows over one key share one sort order each for ranks and one plain pass for the rest.
    """
    wi, wj = Window.partitionBy("i"), Window.partitionBy("j")
    new = {}
    for c in columns:
        for side, w in (("i", wi), ("j", wj)):
            new[f"{prefix}{c}_rk_{side}"] = F.rank().over(w.orderBy(F.desc(c)))
            new[f"{prefix}{c}_gap_{side}"] = F.max(c).over(w) - F.col(c)
    new |= {f"{prefix}ncand_i": F.count(F.lit(1)).over(wi), f"{prefix}ncand_j": F.count(F.lit(1)).over(wj)}
    return pairs.withColumns(new)


def score_context(pairs: DataFrame, p: str = "p1") -> DataFrame:
    """What a first-stage score says of a pair among its rivals: ranks, gaps, sums, counts above a half, runner-up and margin."""
    # all of i before all of j: rows move once for each
    wi, wj = Window.partitionBy("i"), Window.partitionBy("j")
    half = F.when(F.col(p) > 0.5, 1).otherwise(0)
    out = pairs.withColumn(f"{p}_rk_i", F.row_number().over(wi.orderBy(F.desc(p), "j")))
    out = out.withColumns(
        {
            f"{p}_gap_i": F.max(p).over(wi) - F.col(p),
            f"{p}_sum_i": F.sum(p).over(wi),
            f"{p}_n05_i": F.sum(half).over(wi),
            "n_i": F.count(F.lit(1)).over(wi),
            f"{p}_second_i": F.coalesce(F.max(F.when(F.col(f"{p}_rk_i") == 2, F.col(p))).over(wi), F.lit(0.0)),
        }
    )
    out = out.withColumn(f"{p}_rk_j", F.row_number().over(wj.orderBy(F.desc(p), "i")))
    second_j = F.max(F.when(F.col(f"{p}_rk_j") == 2, F.col(p))).over(wj)
    out = out.withColumns(
        {
            f"{p}_gap_j": F.max(p).over(wj) - F.col(p),
            f"{p}_sum_j": F.sum(p).over(wj),
            f"{p}_n05_j": F.sum(half).over(wj),
            # the best rival for j: the runner-up for the best pair, the best pair for the others
            f"{p}_other_j": F.coalesce(F.when(F.col(f"{p}_rk_j") == 1, second_j).otherwise(F.max(p).over(wj)), F.lit(0.0)),
        }
    )
    return out.withColumn(f"{p}_margin_j", F.col(p) - F.col(f"{p}_other_j"))


def prune_keep(pairs: DataFrame, p: str = "p0", k: int = 20, r: int = 3, p_min: float = 0.002) -> DataFrame:
    """First the best max(20, k) of each i with a score of at least p_min; of these the best k of i or best r of j.

    The second ranks are taken after the first cut.
    """
    first = pairs.withColumn(f"{p}_rk_i", F.row_number().over(Window.partitionBy("i").orderBy(F.desc(p), "j")))
    first = first.where((F.col(f"{p}_rk_i") <= max(20, k)) & (F.col(p) >= p_min))
    second = first.withColumn(f"{p}_rk_j", F.row_number().over(Window.partitionBy("j").orderBy(F.desc(p), "i")))
    return second.where((F.col(f"{p}_rk_i") <= k) | (F.col(f"{p}_rk_j") <= r))
