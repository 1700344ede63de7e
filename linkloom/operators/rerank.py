"""Second opinions on borderline pairs: export, plug-in scorers that return (i, j, score), and the blend that tests them.

A scorer is any callable from the exported pairs to (i, j, score); the contract is the table, so it may as well be
written by another system. token_overlap_scorer is a deterministic stand-in where no model is installed.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.similarity import jaccard
from .decide import blend, borderline
from .evaluate import macro_f

Scorer = Callable[[DataFrame], DataFrame]
CE_WEIGHTS, JUDGE_WEIGHTS = (0, 0.5, 1, 2, 4), (0, 0.5, 1, 2)


def export_pairs(scored: DataFrame, records: DataFrame, p: str = "p2") -> DataFrame:
    """Borderline pairs with the raw texts of both sides (suffixed _1 and _2)."""
    texts = ["entity_id", "country_n", "name_core", "addr_core"]
    side = lambda key, s: records.select(F.col("idx").alias(key), *[F.col(c).alias(f"{c}_{s}") for c in texts])
    return borderline(scored, p).join(side("i", 1), "i").join(side("j", 2), "j")


def token_overlap_scorer(pairs: DataFrame) -> DataFrame:
    words = lambda s: F.split(F.concat_ws(" ", f"name_core_{s}", f"addr_core_{s}"), " ")
    return pairs.select("i", "j", F.round(jaccard(words(1), words(2)), 6).alias("score"))


def cross_fit(pairs: DataFrame, fold: str, fit: Callable[[DataFrame], Scorer]) -> DataFrame:
    """(i, j, score): each fold scored by the scorer fitted on the other one."""
    return fit(pairs.where(F.col(fold) == 1))(pairs.where(F.col(fold) == 0)).union(fit(pairs.where(F.col(fold) == 0))(pairs.where(F.col(fold) == 1)))


def keep_confident(scores: DataFrame, least: float = 0.5) -> DataFrame:
    return scores.where(F.col("score") >= least)


def attach_scores(pairs: DataFrame, **scores: DataFrame) -> DataFrame:
    """Left-joins each (i, j, score) as a column of its name."""
    for name, s in scores.items():
        pairs = pairs.join(s.select("i", "j", F.col("score").alias(name)), ["i", "j"], "left")
    return pairs


def blend_sweep(pairs: DataFrame, truth: DataFrame, entities: DataFrame, thresholds: list[float], weights: list[tuple[float, float, float]] | None = None, p: str = "p2") -> DataFrame:
    """(w_ce, w_judge, thr, f): macro F of every weighting (p weighs 1) and threshold, exclusive, in one job.

    Every weighting is a row of a small array, so pairs are exploded by their number and ranked once a weighting.
    """
    weights = weights or [(1, a, b) for a, b in product(CE_WEIGHTS, JUDGE_WEIGHTS)]
    cases = F.array(*[F.struct(F.lit(float(a)).alias("w_ce"), F.lit(float(b)).alias("w_judge"), F.round(blend(F.col(p), [F.col("ce"), F.col("judge")], [w, a, b]), 6).alias("s")) for w, a, b in weights])
    spread = pairs.select("i", "j", F.explode(cases).alias("c")).select("i", "j", "c.*")
    best = spread.withColumn("rk", F.row_number().over(Window.partitionBy("w_ce", "w_judge", "j").orderBy(F.desc("s"), "i"))).where("rk = 1")
    matched = best.select("i", "j", "w_ce", "w_judge", F.explode(F.filter(F.array(*map(F.lit, thresholds)), lambda t: F.col("s") >= t)).alias("thr"))
    return macro_f(matched, truth, entities, by=["w_ce", "w_judge", "thr"])
