"""From scores to matches: thresholds, exclusivity, vetoes, overrides and blends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .features import best_of

BORDERLINE = (0.15, 0.95)
AMBIGUOUS = (0.35, 0.75)
JUDGED = (0.3, 0.85)
JARO_FLOOR, JARO_HOUSE = 0.40, 0.85


def decide(pairs: DataFrame, p: str, thr: float, exclusive: bool = True, thr2: float | None = None) -> DataFrame:
    """Matches (i, j): score at least a threshold; each j keeps its best i if exclusive; the best pair of an i needs
    thr and its further ones thr2."""
    thr2 = thr if thr2 is None else thr2
    out = pairs.where(F.col(p) >= min(thr, thr2))
    if exclusive:
        out = best_of(out, "j", p, "i")
    if thr2 != thr:
        rk = F.row_number().over(Window.partitionBy("i").orderBy(F.desc(p), "j"))
        out = out.withColumn("__rk", rk).where(F.col(p) >= F.when(F.col("__rk") == 1, thr).otherwise(thr2)).drop("__rk")
    return out


def vetoed(country_match: Column, house_match: Column, jaro: Column) -> Column:
    """Conflicts that no score outweighs."""
    return (country_match == 0) | ((house_match == 0) & (jaro < JARO_HOUSE)) | (jaro < JARO_FLOOR)


def veto_decision(country_match: Column, house_match: Column, jaro: Column, p: Column, thr: float) -> Column:
    return F.when(vetoed(country_match, house_match, jaro), F.lit(False)).otherwise(p >= thr)


def judge_override(veto: Column, p: Column, judged_yes: Column, thr: float, band: tuple[float, float] = AMBIGUOUS) -> Column:
    """Inside the ambiguous band the judge's answer counts, outside it the score; a veto beats both."""
    return F.when(veto, F.lit(False)).when(p.between(*band) & judged_yes.isNotNull(), judged_yes).otherwise(p >= thr)


def parse_verdict(reply: Column) -> Column:
    """MATCH, NO_MATCH or UNCERTAIN from a judge's free text."""
    r = F.upper(F.trim(reply))
    no = F.contains(r, F.lit("NO_MATCH")) | F.contains(r, F.lit("NO MATCH"))
    return (
        F.when(r.startswith("MATCH"), F.lit("MATCH"))
        .when(r.startswith("NO_MATCH") | no, F.lit("NO_MATCH"))
        .when(F.contains(r, F.lit("MATCH")), F.lit("MATCH"))
        .otherwise(F.lit("UNCERTAIN"))
    )


def parse_match(reply: Column) -> Column:
    r = F.upper(reply)
    return F.contains(r, F.lit("MATCH")) & ~F.contains(r, F.lit("NO_MATCH"))


def parse_yes(reply: Column) -> Column:
    return F.contains(F.upper(reply), F.lit("YES"))


def yes_probability(yes_logprob: Column, no_logprob: Column, missing: float = -30.0) -> Column:
    """Softmax of the mass on Yes against No."""
    y, n = F.exp(F.coalesce(yes_logprob, F.lit(missing))), F.exp(F.coalesce(no_logprob, F.lit(missing)))
    return y / (y + n)


def borderline(pairs: DataFrame, p: str = "p2", band: tuple[float, float] = BORDERLINE) -> DataFrame:
    return pairs.where((F.col(p) >= band[0]) & (F.col(p) < band[1]))


def select_for_judge(pairs: DataFrame, p: str = "p2", ce: str = "ce", band: tuple[float, float] = JUDGED) -> DataFrame:
    return pairs.where(((F.col(p) + F.coalesce(ce, p)) / 2).between(*band))


def blend(p: Column, extras: list[Column], weights: list[float]) -> Column:
    """Weighted mean of p and further scores, a missing one read as p."""
    total = weights[0] * p
    for e, w in zip(extras, weights[1:]):
        total = total + w * F.coalesce(e, p)
    return total / sum(weights)
