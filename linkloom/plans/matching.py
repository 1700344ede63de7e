"""The matching pipeline over a records view: from tokens to decided pairs, and its trained form."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.fold import fold_distinct
from ..functions.text import norm_addr, norm_name
from ..operators import blocking, context, decide, features, learn, tokens
from ..sources.scratch import materialised


def prepare(sources: list[DataFrame], dictionary: dict[str, str] | None = None) -> DataFrame:
    """Record table of raw sources (entity_id, business_name, business_address, country): ids and normal forms.

    idx is dense and follows (source, entity_id).
    """
    raw = None
    for n, s in enumerate(sources, 1):
        one = s.select(F.lit(n).alias("src"), "entity_id", F.col("business_name").alias("name_raw"), F.col("business_address").alias("addr_raw"), "country").na.fill("")
        raw = one if raw is None else raw.unionByName(one)
    folded = fold_distinct(fold_distinct(raw, "name_raw", "__n", dictionary), "addr_raw", "__a", dictionary)
    named = folded.withColumns({"n": norm_name(F.col("__n"), F.col("name_raw")), "a": norm_addr(F.col("__a"), F.col("country"))})
    out = named.select(
        "src", "entity_id", "name_raw", "addr_raw", F.col("n.core").alias("name_core"), F.col("n.full").alias("name_full"), F.col("n.legal").alias("legal"), F.col("n.nums").alias("name_nums"),
        F.col("n.is_dom").alias("is_dom"), F.col("n.is_indic").alias("is_indic"), F.col("a.core").alias("addr_core"), F.col("a.state").alias("state"), F.col("a.nums").alias("addr_nums"), F.lower(F.trim("country")).alias("country_n"),
    )
    return dense_ids(out, ["src", "entity_id"], "idx")


def dense_ids(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Numbers rows 0, 1, ... in an order, without sorting all of them in one task: ranges first, then places within."""
    parts = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    sizes = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    base = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    nth = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return parts.withColumn("__nth", nth).join(F.broadcast(base), "__part").withColumn(name, F.col("__base") + F.col("__nth") - 1).drop("__part", "__nth", "__base")


def candidates(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidate pairs with block features, kept pairs without): the untrained part. The tokens, which are read several times, are a table."""
    t = materialised(tokens.typed_tokens(records), "tokens")
    w = tokens.token_weights(t)
    kept = blocking.two_sided_top(blocking.candidate_pairs(tokens.weighted_postings(t, w)))
    return blocking.block_features(kept, tokens.token_totals(t, w)), kept


def relative_score(pairs: DataFrame, out: str = "p") -> DataFrame:
    """A score without a model: a pair's weight over the best weight of its i."""
    return pairs.withColumn(out, F.round(F.col("bs") / F.max("bs").over(Window.partitionBy("i")), 4))


BLOCK_FEATURES = [
    "bs", "b_ntok", *[f"bs_{g}" for g in tokens.GROUPS], "b_rank_i", "b_rank_j", *[f"t_{g}_{s}" for g in tokens.GROUPS for s in "ij"], *[f"ov_{g}_{s}" for g in tokens.GROUPS for s in "ij"],
    "ov_name_s", "ov_an_s", "bs_gap_i", "ov_name_s_gap_i", "ov_an_s_gap_i", "nc_i", "nc_j", "bs_gap_j",
]
STRING_FEATURES = [*[f"n_{s}" for s in ("ratio", "tset", "tsort", "partial", "jw")], *[f"a_{s}" for s in ("ratio", "tset", "tsort", "partial")], "ns_ratio", "ns_partial", "ns_lev", "ns_len_i", "ns_len_j", "ns_contains", "sk_ratio", "sk_tset", "nf_tset"]
CONTEXT_FEATURES = [*[f"c_{c}_{k}_{s}" for c in context.CONTEXT for s in "ij" for k in ("rk", "gap")], "c_ncand_i", "c_ncand_j"]
SECOND_STAGE = ["p1", "p1_rk_i", "p1_rk_j", "p1_gap_i", "p1_gap_j", "p1_sum_i", "p1_sum_j", "p1_n05_i", "p1_n05_j", "n_i", "p1_other_j", "p1_second_i", "p1_margin_j", "bs", "b_ntok", "n_tset", "a_tset", "na_mean", "name_tok_jac", "addr_tok_jac", "num_jac"]


def first_stage_columns() -> list[str]:
    """All 114 model columns."""
    from ..operators.features import record_features, set_features

    names = [*set_features(), *record_features()]
    return [*BLOCK_FEATURES, "p0", "p0_rk_i", *STRING_FEATURES, *names, "na_prod", "na_mean", *CONTEXT_FEATURES]


@dataclass
class Matcher:
    """Pruner, first stage of two folds, second stage and thresholds. fit() needs the truth (i, j) of the records.

    Stages are written to tables at the model boundaries, as every fit reads its input many times.
    """

    rounds: int = 20
    keep: tuple[int, int, float] = (20, 3, 0.002)
    thresholds: tuple[float, float] = (0.5, 0.7)
    pruner: list = field(default_factory=list)
    first: list = field(default_factory=list)
    second: list = field(default_factory=list)

    def _features(self, records: DataFrame, labels: DataFrame | None) -> DataFrame:
        pairs, _ = candidates(records)
        if labels is not None:
            pairs = pairs.join(labels.select("i", "j", F.lit(1).alias("y")), ["i", "j"], "left").na.fill({"y": 0})
            pairs = materialised(pairs, "pairs")
            self.pruner = [learn.fit_gbt(pairs, BLOCK_FEATURES, "y", rounds=self.rounds)]
        scored = learn.score_with(self.pruner, pairs, BLOCK_FEATURES, "p0")
        k, r, p_min = self.keep
        kept = materialised(context.prune_keep(scored, "p0", k, r, p_min), "pruned")
        ready = features.record_columns(records).join(features.name_frequency(records), "idx")
        made = materialised(features.pair_features(kept, ready), "features")
        return materialised(context.add_context(made, context.CONTEXT, "c_"), "context")

    def fit(self, records: DataFrame, truth: DataFrame) -> DataFrame:
        """Returns the training pairs with out-of-fold p1 and the second-stage p2."""
        columns = first_stage_columns()
        made = self._features(records, truth).withColumn("fold", learn.fold_of(F.col("i")))
        fit = lambda df: learn.ensemble(df, columns, "y", rounds=self.rounds)
        scored, self.first = learn.out_of_fold(made, columns, "y", "fold", "p1", fit)
        second = materialised(context.score_context(materialised(scored, "p1"), "p1"), "second")
        self.second = [learn.fit_gbt(second.where("fold = 0"), SECOND_STAGE, "y", rounds=self.rounds, depth=4, step=0.05)]
        return learn.score_with(self.second, second, SECOND_STAGE, "p2")

    def score(self, records: DataFrame) -> DataFrame:
        made = learn.score_with(self.first, self._features(records, None), first_stage_columns(), "p1")
        return learn.score_with(self.second, context.score_context(materialised(made, "p1"), "p1"), SECOND_STAGE, "p2")

    def predict(self, records: DataFrame) -> DataFrame:
        thr, thr2 = self.thresholds
        return decide.decide(self.score(records), "p2", thr, True, thr2)


def flagship(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Untrained slice end to end: one row a source-1 record with its matches."""
    from ..sources.tables import result_lists

    _, kept = candidates(records)
    return result_lists(decide.decide(relative_score(kept), "p", 0.6, True), records)
