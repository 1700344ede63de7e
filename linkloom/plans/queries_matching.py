"""Registered queries: tokens, candidates, features, decisions and their evaluation, over the records view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


from ..operators import blocking, context, decide, dense, evaluate, features, learn, rerank, tokens
from ..sources.scratch import materialised
from ..sources.tables import result_lists
from ..sources.validate import content_errors
from .matching import candidates, flagship, relative_score
from .records import RECORDS_SQL, TRUTH_SQL, records_view, table, truth_classes, truth_view

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


# --- SQL counterparts ---------------------------------------------------------------------------------------------


def skeleton_sql(x: str) -> str:
    from ..functions.vocab import SKELETON

    t = x
    for a, b in [*SKELETON, ("c", "k")]:
        t = f"replace({t}, '{a}', '{b}')"
    return t


def collapse_sql(x: str) -> str:
    for ch in "abcdefghijklmnopqrstuvwxyz0123456789":
        x = f"regexp_replace({x}, '{ch}{ch}+', '{ch}', 'g')"
    return x


SKELETON_SQL = f"""vocab AS (SELECT DISTINCT unnest(list_concat(names, addrs)) AS w FROM words),
mapped AS (SELECT w, {skeleton_sql('w')} AS m FROM vocab),
skel AS (SELECT w, CASE WHEN regexp_full_match(w, '[0-9]+') THEN w ELSE {collapse_sql("substr(m, 1, 1) || regexp_replace(substr(m, 2), '[aeiouh]', '', 'g')")} END AS sk FROM mapped)"""

TOKENS_SQL = f"""{RECORDS_SQL},
words AS (SELECT idx, src, country_n, list_filter(string_split(name_core, ' '), lambda x: x <> '') AS names,
                 list_filter(string_split(addr_core, ' '), lambda x: x <> '') AS addrs FROM records),
{SKELETON_SQL},
nw0 AS (SELECT idx, unnest(names) AS w, generate_subscripts(names, 1) AS pos FROM words),
nw AS (SELECT idx, nw0.w, pos, sk FROM nw0 JOIN skel USING (w) WHERE length(nw0.w) >= 2),
aw0 AS (SELECT idx, unnest(addrs) AS w, generate_subscripts(addrs, 1) AS pos, addrs FROM words),
aw AS (SELECT idx, w, addrs[pos + 1] AS nxt, regexp_full_match(w, '[0-9]+') AS num, regexp_full_match(addrs[pos + 1], '[0-9]+') AS nnum FROM aw0),
whole AS (SELECT idx, array_to_string(names, '') AS f FROM words),
sks AS (SELECT idx, string_agg(sk, '' ORDER BY pos) AS s FROM nw WHERE length(sk) >= 2 GROUP BY idx),
x1 AS (SELECT idx, unnest(list_filter(names, lambda x: length(x) >= 3)[1:5]) AS n FROM words),
x2 AS (SELECT idx, unnest(list_filter(addrs, lambda x: length(x) >= 4 AND NOT regexp_full_match(x, '[0-9]+'))[1:8]) AS a FROM words),
toks AS (
  SELECT idx, 'n' AS typ, w AS token FROM nw UNION SELECT idx, 'k', sk FROM nw WHERE length(sk) >= 3
  UNION SELECT idx, 'p', substr(f, 1, 5) FROM whole WHERE length(f) >= 5
  UNION SELECT idx, 'a', w FROM aw WHERE NOT num AND length(w) >= 3 UNION SELECT idx, 'd', w FROM aw WHERE num
  UNION SELECT idx, 'h', aw.w || '_' || substr(sk, 1, 3) FROM aw JOIN skel ON skel.w = nxt WHERE num AND NOT nnum
  UNION SELECT idx, 'x', n || '|' || a FROM x1 JOIN x2 USING (idx)
  UNION SELECT idx, 'b', w || '_' || nxt FROM aw WHERE nxt IS NOT NULL
  UNION SELECT idx, 'f', f FROM whole WHERE length(f) >= 3
  UNION SELECT idx, 'm', f || '|' || w FROM whole JOIN aw USING (idx) WHERE length(f) >= 3 AND num
  UNION SELECT idx, 'c', f || '|' || w FROM whole JOIN aw USING (idx) WHERE length(f) >= 3 AND NOT num AND length(w) >= 4
  UNION SELECT idx, 's', s || '|' || w FROM sks JOIN aw USING (idx) WHERE num),
tokens AS (SELECT idx, src, country_n, typ, token FROM toks JOIN records USING (idx))"""

GROUP_SQL = "CASE " + " ".join(f"WHEN typ IN ({', '.join(repr(c) for c in letters)}) THEN '{g}'" for g, letters in tokens.GROUPS.items()) + " END"

WEIGHTS_SQL = f"""{TOKENS_SQL},
nc AS (SELECT country_n, count(DISTINCT idx) AS n_country FROM tokens GROUP BY 1),
weights AS (SELECT country_n, typ, token, df, n_country, ln(n_country) - ln(df) AS w
            FROM (SELECT country_n, typ, token, count(*) AS df FROM tokens GROUP BY ALL) JOIN nc USING (country_n))"""


def sums_sql(prefix: str, rounding: int = 4) -> str:
    return ", ".join(f"round(sum(CASE WHEN grp = '{g}' THEN w ELSE 0.0 END), {rounding}) AS {prefix}_{g}" for g in tokens.GROUPS)


PAIRS_SQL = f"""{WEIGHTS_SQL},
postings AS (SELECT *, {GROUP_SQL} AS grp FROM tokens JOIN weights USING (country_n, typ, token) WHERE df <= 2000),
pairs AS (SELECT a.idx AS i, b.idx AS j, round(sum(a.w), 4) AS bs, count(*) AS b_ntok, {sums_sql('bs').replace('grp', 'a.grp').replace('THEN w', 'THEN a.w')}
          FROM postings a JOIN postings b ON a.country_n = b.country_n AND a.typ = b.typ AND a.token = b.token AND a.src = 1 AND b.src <> 1
          WHERE a.df <= 300 * exp(0.5) GROUP BY ALL)"""

TOP_SQL = f"""{PAIRS_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY bs DESC, j) AS ri, row_number() OVER (PARTITION BY j ORDER BY bs DESC, i) AS rj FROM pairs),
kept AS (SELECT * EXCLUDE (ri, rj), least(ri, 41) AS b_rank_i, least(rj, 4) AS b_rank_j FROM ranked WHERE ri <= 40 OR rj <= 3)"""

TOTALS_SQL = f"totals AS (SELECT idx, {sums_sql('t')} FROM (SELECT *, {GROUP_SQL} AS grp FROM tokens JOIN weights USING (country_n, typ, token)) GROUP BY idx)"

SCORED_SQL = f"{TOP_SQL},\nscored AS (SELECT i, j, bs, b_ntok, round(bs / max(bs) OVER (PARTITION BY i), 4) AS p FROM kept)"

DECIDED_SQL = f"{SCORED_SQL},\nbest AS (SELECT * FROM scored WHERE p >= 0.6 QUALIFY row_number() OVER (PARTITION BY j ORDER BY p DESC, i) = 1)"


def f_sql(tp: str, n_pred: str, n_true: str) -> str:
    return f"CASE WHEN {n_pred} = 0 AND {n_true} = 0 THEN 1.0 WHEN {tp} = 0 THEN 0.0 ELSE 1.25 * ({tp} / {n_pred}) * ({tp} / {n_true}) / (0.25 * ({tp} / {n_pred}) + {tp} / {n_true}) END"


# --- tokens and candidates ------------------------------------------------------------------------------------------


@query("records_view", f"WITH {RECORDS_SQL} SELECT idx, entity_id, src, country_n, name_core, addr_core FROM records")
def _(spark: SparkSession, d: str) -> DataFrame:
    return records_view(spark, d)


@query("typed_tokens", f"WITH {TOKENS_SQL} SELECT * FROM tokens")
def _(spark, d):
    return tokens.typed_tokens(records_view(spark, d))


def _tokens(spark, d):
    t = tokens.typed_tokens(records_view(spark, d))
    return t, tokens.token_weights(t)


@query("token_idf", f"WITH {WEIGHTS_SQL} SELECT country_n, typ, token, df, n_country, round(w, 6) AS w FROM weights")
def _(spark, d):
    return _tokens(spark, d)[1].withColumn("w", F.round("w", 6))


@query("token_totals", f"WITH {WEIGHTS_SQL}, {TOTALS_SQL} SELECT * FROM totals")
def _(spark, d):
    return tokens.token_totals(*_tokens(spark, d))


@query("candidate_pairs", f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def _(spark, d):
    return blocking.candidate_pairs(tokens.weighted_postings(*_tokens(spark, d)))


def _kept(spark, d) -> DataFrame:
    return candidates(records_view(spark, d))[1]


def _scored(spark, d) -> DataFrame:
    return relative_score(_kept(spark, d)).select("i", "j", "bs", "b_ntok", "p")


@query("candidate_topk", f"WITH {TOP_SQL} SELECT * FROM kept")
def _(spark, d):
    return _kept(spark, d)


@query(
    "block_features",
    f"""WITH {TOP_SQL}, {TOTALS_SQL}, f AS (
SELECT k.i, k.j, bs, bs_name / (ti.t_name + 1e-3) AS ov_name_i, bs_name / (tj.t_name + 1e-3) AS ov_name_j,
       bs_name / (ti.t_name + 1e-3) + bs_name / (tj.t_name + 1e-3) AS ns,
       bs_addr / (ti.t_addr + 1e-3) + bs_addr / (tj.t_addr + 1e-3) + bs_num / (ti.t_num + 1e-3) + bs_num / (tj.t_num + 1e-3) AS an
FROM kept k JOIN totals ti ON ti.idx = k.i JOIN totals tj ON tj.idx = k.j)
SELECT i, j, round(ov_name_i, 4) AS ov_name_i, round(ov_name_j, 4) AS ov_name_j, round(ns, 4) AS ov_name_s, round(an, 4) AS ov_an_s,
       round(max(bs) OVER (PARTITION BY i) - bs, 4) AS bs_gap_i, round(max(ns) OVER (PARTITION BY i) - ns, 4) AS ov_name_s_gap_i,
       round(max(an) OVER (PARTITION BY i) - an, 4) AS ov_an_s_gap_i, count(*) OVER (PARTITION BY i) AS nc_i,
       round(max(bs) OVER (PARTITION BY j) - bs, 4) AS bs_gap_j, count(*) OVER (PARTITION BY j) AS nc_j FROM f""",
)
def _(spark, d):
    made, _ = candidates(records_view(spark, d))
    cols = ["ov_name_i", "ov_name_j", "ov_name_s", "ov_an_s", "bs_gap_i", "ov_name_s_gap_i", "ov_an_s_gap_i", "bs_gap_j"]
    return made.select("i", "j", *[F.round(c, 4).alias(c) for c in cols], "nc_i", "nc_j")


@query("name_frequency", f"WITH {RECORDS_SQL} SELECT idx, count(*) FILTER (src = 1) OVER w AS nf_s1, count(*) OVER w AS nf_all FROM records WINDOW w AS (PARTITION BY country_n, name_core)")
def _(spark, d):
    return features.name_frequency(records_view(spark, d))


# --- features -------------------------------------------------------------------------------------------------------


def _attached(spark, d) -> DataFrame:
    records = records_view(spark, d)
    ready = features.record_columns(records).join(features.name_frequency(records), "idx")
    for c in ("is_dom", "is_indic"):
        ready = ready.withColumn(c, F.lit(0))
    return features.attach(_kept(spark, d).select("i", "j"), ready.withColumn("name_full", F.col("name_core")), features.ATTACHED)


@query(
    "set_features",
    f"""WITH {TOP_SQL}, s AS (
SELECT i, j, a.name_core AS na, b.name_core AS nb, string_split(a.name_core, ' ') AS ni, string_split(b.name_core, ' ') AS nj, string_split(a.addr_core, ' ') AS ai, string_split(b.addr_core, ' ') AS aj,
       list_filter(string_split(a.addr_core, ' '), lambda x: regexp_full_match(x, '[0-9]+'))[1] AS f1, list_filter(string_split(b.addr_core, ' '), lambda x: regexp_full_match(x, '[0-9]+'))[1] AS f2
FROM kept JOIN records a ON a.idx = i JOIN records b ON b.idx = j)
SELECT i, j, round(len(list_intersect(ni, nj)) / greatest(len(list_distinct(list_concat(ni, nj))), 1), 4) AS name_tok_jac,
       round(len(list_intersect(ni, nj)) / greatest(least(len(ni), len(nj)), 1), 4) AS name_tok_min_ov,
       round(len(list_intersect(ai, aj)) / greatest(len(list_distinct(list_concat(ai, aj))), 1), 4) AS addr_tok_jac,
       round(len(list_intersect(ai, aj)) / greatest(least(len(ai), len(aj)), 1), 4) AS addr_tok_min_ov,
       coalesce(CAST(f1 = f2 AS INTEGER), -1) AS num_first_eq,
       CAST(substr(na, 1, 3) = substr(nb, 1, 3) AND strlen(na) >= 3 AS INTEGER) AS prefix3_match, abs(strlen(na) - strlen(nb)) AS name_char_len_diff FROM s""",
)
def _(spark, d):
    f = features.set_features()
    a = _attached(spark, d)
    rounded = ["name_tok_jac", "name_tok_min_ov", "addr_tok_jac", "addr_tok_min_ov"]
    return a.select("i", "j", *[F.round(f[c], 4).alias(c) for c in rounded], *[f[c].alias(c) for c in ("num_first_eq", "prefix3_match", "name_char_len_diff")])


@query(
    "record_features",
    f"""WITH {TOP_SQL}, r AS (SELECT *, len(string_split(name_core, ' ')) AS n_ntok, len(string_split(addr_core, ' ')) AS a_ntok, count(*) FILTER (src = 1) OVER w AS nf_s1, count(*) OVER w AS nf_all
  FROM records WINDOW w AS (PARTITION BY country_n, name_core))
SELECT i, j, b.src AS src_j, a.n_ntok AS n_ntok_i, b.n_ntok AS n_ntok_j, a.a_ntok AS a_ntok_i, b.a_ntok AS a_ntok_j, CAST(b.addr_core = '' AS INTEGER) AS a_empty_j,
       a.nf_s1 AS nf_s1_i, b.nf_s1 AS nf_s1_j, b.nf_all AS nf_all_j FROM kept JOIN r a ON a.idx = i JOIN r b ON b.idx = j""",
)
def _(spark, d):
    f = features.record_features()
    return _attached(spark, d).select("i", "j", *[e.alias(c) for c, e in f.items() if c not in ("is_dom_j", "is_indic_j")])


@query(
    "tri_state_flags",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 10 AND l_discount > 0.02 THEN CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END ELSE 0 END AS flag FROM lineitem""",
)
def _(spark, d):
    from ..functions.similarity import tri_state

    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", tri_state((F.col("l_quantity") > 10) & (F.col("l_discount") > 0.02), F.col("l_returnflag") == "R").alias("flag"))


@query(
    "levenshtein_pairs",
    f"WITH {TOP_SQL} SELECT i, j, levenshtein(replace(a.name_core, ' ', ''), replace(b.name_core, ' ', '')) AS ns_lev FROM kept JOIN records a ON a.idx = i JOIN records b ON b.idx = j",
)
def _(spark, d):
    return _attached(spark, d).select("i", "j", F.levenshtein("name_ns_i", "name_ns_j").cast("long").alias("ns_lev"))


@query(
    "jaro_winkler_pairs",
    f"WITH {TOP_SQL} SELECT i, j, round(jaro_winkler_similarity(a.name_core, b.name_core), 4) AS n_jw FROM kept JOIN records a ON a.idx = i JOIN records b ON b.idx = j",
)
def _(spark, d):
    from ..functions.similarity import string_scores

    return _attached(spark, d).select("i", "j", F.round(string_scores("jw")("name_core_i", "name_core_j")["jw"], 4).alias("n_jw"))


@query("fuzzy_pairs")
def _(spark, d):
    wanted = ["n_ratio", "n_tset", "n_tsort", "n_partial", "a_tset", "a_partial", "sk_ratio", "nf_tset"]
    made = features.string_features(_attached(spark, d), wanted)
    return made.select("i", "j", *[F.round(c, 4).alias(c) for c in wanted])


CONTEXT_SQL = ", ".join(
    f"rank() OVER (PARTITION BY {s} ORDER BY {c} DESC) AS {c}_rk_{s}, round(max({c}) OVER (PARTITION BY {s}) - {c}, 4) AS {c}_gap_{s}" for c in ("bs", "p") for s in "ij"
)


@query("context_features", f"WITH {SCORED_SQL} SELECT i, j, {CONTEXT_SQL}, count(*) OVER (PARTITION BY i) AS ncand_i, count(*) OVER (PARTITION BY j) AS ncand_j FROM scored")
def _(spark, d):
    made = context.add_context(_scored(spark, d), ["bs", "p"])
    gaps = [c for c in made.columns if "_gap_" in c]
    return made.drop("bs", "p", "b_ntok").withColumns({c: F.round(c, 4) for c in gaps})


@query(
    "stage2_context",
    f"""WITH {SCORED_SQL}, r AS (SELECT i, j, p, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS ri, row_number() OVER (PARTITION BY j ORDER BY p DESC, i) AS rj FROM scored),
s AS (SELECT *, coalesce(CASE WHEN rj = 1 THEN max(CASE WHEN rj = 2 THEN p END) OVER (PARTITION BY j) ELSE max(p) OVER (PARTITION BY j) END, 0.0) AS other FROM r)
SELECT i, j, ri AS p_rk_i, rj AS p_rk_j, round(max(p) OVER (PARTITION BY i) - p, 4) AS p_gap_i, round(max(p) OVER (PARTITION BY j) - p, 4) AS p_gap_j,
       round(sum(p) OVER (PARTITION BY i), 4) AS p_sum_i, round(sum(p) OVER (PARTITION BY j), 4) AS p_sum_j,
       CAST(sum(CASE WHEN p > 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY i) AS BIGINT) AS p_n05_i, CAST(sum(CASE WHEN p > 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY j) AS BIGINT) AS p_n05_j,
       count(*) OVER (PARTITION BY i) AS n_i, other AS p_other_j, coalesce(max(CASE WHEN ri = 2 THEN p END) OVER (PARTITION BY i), 0.0) AS p_second_i, round(p - other, 4) AS p_margin_j FROM s""",
)
def _(spark, d):
    made = context.score_context(_scored(spark, d), "p").drop("bs", "b_ntok", "p")
    return made.withColumns({c: F.round(c, 4) for c in ("p_gap_i", "p_gap_j", "p_sum_i", "p_sum_j", "p_margin_j")})


@query(
    "prune_keep",
    f"""WITH {SCORED_SQL}, a AS (SELECT i, j, p, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS p_rk_i FROM scored),
b AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY p DESC, i) AS p_rk_j FROM a WHERE p_rk_i <= 20 AND p >= 0.05)
SELECT * FROM b WHERE p_rk_i <= 5 OR p_rk_j <= 2""",
)
def _(spark, d):
    return context.prune_keep(_scored(spark, d).select("i", "j", "p"), "p", 5, 2, 0.05)


# --- decisions ------------------------------------------------------------------------------------------------------


@query("decide_single", f"WITH {DECIDED_SQL} SELECT i, j, p FROM best")
def _(spark, d):
    return decide.decide(_scored(spark, d), "p", 0.6).select("i", "j", "p")


@query(
    "decide_two_threshold",
    f"""WITH {SCORED_SQL}, b AS (SELECT * FROM scored WHERE p >= 0.5 QUALIFY row_number() OVER (PARTITION BY j ORDER BY p DESC, i) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS rk FROM b) SELECT i, j, p FROM r WHERE p >= CASE WHEN rk = 1 THEN 0.5 ELSE 0.7 END""",
)
def _(spark, d):
    return decide.decide(_scored(spark, d), "p", 0.5, True, 0.7).select("i", "j", "p")


MACRO_SQL = f"""n_true AS (SELECT i, count(*) AS nt FROM truth GROUP BY i),
n_pred AS (SELECT i, count(*) AS np, count(t.j) AS tp FROM best LEFT JOIN truth t USING (i, j) GROUP BY i)
SELECT round(avg({f_sql('coalesce(tp, 0)', 'coalesce(np, 0)', 'coalesce(nt, 0)')}), 6) AS f
FROM (SELECT idx AS i FROM records WHERE src = 1) LEFT JOIN n_true USING (i) LEFT JOIN n_pred USING (i)"""


@query("macro_f05", f"WITH {DECIDED_SQL}, {TRUTH_SQL}, {MACRO_SQL}")
def _(spark, d):
    records = records_view(spark, d)
    ones = records.where("src = 1").select(F.col("idx").alias("i"))
    found = evaluate.macro_f(decide.decide(_scored(spark, d), "p", 0.6), truth_view(spark, d), ones)
    return found.select(F.round("f", 6).alias("f"))


@query(
    "threshold_sweep",
    f"""WITH {SCORED_SQL}, {TRUTH_SQL}, g AS (SELECT round(0.3 + 0.05 * x, 4) AS thr FROM generate_series(0, 13) s(x)),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY j ORDER BY p DESC, i) = 1),
n_true AS (SELECT i, count(*) AS nt FROM truth GROUP BY i),
m AS (SELECT thr, i, count(*) AS np, count(t.j) AS tp FROM g JOIN best ON p >= thr LEFT JOIN truth t USING (i, j) GROUP BY thr, i)
SELECT thr, round(avg({f_sql('coalesce(tp, 0)', 'coalesce(np, 0)', 'coalesce(nt, 0)')}), 6) AS f
FROM g CROSS JOIN (SELECT idx AS i FROM records WHERE src = 1) LEFT JOIN n_true USING (i) LEFT JOIN m USING (thr, i) GROUP BY thr""",
)
def _(spark, d):
    grid = evaluate.threshold_grid(spark, 0.3, 0.95, 0.05)
    ones = records_view(spark, d).where("src = 1").select(F.col("idx").alias("i"))
    found = evaluate.macro_f(evaluate.sweep_matches(_scored(spark, d), "p", grid, True), truth_view(spark, d), ones, by=["thr"])
    return found.select("thr", F.round("f", 6).alias("f"))


@query(
    "pair_f_sweep",
    f"""WITH {SCORED_SQL}, {TRUTH_SQL}, g AS (SELECT round(0.3 + 0.1 * x, 4) AS thr FROM generate_series(0, 6) s(x)),
l AS (SELECT s.*, CASE WHEN t.i IS NULL THEN 0 ELSE 1 END AS y FROM scored s LEFT JOIN truth t USING (i, j)), c AS (SELECT thr, CAST(sum(y) AS BIGINT) AS tp, count(*) AS n_pred FROM l JOIN g ON p >= thr GROUP BY thr),
n AS (SELECT CAST(sum(y) AS BIGINT) AS n_true FROM l) SELECT thr, tp, n_pred, n_true, round({f_sql('tp', 'n_pred', 'n_true')}, 6) AS f FROM c, n""",
)
def _(spark, d):
    labelled = _labelled(spark, d)
    found = evaluate.pair_f_sweep(labelled, "p", "y", evaluate.threshold_grid(spark, 0.3, 0.9, 0.1))
    return found.withColumn("f", F.round("f", 6))


def _labelled(spark, d) -> DataFrame:
    """Scored pairs and whether truth_view() has them, which needs the classes of equal heads and not all pairs of a class."""
    return _labels(spark, d, _heads(spark, d, _scored(spark, d), "i")).select("i", "j", "bs", "b_ntok", "p", "y")


def _heads(spark, d, pairs: DataFrame, side: str) -> DataFrame:
    return pairs.join(truth_classes(spark, d).select(F.col("doc_id").alias(side), F.col("head_id").alias(f"head_{side}")), side, "left")


def _labels(spark, d, pairs: DataFrame) -> DataFrame:
    y = F.coalesce((F.col("head_i") == F.col("head_j")).cast("int"), F.lit(0))
    return _heads(spark, d, pairs, "j").withColumn("y", y).drop("head_i", "head_j")


@query(
    "two_threshold_sweep",
    f"""WITH {SCORED_SQL}, {TRUTH_SQL}, g AS (SELECT round(0.4 + 0.1 * a, 4) AS thr, round(0.4 + 0.1 * a + 0.1 * b, 4) AS thr2 FROM generate_series(0, 3) s(a), generate_series(0, 2) t(b)),
b0 AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY j ORDER BY p DESC, i) = 1), b AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS rk FROM b0),
n_true AS (SELECT i, count(*) AS nt FROM truth GROUP BY i),
m AS (SELECT thr, thr2, i, count(*) AS np, count(t.j) AS tp FROM g JOIN b ON p >= CASE WHEN rk = 1 THEN thr ELSE thr2 END LEFT JOIN truth t USING (i, j) GROUP BY thr, thr2, i)
SELECT thr, thr2, round(avg({f_sql('coalesce(tp, 0)', 'coalesce(np, 0)', 'coalesce(nt, 0)')}), 6) AS f
FROM g CROSS JOIN (SELECT idx AS i FROM records WHERE src = 1) LEFT JOIN n_true USING (i) LEFT JOIN m USING (thr, thr2, i) GROUP BY thr, thr2""",
)
def _(spark, d):
    a, b = spark.range(4).toDF("a"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("b")
    low = F.lit(0.4) + F.lit(0.1) * F.col("a")
    grid = a.select("a", b).select(F.round(low, 4).alias("thr"), F.round(low + F.lit(0.1) * F.col("b"), 4).alias("thr2"))
    ones = records_view(spark, d).where("src = 1").select(F.col("idx").alias("i"))
    found = evaluate.macro_f(evaluate.two_threshold_matches(_scored(spark, d), "p", grid), truth_view(spark, d), ones, by=["thr", "thr2"])
    return found.select("thr", "thr2", F.round("f", 6).alias("f"))


@query(
    "recall_report",
    f"""WITH {TOP_SQL}, {TRUTH_SQL} SELECT country_n, count(*) AS n_true, count(k.i) AS n_hit, round(count(k.i) / count(*), 4) AS recall
FROM truth t LEFT JOIN kept k USING (i, j) JOIN records r ON r.idx = t.i GROUP BY country_n""",
)
def _(spark, d):
    return evaluate.recall_report(truth_view(spark, d), _kept(spark, d), records_view(spark, d))


@query("borderline_band", f"WITH {SCORED_SQL} SELECT i, j, p, a.entity_id AS entity_id_1, b.entity_id AS entity_id_2, a.name_core AS name_core_1, b.addr_core AS addr_core_2 FROM scored JOIN records a ON a.idx = i JOIN records b ON b.idx = j WHERE p >= 0.15 AND p < 0.95")
def _(spark, d):
    made = rerank.export_pairs(_scored(spark, d), records_view(spark, d), "p")
    return made.select("i", "j", "p", "entity_id_1", "entity_id_2", "name_core_1", "addr_core_2")


def _opinions(spark, d) -> DataFrame:
    """p with a second and a third opinion, made from ids so that both engines agree; some are missing."""
    s = _scored(spark, d)
    ce = F.when((F.col("i") + F.col("j")) % 3 != 0, F.round(F.pmod(F.col("i") * 7 + F.col("j") * 3, F.lit(101)) / 100, 4))
    judge = F.when((F.col("i") + F.col("j")) % 5 == 0, F.round(F.pmod(F.col("i") * 3 + F.col("j") * 11, F.lit(101)) / 100, 4))
    return s.select("i", "j", "p", ce.alias("ce"), judge.alias("judge"))


OPINIONS_SQL = """opinions AS (SELECT i, j, p, CASE WHEN (i + j) % 3 <> 0 THEN round(((i * 7 + j * 3) % 101) / 100, 4) END AS ce,
  CASE WHEN (i + j) % 5 = 0 THEN round(((i * 3 + j * 11) % 101) / 100, 4) END AS judge FROM scored)"""


@query("blend_scores", f"WITH {SCORED_SQL}, {OPINIONS_SQL} SELECT i, j, round((p + 2 * coalesce(ce, p) + 0.5 * coalesce(judge, p)) / 3.5, 6) AS s FROM opinions")
def _(spark, d):
    return _opinions(spark, d).select("i", "j", F.round(decide.blend(F.col("p"), [F.col("ce"), F.col("judge")], [1, 2, 0.5]), 6).alias("s"))


@query("judge_selection", f"WITH {SCORED_SQL}, {OPINIONS_SQL} SELECT i, j, p, ce FROM opinions WHERE (p + coalesce(ce, p)) / 2 BETWEEN 0.3 AND 0.85")
def _(spark, d):
    return decide.select_for_judge(_opinions(spark, d), "p", "ce").select("i", "j", "p", "ce")


@query(
    "blend_sweep",
    f"""WITH {SCORED_SQL}, {OPINIONS_SQL}, {TRUTH_SQL}, w AS (SELECT * FROM (VALUES (0.0, 0.0), (1.0, 0.0), (2.0, 1.0)) t(w_ce, w_judge)), g AS (SELECT * FROM (VALUES (0.4), (0.6), (0.8)) t(thr)),
s AS (SELECT i, j, CAST(w_ce AS DOUBLE) AS w_ce, CAST(w_judge AS DOUBLE) AS w_judge, round((p + w_ce * coalesce(ce, p) + w_judge * coalesce(judge, p)) / (1 + w_ce + w_judge), 6) AS s FROM opinions, w),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY w_ce, w_judge, j ORDER BY s DESC, i) = 1), n_true AS (SELECT i, count(*) AS nt FROM truth GROUP BY i),
m AS (SELECT w_ce, w_judge, thr, i, count(*) AS np, count(t.j) AS tp FROM g JOIN best ON s >= thr LEFT JOIN truth t USING (i, j) GROUP BY ALL)
SELECT CAST(w.w_ce AS DOUBLE) AS w_ce, CAST(w.w_judge AS DOUBLE) AS w_judge, CAST(g.thr AS DOUBLE) AS thr, round(avg({f_sql('coalesce(tp, 0)', 'coalesce(np, 0)', 'coalesce(nt, 0)')}), 6) AS f
FROM w CROSS JOIN g CROSS JOIN (SELECT idx AS i FROM records WHERE src = 1) r LEFT JOIN n_true ON n_true.i = r.i LEFT JOIN m ON m.i = r.i AND m.w_ce = w.w_ce AND m.w_judge = w.w_judge AND m.thr = g.thr GROUP BY 1, 2, 3""",
)
def _(spark, d):
    ones = records_view(spark, d).where("src = 1").select(F.col("idx").alias("i"))
    found = rerank.blend_sweep(_opinions(spark, d), truth_view(spark, d), ones, [0.4, 0.6, 0.8], [(1, 0, 0), (1, 1, 0), (1, 2, 1)], "p")
    return found.withColumn("f", F.round("f", 6))


def _rule_input(spark, d) -> DataFrame:
    s = _scored(spark, d)
    return s.select("i", "j", "p", (F.pmod(F.col("i") + F.col("j"), F.lit(7)).cast("int") - 1).alias("c"), (F.pmod(F.col("j"), F.lit(3)).cast("int") - 1).alias("h"), F.round(F.pmod(F.col("i") * 5 + F.col("j"), F.lit(100)) / 100, 4).alias("jaro"))


RULE_SQL = "rule AS (SELECT i, j, p, CAST((i + j) % 7 AS INTEGER) - 1 AS c, CAST(j % 3 AS INTEGER) - 1 AS h, round(((i * 5 + j) % 100) / 100, 4) AS jaro FROM scored)"
VETO_SQL = "(c = 0 OR (h = 0 AND jaro < 0.85) OR jaro < 0.4)"


@query("veto_decision", f"WITH {SCORED_SQL}, {RULE_SQL} SELECT i, j, CASE WHEN {VETO_SQL} THEN false ELSE p >= 0.5 END AS is_match FROM rule")
def _(spark, d):
    return _rule_input(spark, d).select("i", "j", decide.veto_decision(F.col("c"), F.col("h"), F.col("jaro"), F.col("p"), 0.5).alias("is_match"))


@query("llm_override", f"WITH {SCORED_SQL}, {RULE_SQL} SELECT i, j, CASE WHEN {VETO_SQL} THEN false WHEN p BETWEEN 0.35 AND 0.75 AND i % 4 <> 0 THEN i % 4 = 1 ELSE p >= 0.5 END AS is_match FROM rule")
def _(spark, d):
    r = _rule_input(spark, d)
    yes = F.when(F.col("i") % 4 != 0, F.col("i") % 4 == 1)
    return r.select("i", "j", decide.judge_override(decide.vetoed(F.col("c"), F.col("h"), F.col("jaro")), F.col("p"), yes, 0.5).alias("is_match"))


REPLY_SQL = "CASE conv_id % 5 WHEN 0 THEN 'match: ' || role WHEN 1 THEN 'No match, sorry' WHEN 2 THEN 'NO_MATCH because ' || role WHEN 3 THEN 'It is a match. Yes' ELSE coalesce(text, '') END"


@query(
    "llm_parse",
    f"""WITH r AS (SELECT conv_id, turn, upper(trim({REPLY_SQL})) AS r FROM conversations)
SELECT conv_id, turn, CASE WHEN starts_with(r, 'MATCH') THEN 'MATCH' WHEN starts_with(r, 'NO_MATCH') OR contains(r, 'NO_MATCH') OR contains(r, 'NO MATCH') THEN 'NO_MATCH' WHEN contains(r, 'MATCH') THEN 'MATCH' ELSE 'UNCERTAIN' END AS verdict,
       contains(r, 'MATCH') AND NOT contains(r, 'NO_MATCH') AS is_match, contains(r, 'YES') AS is_yes FROM r""",
)
def _(spark, d):
    c = table(spark, d, "conversations")
    k = F.col("conv_id") % 5
    reply = (
        F.when(k == 0, F.concat(F.lit("match: "), "role")).when(k == 1, F.lit("No match, sorry")).when(k == 2, F.concat(F.lit("NO_MATCH because "), "role")).when(k == 3, F.lit("It is a match. Yes")).otherwise(F.coalesce("text", F.lit("")))
    )
    return c.select("conv_id", "turn", decide.parse_verdict(reply).alias("verdict"), decide.parse_match(reply).alias("is_match"), decide.parse_yes(reply).alias("is_yes"))


@query("yes_probability", "SELECT event_id, round(exp(y) / (exp(y) + exp(n)), 6) AS p FROM (SELECT event_id, -(event_id % 7) / 2 AS y, CASE WHEN event_id % 3 = 0 THEN -30.0 ELSE -(event_id % 5) / 2 END AS n FROM events)")
def _(spark, d):
    e = table(spark, d, "events")
    no = F.when(F.col("event_id") % 3 != 0, -(F.col("event_id") % 5) / 2)
    return e.select("event_id", F.round(decide.yes_probability(-(F.col("event_id") % 7) / 2, no), 6).alias("p"))


@query(
    "ranked_auc",
    """WITH s AS (SELECT doc_id, quality, round(n_chars / 100, 0) AS score FROM labels JOIN documents USING (doc_id)), r AS (SELECT *, row_number() OVER (ORDER BY score, doc_id) AS rk FROM s)
SELECT round((sum(CASE WHEN quality = 1 THEN rk ELSE 0 END) - sum(quality) * (sum(quality) + 1) / 2) / (sum(quality) * (count(*) - sum(quality))), 6) AS auc FROM r""",
)
def _(spark, d):
    s = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return evaluate.auc(s.select("doc_id", "quality", F.round(F.col("n_chars") / 100, 0).alias("score")), "score", "quality", "doc_id")


# --- results --------------------------------------------------------------------------------------------------------

LISTS_SQL = """lists AS (SELECT r.entity_id AS source1_entity_id, coalesce(string_agg(b.entity_id, ',' ORDER BY b.entity_id), '') AS matched_entity_ids
  FROM (SELECT * FROM records WHERE src = 1) r LEFT JOIN best ON best.i = r.idx LEFT JOIN records b ON b.idx = best.j GROUP BY r.entity_id)"""


@query("submission_lists", f"WITH {DECIDED_SQL}, {LISTS_SQL} SELECT * FROM lists")
def _(spark, d):
    return flagship(spark, records_view(spark, d))


BROKEN = "CASE WHEN idx % 11 = 0 THEN matched_entity_ids || ',S1-0' WHEN idx % 11 = 1 THEN matched_entity_ids || ',S2-999999999' WHEN idx % 11 = 2 THEN 'X-1,X-1' ELSE matched_entity_ids END"


@query(
    "validate_submission",
    f"""WITH {DECIDED_SQL}, {LISTS_SQL}, l AS (SELECT source1_entity_id, list_filter(string_split({BROKEN}, ','), lambda x: x <> '') AS l FROM lists JOIN records ON entity_id = source1_entity_id WHERE idx % 13 <> 0),
e AS (SELECT source1_entity_id, unnest(l) AS id FROM l)
SELECT 'duplicate source-1 row' AS rule, count(*) AS n FROM (SELECT source1_entity_id FROM l GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'repeated id in a list', count(*) FROM l WHERE len(l) > len(list_distinct(l))
UNION ALL SELECT 'source-1 id in a list', count(*) FROM e WHERE starts_with(id, 'S1-')
UNION ALL SELECT 'unknown prefix', count(*) FROM e WHERE NOT regexp_matches(id, '^S[123]-')
UNION ALL SELECT 'source-1 entity missing', count(*) FROM records WHERE src = 1 AND entity_id NOT IN (SELECT source1_entity_id FROM l)
UNION ALL SELECT 'unknown source-1 entity', count(*) FROM l WHERE source1_entity_id NOT IN (SELECT entity_id FROM records WHERE src = 1)
UNION ALL SELECT 'unknown id', count(*) FROM e WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT entity_id FROM records WHERE src <> 1)""",
)
def _(spark, d):
    records = records_view(spark, d)
    lists = flagship(spark, records).join(records.select(F.col("entity_id").alias("source1_entity_id"), "idx"), "source1_entity_id").where("idx % 13 <> 0")
    k, ids = F.col("idx") % 11, F.col("matched_entity_ids")
    broken = F.when(k == 0, F.concat(ids, F.lit(",S1-0"))).when(k == 1, F.concat(ids, F.lit(",S2-999999999"))).when(k == 2, F.lit("X-1,X-1")).otherwise(ids)
    return content_errors(lists.select("source1_entity_id", broken.alias("ids")), records)


# --- dictionary, sets, neighbours, models ----------------------------------------------------------------------------


@query(
    "dictionary_learn",
    """WITH p AS (SELECT string_split(p_name, ' ')[1:2] AS a, string_split(lower(p_type || ' ' || p_brand), ' ')[1:2] AS b FROM part),
w AS (SELECT unnest(a) AS x, unnest(b) AS y FROM p WHERE len(a) = len(b)), c AS (SELECT x, y, count(*) AS n FROM w WHERE x <> '' AND y <> '' GROUP BY ALL),
t AS (SELECT *, CAST(sum(n) OVER (PARTITION BY x) AS BIGINT) AS total FROM c QUALIFY row_number() OVER (PARTITION BY x ORDER BY n DESC, y) = 1)
SELECT * FROM t WHERE n >= 3 AND n / total >= 0.05""",
)
def _(spark, d):
    part = table(spark, d, "part")
    two = lambda c: F.array_join(F.slice(F.split(c, " "), 1, 2), " ")
    return learn.learn_tokens(part.select(two(F.col("p_name")).alias("source"), two(F.lower(F.concat_ws(" ", "p_type", "p_brand"))).alias("target")), 3, 0.05)


@query(
    "semi_anti_counts",
    """SELECT 'with' AS kind, count(*) AS n, coalesce(round(sum(c_acctbal), 2), 0.0) AS total FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'without', count(*), coalesce(round(sum(c_acctbal), 2), 0.0) FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
)
def _(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    one = lambda how, kind: c.join(o, "c_custkey", how).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.round(F.sum("c_acctbal"), 2), F.lit(0.0)).alias("total")).select(F.lit(kind).alias("kind"), "n", "total")
    return one("left_semi", "with").union(one("left_anti", "without"))


@query(
    "union_by_name",
    """SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, 0 AS rating FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL, CAST(s_suppkey % 5 AS INTEGER) FROM supplier""",
)
def _(spark, d):
    c = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 5).cast("int").alias("rating"))
    return c.unionByName(s, allowMissingColumns=True).na.fill({"rating": 0})


@query("row_index", "SELECT row_number() OVER (ORDER BY src, entity_id) - 1 AS rid, src, entity_id FROM (SELECT 1 AS src, c_name AS entity_id FROM customer UNION ALL SELECT 2, s_name FROM supplier)")
def _(spark, d):
    from .matching import dense_ids

    c = table(spark, d, "customer").select(F.lit(1).alias("src"), F.col("c_name").alias("entity_id"))
    both = c.union(table(spark, d, "supplier").select(F.lit(2), F.col("s_name")))
    return dense_ids(both, ["src", "entity_id"], "rid").select("rid", "src", "entity_id")


@query(
    "knn_dense",
    """WITH n AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE))))) AS v FROM embeddings),
s AS (SELECT q.id AS qid, t.id AS tid, round(list_inner_product(q.v, t.v), 4) AS sim FROM n q JOIN n t ON q.id <> t.id WHERE q.id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, tid) AS rk FROM s) SELECT * FROM r WHERE rk <= 10""",
)
def _(spark, d):
    v = dense.normalised(table(spark, d, "embeddings"), "vec_id", "embedding")
    # a vector is its own nearest neighbour; one more is asked for and itself left out
    found = dense.knn_exact(v.where("id % 20 = 0"), v, 11).where("qid <> tid")
    rk = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("sim"), "tid"))
    return found.withColumn("rk", rk).where("rk <= 10")


@query("knn_cells")
def _(spark, d):
    v = dense.normalised(table(spark, d, "embeddings"), "vec_id", "embedding")
    return dense.knn_cells(v.where("id % 20 = 0"), v, 10)


@query("dense_blocking")
def _(spark, d):
    r = records_view(spark, d).select("idx", "src", dense.hashing_encoder()(F.concat_ws(" | ", "name_core", "addr_core", "country_n")).alias("v"))
    q, t = (r.where(c).select(F.col("idx").alias("id"), "v") for c in ("src = 1", "src <> 1"))
    return dense.knn_exact(q, t, 10)


MODEL_COLUMNS = ["bs", "b_ntok", "p", "p_rk_i", "p_rk_j", "p_gap_i", "p_gap_j", "p_margin_j"]


def _model_input(spark, d) -> DataFrame:
    """A table, as every fit and every fold that is scored reads it."""
    # the class of i comes before the windows over j, that of j after them, where the rows are
    made = _labels(spark, d, context.score_context(_heads(spark, d, _scored(spark, d), "i"), "p"))
    return materialised(made.withColumn("fold", learn.fold_of(F.col("i"))), "model-input")


@query("gbdt_scores")
def _(spark, d):
    made = _model_input(spark, d)
    return learn.score_with([learn.fit_gbt(made.where("fold = 0"), MODEL_COLUMNS, "y", rounds=5, depth=3)], made, MODEL_COLUMNS, "p2").select("i", "j", F.round("p2", 4).alias("p2"))


@query("oof_scores")
def _(spark, d):
    fit = lambda df: [learn.fit_gbt(df, MODEL_COLUMNS, "y", rounds=5, depth=3)]
    return learn.out_of_fold(_model_input(spark, d), MODEL_COLUMNS, "y", "fold", "p1", fit)[0].select("i", "j", "fold", F.round("p1", 4).alias("p1"))


@query("cross_encoder_stub")
def _(spark, d):
    pairs = rerank.export_pairs(_scored(spark, d), records_view(spark, d), "p").withColumn("fold", learn.fold_of(F.col("i"), 21))
    return rerank.cross_fit(pairs, "fold", lambda _: rerank.token_overlap_scorer)


@query(
    "rerank_overlap",
    f"""WITH {SCORED_SQL}, w AS (SELECT i, j, string_split(a.name_core || ' ' || a.addr_core, ' ') AS x, string_split(b.name_core || ' ' || b.addr_core, ' ') AS y FROM scored JOIN records a ON a.idx = i JOIN records b ON b.idx = j WHERE p >= 0.15 AND p < 0.95)
SELECT i, j, round(len(list_intersect(x, y)) / greatest(len(list_distinct(list_concat(x, y))), 1), 6) AS score FROM w""",
)
def _(spark, d):
    return rerank.token_overlap_scorer(rerank.export_pairs(_scored(spark, d), records_view(spark, d), "p"))


