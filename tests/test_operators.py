"""Decisions, evaluation, sources and results on small tables; the trained pipeline end to end."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators import blocking, decide, dense, evaluate, learn, rerank, tokens
from linkloom.plans.matching import Matcher, dense_ids, first_stage_columns, prepare
from linkloom.plans.records import records_view, truth_view
from linkloom.sources import tables, validate

SF = "/root/testdata/sf0.001"


def test_decide(spark):
    pairs = spark.createDataFrame([(1, 1, 0.9), (2, 1, 0.8), (1, 2, 0.6)], "i long, j long, p double")
    assert {(r.i, r.j) for r in decide.decide(pairs, "p", 0.5, True, 0.7).collect()} == {(1, 1)}
    assert {(r.i, r.j) for r in decide.decide(pairs, "p", 0.5).collect()} == {(1, 1), (1, 2)}
    assert decide.decide(pairs, "p", 0.5, False).count() == 3


def test_veto_blend_parse(spark):
    row = spark.range(1)
    assert row.select(decide.veto_decision(F.lit(0), F.lit(1), F.lit(0.9), F.lit(0.99), 0.5)).first()[0] is False
    assert row.select(decide.veto_decision(F.lit(1), F.lit(0), F.lit(0.86), F.lit(0.99), 0.5)).first()[0] is True
    assert row.select(decide.blend(F.lit(0.6), [F.lit(None).cast("double"), F.lit(0.1)], [1, 1, 0])).first()[0] == pytest.approx(0.6)
    assert row.select(decide.parse_verdict(F.lit("NO_MATCH because"))).first()[0] == "NO_MATCH"
    assert row.select(decide.yes_probability(F.lit(-1.0), F.lit(-1.0))).first()[0] == 0.5


def test_f_beta(spark):
    f = lambda *x: spark.range(1).select(evaluate.f_beta(*map(F.lit, x))).first()[0]
    assert f(0, 0, 0) == 1 and f(0, 1, 0) == 0 and f(0, 0, 1) == 0 and f(1, 1, 1) == 1
    assert f(1, 2, 1) == pytest.approx(1.25 * 0.5 / (0.125 + 1))


def test_macro_f_counts_entities_without_matches(spark):
    truth = spark.createDataFrame([(1, 10), (2, 20)], "i long, j long")
    ones = spark.createDataFrame([(1,), (2,), (3,)], "i long")
    matches = spark.createDataFrame([(1, 10)], "i long, j long")
    assert evaluate.macro_f(matches, truth, ones).first().f == pytest.approx(2 / 3)
    assert evaluate.macro_f(matches.where("i < 0"), truth, ones).first().f == pytest.approx(1 / 3)


def test_auc(spark):
    rows = [(k, float(random.Random(k).randint(0, 9)), k % 2) for k in range(60)]
    got = evaluate.auc(spark.createDataFrame(rows, "id long, s double, y int"), "s", "y", "id").first().auc
    ranked = sorted(rows, key=lambda r: (r[1], r[0]))
    rs = sum(i for i, r in enumerate(ranked, 1) if r[2])
    assert got == pytest.approx((rs - 30 * 31 / 2) / 900, abs=1e-6)


def test_two_sided_top_holds_both_sides(spark):
    r = random.Random(1)
    pairs = spark.createDataFrame([(i, j, float(r.randint(0, 50)), 1) for i in range(12) for j in range(30)], "i long, j long, bs double, b_ntok long")
    kept = {(x.i, x.j) for x in blocking.two_sided_top(pairs, 4, 2).collect()}
    rows = pairs.collect()
    for i in range(12):
        assert {(x.i, x.j) for x in sorted((x for x in rows if x.i == i), key=lambda x: (-x.bs, x.j))[:4]} <= kept
    for j in range(30):
        assert {(x.i, x.j) for x in sorted((x for x in rows if x.j == j), key=lambda x: (-x.bs, x.i))[:2]} <= kept


def test_tokens_are_distinct_and_typed(spark):
    t = tokens.typed_tokens(records_view(spark, SF))
    assert t.count() == t.distinct().count()
    assert {r.typ for r in t.select("typ").distinct().collect()} == set(tokens.TYPES)


def test_tsv_round_trip_and_lists(spark, tmp_path):
    (tmp_path / "x.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"Quoted" Ltd\t\tUS\n')
    row = tables.read_tsv(spark, str(tmp_path / "x.tsv")).first()
    assert (row.business_name, row.business_address) == ('"Quoted" Ltd', "")
    records = spark.createDataFrame([(0, "S1-0", 1), (1, "S1-1", 1), (2, "S2-2", 2), (3, "S3-1", 3)], "idx long, entity_id string, src int")
    lists = tables.result_lists(spark.createDataFrame([(0, 3), (0, 2)], "i long, j long"), records)
    assert {tuple(r) for r in lists.collect()} == {("S1-0", "S2-2,S3-1"), ("S1-1", "")}
    tables.write_tsv(lists, str(tmp_path / "out"))
    assert validate.structural_errors(spark, str(tmp_path / "out"), "matching") == []
    assert validate.structural_errors(spark, str(tmp_path / "none"), "matching") == ["missing"]
    errors = validate.content_errors(lists.withColumnRenamed("matched_entity_ids", "ids"), records)
    assert sum(r.n for r in errors.collect()) == 0
    tables.save_json(spark, {"a": [1]}, str(tmp_path / "j"))
    assert tables.load_json(spark, str(tmp_path / "j")) == {"a": [1]}


def test_convert(spark, tmp_path):
    for split in tables.SPLITS:
        for n in tables.SOURCES:
            (tmp_path / f"{split}_source{n}.tsv").write_text(f"entity_id\tbusiness_name\tbusiness_address\tcountry\nS{n}-1\tA\tB\tUS\n")
    (tmp_path / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-1\nS1-2\t\n")
    made = tables.convert(spark, str(tmp_path), str(tmp_path / "out"))
    assert len(made) == 7
    assert {r.entity_id for r in tables.explode_truth(spark.read.parquet(made[-1])).collect()} == {"S2-1", "S3-1"}


def test_prepare_and_dense_ids(spark):
    one = spark.createDataFrame([("S1-2", "Café Ltd", "1 Main St, Austin, TX", "US"), ("S1-1", None, None, None)], tables.RECORD)
    two = spark.createDataFrame([("S2-1", "Cafe Limited", "01 Main Street, Austin", "US")], tables.RECORD)
    rows = {r.entity_id: r for r in prepare([one, two]).collect()}
    assert [rows[k].idx for k in ("S1-1", "S1-2", "S2-1")] == [0, 1, 2]
    assert rows["S1-2"].name_core == rows["S2-1"].name_core == "cafe"
    assert rows["S1-2"].country_n == "us" and rows["S1-2"].state == "texas" and rows["S1-1"].name_core == ""
    ids = dense_ids(spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")), ["k"], "n").orderBy("k").collect()
    assert [r.n for r in ids] == list(range(1000))


def test_knn_exact_matches_brute_force(spark):
    import numpy as np

    v = dense.normalised(spark.read.parquet(f"{SF}/embeddings.parquet"), "vec_id", "embedding")
    rows = v.collect()
    m, ids = np.array([r.v for r in rows]), np.array([r.id for r in rows])
    got = dense.knn_exact(v.where("id % 50 = 0"), v, 5).collect()
    for q in sorted({r.qid for r in got}):
        sims = np.round(m @ m[list(ids).index(q)], 4)
        want = [int(ids[k]) for k in np.lexsort((ids, -sims))[:5]]
        assert [r.tid for r in sorted((r for r in got if r.qid == q), key=lambda r: r.rk)] == want


def test_learned_dictionary(spark):
    pairs = spark.createDataFrame([("x y", "ram sons")] * 3 + [("x z", "ram co")] + [("x", "a b")], "source string, target string")
    assert {(r.x, r.y, r.n, r.total) for r in learn.learn_tokens(pairs).collect()} == {("x", "ram", 4, 4), ("y", "sons", 3, 3)}
    segs = spark.createDataFrame([("p, q", "one, two")] * 3, "source string, target string")
    assert {(r.x, r.n, r.total) for r in learn.learn_segments(segs).collect()} == {("p", 3, 3), ("q", 3, 3)}


def test_rerank_contract(spark):
    pairs = spark.createDataFrame([(1, 2, 0.6), (3, 4, 0.5)], "i long, j long, p2 double")
    scored = rerank.attach_scores(pairs, ce=spark.createDataFrame([(1, 2, 0.9)], "i long, j long, score double"))
    assert {(r.i, r.ce) for r in scored.collect()} == {(1, 0.9), (3, None)}


def test_model_columns(spark):
    assert len(first_stage_columns()) == len(set(first_stage_columns())) == 114


def test_trained_pipeline(spark):
    records = records_view(spark, SF)
    truth = truth_view(spark, SF)
    m = Matcher(rounds=3)
    scored = m.fit(records, truth)
    assert {"p1", "p2", "na_mean"} <= set(scored.columns)
    found = m.predict(records).select("i", "j")
    assert found.count() == found.select("j").distinct().count()
    hits, total = found.join(truth, ["i", "j"]).count(), truth.count()
    assert hits >= 0.8 * total


def test_recall_of_blocking(spark):
    from linkloom.plans.matching import candidates

    records, truth = records_view(spark, SF), truth_view(spark, SF)
    report = evaluate.recall_report(truth, candidates(records)[1], records).agg(F.sum("n_hit"), F.sum("n_true")).first()
    assert report[0] >= 0.98 * report[1]
