"""Work that grows with the input is done once, and for many rows at a time."""

import random
import time

import pytest

from linkloom import catalog
from linkloom.functions import similarity
from linkloom.plans import queries_matching
from linkloom.plans.records import truth_view

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_models_read_a_table_of_their_input(spark):
    """Candidates were made anew for each fit and each fold that was scored."""
    plan = plan_of(catalog.queries()["oof_scores"](spark, SF))
    assert "Join" not in plan and "Generate" not in plan


def test_candidates_read_a_table_of_tokens(spark):
    """The index and its weights each tokenised the records anew."""
    assert "documents.parquet" not in "".join(queries_matching._kept(spark, SF).inputFiles())


def test_labels_are_the_truth_of_the_candidates(spark):
    made = {(r.i, r.j) for r in queries_matching._labelled(spark, SF).where("y = 1").collect()}
    truth = {(r.i, r.j) for r in truth_view(spark, SF).collect()}
    assert made and made == truth & {(r.i, r.j) for r in queries_matching._scored(spark, SF).collect()}


@pytest.mark.parametrize("cells", [1 << 15, 40])
def test_scores_of_many_pairs_equal_those_of_one(monkeypatch, cells):
    monkeypatch.setattr(similarity, "CELLS", cells)
    rng = random.Random(3)
    text = lambda: " ".join("".join(rng.choices("abcde", k=rng.randrange(5))) for _ in range(rng.randrange(8)))
    left = [text() for _ in range(600)] + ["", "a", "", "é\U0001f600x", "￿￾ ab", " ", "ab " * 400]
    right = [text() for _ in range(300)] + ["".join(rng.sample(a, len(a))) for a in left[300:600]] + ["", "", "bc", "x\U0001f600é", "ab ￿", "a", "ba " * 300]
    got = similarity.batch_scores(left, right, tuple(similarity.SCORERS))
    for name, score in similarity.SCORERS.items():
        assert list(got[name]) == [score(a, b) for a, b in zip(left, right)], name


def test_scores_of_thousands_of_addresses(spark):
    """One at a time, these took 4 ms each."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(3, 9))) for _ in range(500)]
    rows = [(" ".join(rng.choices(words, k=11)), " ".join(rng.choices(words, k=11))) for _ in range(10_000)]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    began = time.time()
    assert df.select(similarity.string_scores("partial")("a", "b")["partial"].alias("s")).where("s > 0").count() == len(rows)
    assert time.time() - began < 15
