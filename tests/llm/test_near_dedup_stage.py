"""The near-dedup stage against brute force over whole shingle sets."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkloom.llm import bands, simhash
from linkloom.llm.common import may_hold


def shingles(text, width=5):
    w = text.lower().split()
    return {" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def brute_kept(docs):
    """Smallest id of each component of Jaccard >= 0.8."""
    root, sets = {i: i for i in docs}, {i: shingles(t) for i, t in docs.items()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for i, j in itertools.combinations(docs, 2):
        both = len(sets[i] & sets[j])
        if both >= 0.8 * len(sets[i] | sets[j]):
            p, q = find(i), find(j)
            root[max(p, q)] = min(p, q)
            links += 1
    return {i for i in docs if find(i) == i}, links


@pytest.mark.parametrize("chunk", [4096, 16])
def test_near_copies_equal_brute_force(spark, monkeypatch, chunk):
    # with small chunks, large buckets are dealt out and met in blocks
    monkeypatch.setattr(bands.proposals, "__defaults__", (chunk,))
    rng, docs = random.Random(4), {}
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    for _ in range(25):
        base = words(200)
        for edits in (0, 1, 2, 3, 4, 5, 8, 12):
            copy = list(base)
            for at in rng.sample(range(200), edits):
                copy[at] = f"x{rng.randrange(10**6)}"
            docs[len(docs)] = " ".join(copy)
    core = words(150)
    for _ in range(120):  # one large group of copies, some alike and some not
        copy = list(core)
        for at in rng.sample(range(150), rng.randrange(12)):
            copy[at] = f"y{rng.randrange(10**6)}"
        docs[len(docs)] = " ".join(copy)
    for _ in range(30):
        docs[len(docs)] = " ".join(words(rng.randrange(1, 40)))
    want, links = brute_kept(docs)
    assert links > 200
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert {r.doc_id for r in stage(spark, frame, "").collect()} == want


@pytest.mark.parametrize("alike", [0, 3])
def test_pairs_that_are_not_alike_enough_make_no_rows(spark, monkeypatch, alike):
    """Texts of one core at similarity 0.7 to each other: each pair of them was a row that was verified. A few are alike."""
    rng, made = random.Random(6), {}
    real = bands.stored

    def kept(df, tag):
        made[tag] = real(df, tag)
        return made[tag]

    monkeypatch.setattr(simhash, "stored", kept)
    monkeypatch.setattr(bands, "stored", kept)
    core = [f"w{k}" for k in range(300)]
    docs = {k: " ".join([*core, *(f"z{k}x{e}" for e in range(60))]) for k in range(150)}
    docs |= {200 + k: docs[k] + " more" for k in range(alike)}
    want, links = brute_kept(docs)
    assert links == alike
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in simhash.keep_one_per_group(frame).collect()} == want
    assert sum(made[tag].count() for tag in made if tag.endswith("-pairs")) < 25 * len(docs) and made["across"].count() <= 20 * alike


def test_marks_hold_all_that_is_wanted(spark):
    wanted = spark.range(-500, 500).select((F.col("id") * 10**15).alias("node"))
    kept = spark.range(-5000, 5000).select((F.col("id") * 10**15).alias("node")).where(may_hold(wanted, "node"))
    assert 1000 <= kept.count() < 1100 and kept.join(wanted, "node", "left_semi").count() == 1000
