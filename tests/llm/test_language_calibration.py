"""The rejection threshold with production parameters."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from linkloom.llm import langid


def test_quantile_exists(spark, monkeypatch):
    """One odd row doesn't set the limit: it is a value of the calibration rows, and rejects about the promised share."""
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("abcdefg    " if i % 2 else "qrstuvw    ") for _ in range(120)), "xy"[i % 2]) for i in range(7000)]
    seen = []
    calibrate = langid.KneserNey.calibrate
    monkeypatch.setattr(langid.KneserNey, "calibrate", lambda self, held, *a: (seen.extend(held), calibrate(self, held, *a))[1])
    model = langid.train_language_models(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for j, lang in enumerate(model.languages):
        own = [(h[j], n) for was, h, n in seen if was == lang and int(np.argmin(h)) == j]
        odd = np.sort(model._oddness(np.array([x for x, _ in own]), np.array([n for _, n in own]), model.mean[j]))
        rank = math.ceil((len(odd) + 1) * (1 - langid.REJECT_SHARE))
        assert rank <= len(odd) and model.limit[j] == odd[rank - 1]


def test_sample_sizes(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.when(F.col("id") < 100, "small").otherwise("large").alias("lang"))
    got = {(r.lang, r.calibrates): r.n for r in langid._sample(docs, 90, 500).groupBy("lang", "calibrates").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("small", False): 75, ("small", True): 25, ("large", False): 90, ("large", True): 500}
