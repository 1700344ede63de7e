"""Toxic passages by maximum-scoring segment search.

Every counted token has its own log-odds with a Dirichlet prior: the numbers of toxic and clean labelled documents that hold it, each smoothed by PRIOR
documents dealt by the size of the classes, so that the prior says "no difference". Log-odds, toxic and clean ones alike, are weighted by
their evidence, z^4 / (z^4 + EVIDENCE^4) of their z-score, so that the many tokens met a few times say little instead of much by chance. A token not
counted is scored by the longest of its leading parts (STEMS letters) that is, or else by 0. From every score the drift is taken, a little
above the mean score of clean text, so that the expected score of clean text is below zero. A linear-time scan then finds every maximal-scoring segment (Ruzzo and
Tompa), each of which is a candidate passage. Best segment scores of clean text follow an extreme-value law: its location grows
with ln(length). What a text's segments rise above it, in units of its scale, is summed, and a logistic fit turns the sum into a probability.

The law and the logistic fit are made on texts that the log-odds haven't seen: the sample is dealt to FOLDS parts by hash, and each is
scored by the counts of the others. The texts to be scored get the log-odds of the whole sample.

Learning uses a bounded sample of the labelled rows: all of them up to ``most_rows`` a class, the ones with the
smallest seeded hash. A counted token holds at least MIN_SHARE of all token counts of one class and occurs in MIN_DOCS documents, so there are
2/MIN_SHARE of them at most.

Defined results: null and empty texts have no passage and get the score of one without evidence; without
labels, or with those of one class only, every score is 0.0; rows whose label is null are not learned from; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, stored
from .langid import held_out

MOST_ROWS = 20_000
SEED = 7
FOLDS = 4
#: Strength of the Dirichlet prior of a token in documents.
PRIOR = 3.0
#: z-score at which log-odds count half.
EVIDENCE = 4.0
#: Standard deviations of the token scores of clean text by which the drift is above their mean.
ABOVE = 0.5
#: Lengths of the leading parts of longer words that are counted too.
STEMS = (7, 6, 5)
MIN_SHARE = 2e-6
#: Documents a counted token occurs in at least.
MIN_DOCS = 2
#: Tokens are lower-case words without the punctuation around them.
TOKEN = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def units(words: list[str]) -> set[str]:
    """Distinct words and leading parts; a part ends in a mark, so it's no word."""
    kinds = set(words)
    return kinds | {w[:k] + "*" for w in kinds for k in STEMS if len(w) > k}


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a sequence of scores.

    Ruzzo and Tompa's algorithm: each candidate keeps the cumulated score before it (left) and with it (right); a new one is joined to
    the nearest earlier candidate with a smaller left for as long as its right is larger. Linear, as the
    search over earlier candidates is kept in a list that joining shortens.
    """
    found: list[list[float]] = []  # first, last, left, right, index of the nearest earlier candidate with smaller left
    total = 0.0
    for place, score in enumerate(scores):
        if score <= 0:
            total += score
            continue
        here = [place, place, total, total + score, -1]
        total += score
        k = len(found) - 1
        while True:
            while k >= 0 and found[k][2] >= here[2]:
                k = int(found[k][4])
            here[4] = k
            if k < 0 or found[k][3] >= here[3]:
                found.append(here)
                break
            here = [found[k][0], here[1], found[k][2], here[3], -1]
            del found[k:]
            k = len(found) - 1
    return [(int(a), int(b), right - left) for a, b, left, right, _ in found]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """maximal_segments() of an array; runs of one sign are taken together, no maximal segment begins or ends inside one."""
    up = scores > 0
    if not up.any():
        return []
    begin = np.concatenate([[0], np.flatnonzero(np.diff(up)) + 1])
    end = np.append(begin[1:], len(scores)) - 1
    return [(int(begin[a]), int(end[b]), s) for a, b, s in maximal_segments(np.add.reduceat(scores, begin).tolist())]


@dataclass
class Lexicon:
    """Scores of the counted tokens, and the drift that is taken from every score."""

    scores: dict[str, float] = field(default_factory=dict)
    drift: float = 0.0

    def of_word(self, word: str) -> float:
        got = self.scores.get(word)
        if got is None:
            for k in STEMS:
                if len(word) > k and (got := self.scores.get(word[:k] + "*")) is not None:
                    return got
            return 0.0
        return got

    def of_text(self, text: str | None) -> np.ndarray:
        words = tokens(text)
        return np.fromiter(map(self.of_word, words), np.float64, len(words)) - self.drift


@dataclass
class ToxicModel:
    lexicon: Lexicon = field(default_factory=Lexicon)
    #: Extreme-value law of the best segment of clean text: location(ln n) = base + slope * ln n, and scale.
    base: float = 0.0
    slope: float = 0.0
    scale: float = 1.0
    #: Logistic fit on the evidence: (intercept, weight).
    logit: tuple[float, float] = (-1000.0, 0.0)

    def surprise(self, n: int, best: float) -> float:
        """Standardised height of a segment above what clean text of this length shows."""
        return (best - self.base - self.slope * math.log(n + 1)) / self.scale

    def evidence(self, n: int, heights: list[float]) -> float:
        """Sum over the segments that clean text of the length hardly shows, by the extreme-value law; or the best one's surprise."""
        # -log of the survival of a Gumbel law is about its height where that is large
        told = [self.surprise(n, s) for s in heights] or [self.surprise(n, 0.0)]
        return sum(h for h in told if h > 0) or max(told)

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability of the label, and the passages: segments by token place that clean text of the length hardly shows."""
        scores = self.lexicon.of_text(text)
        found = segments(scores)
        z = self.logit[0] + self.logit[1] * self.evidence(len(scores), [s for *_, s in found])
        return (1 / (1 + math.exp(-z)) if z > -700 else 0.0), [x for x in found if self.surprise(len(scores), x[2]) > 0]


def _sample(docs: DataFrame, labels: DataFrame, most_rows: int) -> DataFrame:
    """(text, toxic, fold) of at most most_rows labelled rows a class; toxic is 0 or 1.

    Of a class with more rows, those whose hash is too large to be among the wanted (but for six standard deviations) never reach the window.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("toxic") == 1).cast("int").alias("toxic"))
    known = known.withColumn("key", F.xxhash64(F.lit(SEED), F.col("doc_id")))
    chosen = []
    for row in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect():  # two classes
        own = known.where(F.col("toxic") == row.toxic)
        if row.n > most_rows:
            share = min(1.0, (most_rows + 6 * math.sqrt(most_rows) + 20) / row.n)
            early = own.where(F.col("key") <= min(2**63 - 1, int(2**64 * share) - 2**63))
            own = early.withColumn("nth", F.row_number().over(Window.partitionBy("toxic").orderBy("key", "doc_id"))).where(F.col("nth") <= most_rows).drop("nth")
        chosen.append(own)
    if not chosen:
        return docs.select("text", F.lit(0).alias("toxic"), F.lit(0).alias("fold")).where("false")
    both = chosen[0] if len(chosen) == 1 else chosen[0].union(chosen[1])
    fold = F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("doc_id")), F.lit(FOLDS)).cast("int").alias("fold")
    # at most most_rows a class: bounded
    return docs.select("doc_id", "text").join(F.broadcast(stored(both.select("doc_id", "toxic", fold), "toxic-sample")), "doc_id").select("text", "toxic", "fold")


def _score(clean: Column, toxic: Column, n0: Column, n1: Column) -> Column:
    """Log-odds of a token out of its counts and the sums of all counts, weighted by evidence."""
    up, down = toxic + PRIOR * n1 / (n0 + n1), clean + PRIOR * n0 / (n0 + n1)
    odds = F.ln(up / n1) - F.ln(down / n0)
    z4 = F.pow(odds * odds / (1 / up + 1 / down), 2)
    return odds * z4 / (z4 + EVIDENCE**4)


def _lexicons(sample: DataFrame) -> list[Lexicon]:
    """The lexicon of the whole sample, and for each fold that of the others; none where the sample lacks a class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally: dict[str, list[int]] = {}
            for text, toxic, fold in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for w in units(tokens(text)):
                    tally.setdefault(w, [0] * (2 * FOLDS))[2 * fold + toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), *(pa.array([r[i] for r in tally.values()], pa.int64()) for i in range(2 * FOLDS))], ["token", *slots])

    slots = [f"{kind}_{k}" for k in range(FOLDS) for kind in ("clean", "toxic")]
    counts = sample.select("text", "toxic", "fold").mapInArrow(count, "token string, " + ", ".join(f"{c} long" for c in slots))
    counted = stored(counts.groupBy("token").agg(*[F.sum(c).alias(c) for c in slots]), "toxic-tokens")
    sums = counted.agg(*[F.sum(c).alias(c) for c in slots]).first()
    total = {kind: sum(sums[f"{kind}_{k}"] or 0 for k in range(FOLDS)) for kind in ("clean", "toxic")}
    if not total["clean"] or not total["toxic"]:
        return []
    of = {kind: sum((F.col(f"{kind}_{k}") for k in range(FOLDS)), F.lit(0)) for kind in total}
    kept = counted.where((of["clean"] + of["toxic"] >= MIN_DOCS) & ((of["clean"] >= MIN_SHARE * total["clean"]) | (of["toxic"] >= MIN_SHARE * total["toxic"])))
    scores, weights = [], []
    for k in (None, *range(FOLDS)):
        n = {kind: float(total[kind] - (sums[f"{kind}_{k}"] if k is not None else 0)) for kind in total}
        mine = {kind: of[kind] - (F.col(f"{kind}_{k}") if k is not None else F.lit(0)) for kind in total}
        known = mine["clean"] + mine["toxic"] >= MIN_DOCS
        score = _score(mine["clean"], mine["toxic"], F.lit(n["clean"]), F.lit(n["toxic"])) if n["clean"] and n["toxic"] else F.lit(0.0)
        scores.append(F.when(known, score).cast("double"))
        weights.append(mine["clean"].cast("long"))
    # 2/MIN_SHARE rows at most
    table = kept.select("token", *[s.alias(f"s{i}") for i, s in enumerate(scores)], *[w.alias(f"w{i}") for i, w in enumerate(weights)]).toArrow()
    words, found = table.column("token").to_pylist(), []
    for i in range(len(scores)):
        s, w = table.column(f"s{i}").to_numpy(), table.column(f"w{i}").to_numpy()
        there = ~np.isnan(s)
        # mean and deviation over the tokens of clean text, those not counted included as 0
        every = float(total["clean"] - (sums[f"clean_{i - 1}"] if i else 0)) or 1.0
        mean = float((s[there] * w[there]).sum()) / every
        spread = math.sqrt(max(0.0, float((s[there] ** 2 * w[there]).sum()) / every - mean * mean))
        found.append(Lexicon({words[j]: float(s[j]) for j in np.flatnonzero(there)}, max(mean + ABOVE * spread, 1e-3)))
    return found


def _fit_gumbel(n: np.ndarray, best: np.ndarray) -> tuple[float, float, float]:
    """Location base + slope ln n by least squares, scale by moments; of best segments of clean texts."""
    x = np.log(n + 1.0)
    if len(x) < 20 or x.std() == 0 or best.std() == 0:
        return float(best.mean()) if len(best) else 0.0, 0.0, max(float(best.std()) if len(best) else 0.0, 1.0)
    slope = max(0.0, float(np.cov(x, best)[0, 1] / x.var()))
    rest = best - slope * x
    scale = max(float(rest.std()) * math.sqrt(6) / math.pi, 0.25)
    return float(rest.mean()) - 0.5772 * scale, slope, scale


def _fit_logit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Ridge logistic regression of one feature by Newton steps; the weight never turns negative."""
    if not len(x) or y.min() == y.max():
        return (-50.0 if not len(y) or y.max() == 0 else 50.0), 0.0
    a, b = 0.0, 0.0
    m, s = x.mean(), x.std() or 1.0
    u = (x - m) / s
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * u, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([(y - p).sum(), ((y - p) * u).sum() - 1e-2 * b])
        h = np.array([[w.sum(), (w * u).sum()], [(w * u).sum(), (w * u * u).sum() + 1e-2]])
        d = np.linalg.solve(h, g)
        a, b = a + float(d[0]), b + float(d[1])
        if abs(d).max() < 1e-9:
            break
    b = max(b, 0.0) / s
    return a - b * m, b


def train_toxicity(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> ToxicModel:
    sample = _sample(docs, labels, most_rows)
    lexicons = _lexicons(sample)
    if not lexicons:
        return ToxicModel()
    model = ToxicModel(lexicons[0])
    others = sample.sparkSession.sparkContext.broadcast(lexicons[1:])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for text, fold in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                scores = others.value[fold].of_text(text)
                sizes.append(len(scores))
                found.append([s for *_, s in segments(scores)])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["toxic", "n", "heights"])

    measured = stored(sample.select("text", "toxic", "fold").mapInArrow(measure, "toxic int, n long, heights array<double>"), "toxic-segments")
    # a few numbers a sampled document: bounded
    best = measured.where("toxic = 0").select("n", F.coalesce(F.array_max("heights"), F.lit(0.0)).alias("best")).toArrow()
    model.base, model.slope, model.scale = _fit_gumbel(best.column("n").to_numpy(), best.column("best").to_numpy())
    told = lambda h: (h - F.lit(model.base) - F.lit(model.slope) * F.ln(F.col("n") + 1)) / F.lit(model.scale)
    surprises = F.transform(F.when(F.size("heights") > 0, F.col("heights")).otherwise(F.array(F.lit(0.0))), told)
    strong = F.aggregate(F.filter(surprises, lambda h: h > 0), F.lit(0.0), lambda a, h: a + h)
    seen = measured.select("toxic", F.when(strong > 0, strong).otherwise(F.array_max(surprises)).alias("x")).toArrow()
    model.logit = _fit_logit(seen.column("x").to_numpy(), seen.column("toxic").to_numpy())
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, score, predicted, and passages (first and last token, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score:double,predicted:int,passages:array<struct<first:int,last:int,score:double>>>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))
        for texts in batches:
            score, passages = [], []
            for text in texts:
                p, found = shared.value.judge(text.as_py())
                score.append(p)
                passages.append([{"first": a, "last": b, "score": s} for a, b, s in found])
            yield pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32()), pa.array(passages, kind)], ["score", "predicted", "passages"])

    return docs.select("doc_id", judge("text").alias("j")).select("doc_id", "j.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train_toxicity(docs, labels.where(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", "toxic"))
    return score_toxicity(docs, model).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


QUERIES = {"op7_toxicity": op7_toxicity}
ORACLE: dict[str, str] = {}
