"""LM scoring by a hidden Markov language model.

The model emits word classes: every word with at least OWN_SHARE of the tokens is a class of its own, all others
share BUCKETS classes by their last letters, and the end is a class. A word of a shared class follows with
its smoothed share in the class, so P(text) = P_hmm(classes) x product of P(word | class) is a proper model over an
open vocabulary, while what the executors need of the HMM is states x classes numbers, a fixed bound.

* Counts: words are counted on every partition and merged by word; the table stays distributed.
* Words with LEXICON_SHARE of the tokens (at most 1/LEXICON_SHARE words) are broadcast. All other words of a document
  meet their counts in a shuffled join keyed by word, in which no key is hot by construction.
* Training: Baum-Welch over all training documents, whole. Every task runs scaled forward-backward over its rows and emits
  expected counts, which are summed across partitions; a round reads compact class sequences, not texts. A few rounds over a share of
  the documents come first; those over all of them end when the log10 likelihood gains less than LEAST_GAIN a token, or after ``rounds``.
* Scoring: the scaled forward recursion over the whole class sequence gives the exact likelihood.

Defined results: null text is the end alone; a null doc_id trains; without any training document the counts are 0 and
the model is that of the smoothing; repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stored
from .langid import held_out

STATES = 8
#: Baum-Welch rounds over all training documents at most, and the log10 likelihood a token that one must gain for another to follow.
ROUNDS = 5
LEAST_GAIN = 1e-3
#: Rounds before them over one in WARM_SHARE training documents (by hash), from which the states take their first shape.
WARM_ROUNDS, WARM_SHARE = 12, 8
SEED = 10
OWN_SHARE = 1 / 20_000
LEXICON_SHARE = 1 / 200_000
BUCKETS = 4096
SUFFIX = 3
#: Steps of a sequence that are worked on one after the other; further ones go side by side.
STEPS = 1024
#: Class positions whose state vectors are held at once, and class positions that a task gathers before it goes over them.
TOGETHER, POSITIONS = 1 << 19, 1 << 22
#: Distinct words a task counts before it hands them on.
TALLY = 200_000
SMOOTH = 0.5


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at the six ASCII white-space characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


# --- hidden Markov model ------------------------------------------------------------------------------------------


@dataclass
class Hmm:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states

    @classmethod
    def initial(cls, class_counts: np.ndarray, states: int = STATES, seed: int = SEED) -> Hmm:
        """Class shares, perturbed differently in every state."""
        rng = np.random.default_rng(seed)
        emit = (class_counts[:, None] + SMOOTH) * np.exp(rng.normal(0, 1, (len(class_counts), states)))
        move = rng.uniform(0.5, 1.5, (states, states)) + 2 * np.eye(states)
        return cls(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    def log10_likelihoods(self, sequences: list[np.ndarray], steps: int = STEPS) -> np.ndarray:
        """Exact log10 P of each class sequence, by the forward recursion with a scale at every step."""
        out = np.zeros(len(sequences))
        if any(len(s) for s in sequences):
            plan = _Stretches(self, sequences, steps, np.float64)
            for some in plan.groups():
                log = plan.forward(some, False)[0]
                np.add.at(out, plan.owner[some], log)
        return out / math.log(10)

    def expected(self, sequences: list[np.ndarray], totals: list[np.ndarray], steps: int = STEPS) -> float:
        """Add the expected counts (start, move, emit) of Baum-Welch over whole sequences to totals; returns their log10 likelihood."""
        if not any(len(s) for s in sequences):
            return 0.0
        plan, log = _Stretches(self, sequences, steps, np.float32), 0.0
        for some in plan.groups():
            log += plan.counts(some, totals)
        return log / math.log(10)

    @classmethod
    def from_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Hmm:
        start, move, emit = start + SMOOTH, move + SMOOTH, emit + SMOOTH / len(start)
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _total(values: np.ndarray, axis: int = 0) -> np.ndarray:
    """Sum over an axis in a fixed order, so that a column's sum doesn't depend on how many others stand beside it."""
    rows = np.moveaxis(values, axis, 0)
    out = rows[0].copy()
    for row in rows[1:]:
        out += row
    return out


def _times(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    """matrix @ values with each column summed in a fixed order; a product of BLAS rounds by the shape."""
    out = matrix[:, :1] * values[0]
    for j in range(1, len(values)):
        out += matrix[:, j : j + 1] * values[j]
    return out


class _Stretches:
    """Sequences laid out in stretches of ``steps``, all side by side, for recursions that carry over from one to the next.

    No sequence is cut. The product of a stretch's step matrices takes the forward vector from its begin to its end and the
    backward vector the other way, so that the vectors at all borders follow from a walk over stretches; within its borders each stretch then
    has its exact values. Arrays are states x stretches.

    In double precision (scores) every column is worked on in an order of its own, so a text's score is the same to the last
    bit whatever texts are beside it; in single precision (training) matrix products are left to BLAS.
    """

    def __init__(self, hmm: Hmm, sequences: list[np.ndarray], steps: int, kind: type):
        sizes = np.array([len(s) for s in sequences], np.int64)
        self.flat, first = np.concatenate(sequences), np.cumsum(sizes) - sizes
        pieces = -(-sizes // steps)
        self.owner = np.repeat(np.arange(len(sizes)), pieces)
        self.of = pieces[self.owner]
        self.nth = np.arange(len(self.owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.begin, self.length = first[self.owner] + self.nth * steps, np.minimum(sizes[self.owner] - self.nth * steps, steps)
        self.states, self.kind = len(hmm.start), kind
        self.total, self.times = (_total, _times) if kind is np.float64 else (np.sum, np.matmul)
        self.start, self.move, self.emit = hmm.start.astype(kind)[:, None], hmm.move.astype(kind), hmm.emit.astype(kind)
        self.before, self.after = np.zeros((self.states, len(self.owner)), kind), np.ones((self.states, len(self.owner)), kind)
        if pieces.max() > 1:
            self._carry()

    def groups(self) -> Iterator[np.ndarray]:
        """Stretches that are worked on together, the longest first."""
        by, at = np.argsort(-self.length, kind="stable"), 0
        while at < len(by):
            some = by[at : at + max(1, TOGETHER // int(self.length[by[at]]))]
            at += len(some)
            yield some

    def _taken(self, emit: np.ndarray, places: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(np.take(emit, self.flat[places], axis=0, mode="clip").T)

    def _carry(self) -> None:
        """Fill in the forward vectors before and the backward vectors after each stretch of the sequences that have several."""
        k = self.states
        # what an emission says of the states, without its size, so that products shrink slowly
        onward, relative = np.ascontiguousarray(self.move.T), self.emit / self.emit.max(axis=1, keepdims=True)
        emitted = lambda of, t: self._taken(relative, self.begin[of] + t)
        # first stretches need their forward vector only, the others their product
        heads = np.nonzero((self.nth == 0) & (self.of > 1))[0]
        rest = np.nonzero(self.nth > 0)[0]
        rest = rest[np.argsort(-self.length[rest], kind="stable")]
        vectors = self.start * emitted(heads, 0)
        product = np.broadcast_to(np.eye(k, dtype=self.kind)[:, :, None], (k, k, len(rest))).copy()  # to, from, stretch
        long = int(self.length.max())
        alive = np.searchsorted(-self.length[rest], -np.arange(long), side="left")
        for t in range(long):
            if t:
                vectors = self.times(onward, vectors) * emitted(heads, t)
                vectors /= self.total(vectors, axis=0)
            d = alive[t]
            if d:
                now = self.times(onward, product[:, :, :d].reshape(k, -1)).reshape(k, k, d) * emitted(rest[:d], t)[:, None, :]
                product[:, :, :d] = now / now.max(axis=(0, 1)) if t % 8 == 7 else now
        product /= product.max(axis=(0, 1))
        place = np.full(len(self.begin), -1)
        place[rest] = np.arange(len(rest))
        at, now = heads + 1, vectors / self.total(vectors, axis=0)
        while len(at):
            self.before[:, at] = now
            more = self.of[at] > self.nth[at] + 1
            at, now = at[more], now[:, more]
            now = self.total(product[:, :, place[at]] * now, axis=1)
            now /= self.total(now, axis=0)
            at = at + 1
        at = np.nonzero((self.nth == self.of - 1) & (self.of > 1))[0]
        now = np.ones((k, len(at)), self.kind)
        while len(at):
            now = (product[:, :, place[at]] * now[:, None, :]).sum(axis=0)
            now /= now.sum(axis=0)
            at = at - 1
            self.after[:, at] = now
            more = self.nth[at] > 0
            at, now = at[more], now[:, more]

    def forward(self, some: np.ndarray, keep: bool) -> tuple:
        """Log likelihood of each stretch; if kept, (step, state, stretch) forward vectors and emissions, scales, classes and the number of stretches at a step."""
        begin, length, k = self.begin[some], self.length[some], self.states
        n, long = len(some), int(length[0])
        alive = np.searchsorted(-length, -np.arange(long), side="left")
        onward = np.ascontiguousarray(self.move.T)
        alpha, told = (np.zeros((long, k, n), self.kind) for _ in "ab") if keep else (None, None)
        seen = np.zeros((long, n), np.int32) if keep else None
        scale = np.ones((long, n), self.kind)
        now = np.where(self.nth[some] == 0, self.start, self.times(onward, self.before[:, some]))
        for t in range(long):
            d = alive[t]
            said = self._taken(self.emit, begin[:d] + t)
            now = (self.times(onward, now[:, :d]) if t else now) * said
            scale[t, :d] = self.total(now, axis=0)
            now /= scale[t, :d]
            if keep:
                alpha[t, :, :d], told[t, :, :d], seen[t, :d] = now, said, self.flat[begin[:d] + t]
        return self.total(np.log(scale, dtype=np.float64), axis=0), alpha, told, scale, seen, alive

    def counts(self, some: np.ndarray, totals: list[np.ndarray]) -> float:
        """Add the expected counts of stretches to totals; returns their log likelihood."""
        log, alpha, told, scale, seen, alive = self.forward(some, True)
        (long, k, n), head = alpha.shape, self.nth[some] == 0
        last = alpha[self.length[some] - 1, :, np.arange(n)].T
        beta = self.after[:, some] / (last * self.after[:, some]).sum(axis=0)
        moves = np.zeros((k, k))
        for t in range(long - 1, -1, -1):
            d = alive[t]
            ahead = beta[:, :d] * told[t, :, :d] / scale[t, :d]
            if t:
                moves += alpha[t - 1, :, :d] @ ahead.T
            else:
                moves += self.before[:, some[~head]] @ ahead[:, ~head].T
            alpha[t, :, :d] *= beta[:, :d]
            beta[:, :d] = self.move @ ahead
        totals[0] += alpha[0][:, head].sum(axis=1, dtype=np.float64)
        totals[1] += moves * self.move
        places = seen.ravel()
        for j in range(k):
            totals[2][:, j] += np.bincount(places, alpha[:, j].ravel(), len(self.emit))
        return float(log.sum())


# --- vocabulary -----------------------------------------------------------------------------------------------------


@dataclass
class Vocabulary:
    """What tasks need of the counts: frequent words with count and class; totals of the shared classes."""

    index: dict[bytes, int]
    counts: np.ndarray  # training counts of the frequent words
    classes: np.ndarray
    n_classes: int
    tokens: int  # N: training tokens, ends included
    kinds: int  # V: distinct training tokens, the end included
    ends: int
    shared: np.ndarray  # log10 of the denominators of the shared classes

    @property
    def end_class(self) -> int:
        return self.n_classes - 1

    def bucket(self, word: bytes) -> int:
        return zlib.crc32(word[-SUFFIX:]) % BUCKETS


def count_words(docs: DataFrame) -> DataFrame:
    """(word, trained, other): occurrences in training rows and other rows of docs (text, train)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            kinds = list(dict.fromkeys(chain(*tallies)))
            out = [pa.array(kinds, pa.binary()), *(pa.array(list(map(t.get, kinds, repeat(0))), pa.int64()) for t in tallies)]
            for t in tallies:
                t.clear()
            return pa.RecordBatch.from_arrays(out, ["word", "trained", "other"])

        for batch in batches:
            for text, train in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tallies[0 if train else 1].update(words_of(text))
                if len(tallies[0]) + len(tallies[1]) > TALLY:
                    yield rows()
        yield rows()

    counted = docs.select("text", "train").mapInArrow(count, "word binary, trained long, other long")
    return counted.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("other").alias("other"))


def build_vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """counts: stored word table; ends: number of training rows."""
    n, v, every = counts.agg(F.sum("trained"), F.count_if(F.col("trained") > 0), F.sum(F.col("trained") + F.col("other"))).first()
    tokens, every = (n or 0) + ends, every or 0
    # each holds LEXICON_SHARE of all words at least: bounded
    frequent = counts.where(F.col("trained") + F.col("other") >= LEXICON_SHARE * every).select("word", "trained").collect() if every else []
    frequent.sort(key=lambda r: (-r.trained, bytes(r.word)))
    words = [bytes(r.word) for r in frequent]
    trained = np.array([r.trained for r in frequent], np.int64)
    own = int((trained >= max(1.0, OWN_SHARE * tokens)).sum())
    least = int(trained[own - 1]) if own else None
    # a word outside the lexicon is never in own, even where few rows train and its count would do
    lexical = F.col("trained") + F.col("other") >= LEXICON_SHARE * every
    bucket = F.crc32(F.substring("word", -SUFFIX, SUFFIX)) % BUCKETS
    rest = counts.where((F.col("trained") < least) | ~lexical) if own else counts
    shared = np.zeros((BUCKETS, 2))
    for r in rest.groupBy(bucket.alias("b")).agg(F.sum("trained").alias("n"), F.count_if(F.col("trained") > 0).alias("v")).collect():
        shared[r.b] = r.n, r.v
    classes = np.array([i if i < own else own + zlib.crc32(w[-SUFFIX:]) % BUCKETS for i, w in enumerate(words)], np.int32)
    return Vocabulary(
        {w: i for i, w in enumerate(words)}, trained, classes, own + BUCKETS + 1, tokens, (v or 0) + (1 if ends else 0), ends, np.log10(shared[:, 0] + SMOOTH * (shared[:, 1] + 1))
    )


SEQUENCES = "row_id long, doc_id {id}, train boolean, n_tokens long, n_known long, logs double, own_logs double, shared_logs double, classes binary, rare array<binary>, times array<int>"


def class_sequences(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """A row for each row of docs (doc_id, text, train) with its class sequence, what the frequent words contribute, and its rare words."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    schema = SEQUENCES.format(id=docs.schema["doc_id"].dataType.simpleString()).removeprefix("row_id long, ")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        logs = np.log10(vocab.counts + SMOOTH)
        first_bucket = vocab.n_classes - 1 - BUCKETS
        get, bucket = vocab.index.get, vocab.bucket
        end_log = math.log10(vocab.ends + SMOOTH)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = []
                for text in part.column(1).to_pylist():
                    words = words_of(text)
                    place = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
                    gone = np.nonzero(place < 0)[0]
                    kinds = np.empty(len(words) + 1, np.int32)
                    kinds[:-1] = vocab.classes[place] if len(vocab.classes) else 0
                    rare = [words[i] for i in gone]
                    kinds[gone] = [first_bucket + bucket(w) for w in rare]
                    kinds[-1] = vocab.end_class
                    there = place[place >= 0]
                    has_own = vocab.classes[there] < first_bucket
                    in_shared = kinds[:-1][kinds[:-1] >= first_bucket] - first_bucket
                    tally = Counter(rare)
                    rows.append(
                        (
                            len(kinds),
                            int((vocab.counts[there] > 0).sum()) + (vocab.ends > 0),
                            float(logs[there].sum()) + end_log,
                            float(logs[there[has_own]].sum()) + end_log,
                            float(vocab.shared[in_shared].sum()),
                            kinds.astype("<u2").tobytes(),
                            list(tally),
                            list(tally.values()),
                        )
                    )
                cols = list(zip(*rows)) if rows else [()] * 8
                kinds_of = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), *(pa.array(c, k) for c, k in zip(cols, kinds_of))],
                    ["doc_id", "train", "n_tokens", "n_known", "logs", "own_logs", "shared_logs", "classes", "rare", "times"],
                )

    return docs.select("doc_id", "text", "train").mapInArrow(encode, schema).select(F.monotonically_increasing_id().alias("row_id"), "*")


def _arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, "<u2").astype(np.int32) for b in column.to_pylist()]


def train_hmm(sequences: DataFrame, vocabulary: Vocabulary, states: int = STATES, rounds: int = ROUNDS, seed: int = SEED) -> Hmm:
    """Baum-Welch over the class sequences of all training rows."""
    own = vocabulary.n_classes - 1 - BUCKETS
    counts = np.zeros(vocabulary.n_classes)
    np.add.at(counts, vocabulary.classes, vocabulary.counts)
    counts[own:-1] = 10**vocabulary.shared
    counts[-1] = vocabulary.ends
    hmm = Hmm.initial(counts, states, seed)
    train = sequences.where("train").select("classes")
    # written on its own, or each of the first rounds would read everything
    some = stored(sequences.where(F.col("train") & (F.pmod(F.xxhash64("doc_id", "classes"), F.lit(WARM_SHARE)) == 0)).select("classes"), "lm-warm")
    sizes = [states, states * states, vocabulary.n_classes * states, 1]
    last = -math.inf
    for nth in range(WARM_ROUNDS + rounds if vocabulary.ends else 0):
        current = sequences.sparkSession.sparkContext.broadcast(hmm)

        def expect(batches: Iterator[pa.RecordBatch], model=current) -> Iterator[pa.RecordBatch]:
            totals, log = [np.zeros(states), np.zeros((states, states)), np.zeros((sizes[2] // states, states))], 0.0
            held, positions = [], 0
            for batch in batches:
                for classes in batch.column(0):
                    held.append(np.frombuffer(classes.as_py(), "<u2").astype(np.int32))
                    positions += len(held[-1])
                    if positions >= POSITIONS:
                        log += model.value.expected(held, totals)
                        held, positions = [], 0
            log += model.value.expected(held, totals)
            flat = np.concatenate([*(t.ravel() for t in totals), [log]])
            some = np.nonzero(flat)[0]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(flat[some])], ["slot", "value"])

        flat = np.zeros(sum(sizes))
        rows = train if nth >= WARM_ROUNDS else some
        # states x (classes + states + 1) numbers
        summed = rows.mapInArrow(expect, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
        flat[summed.column("slot").to_numpy()] = summed.column("value").to_numpy()
        start, move, emit, (log,) = np.split(flat, np.cumsum(sizes)[:3])
        hmm = Hmm.from_counts(start, move.reshape(states, states), emit.reshape(-1, states))
        current.unpersist()
        if nth >= WARM_ROUNDS:
            if log - last < LEAST_GAIN * vocabulary.tokens:
                break
            last = log
    return hmm


def forward_scores(sequences: DataFrame, hmm: Hmm) -> DataFrame:
    """sequences without classes and words, with the exact log10 likelihood of the classes (hmm_score)."""
    model = sequences.sparkSession.sparkContext.broadcast(hmm)

    @F.arrow_udf("double")
    def forward(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(model.value.log10_likelihoods(_arrays(column)))

    return sequences.select("row_id", "doc_id", "train", "n_tokens", "n_known", "logs", "own_logs", "shared_logs", forward("classes").alias("hmm_score"))


def lm_scores(docs: DataFrame, train: Column, states: int = STATES, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """One row for each row of docs: doc_id, train, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select("doc_id", "text", F.coalesce(train, F.lit(True)).alias("train"))
    ends = rows.where("train").count()
    counts = stored(count_words(rows), "lm-counts")
    vocabulary = build_vocabulary(counts, ends)
    sequences = stored(class_sequences(rows, vocabulary), "lm-sequences")
    hmm = train_hmm(sequences, vocabulary, states, rounds, seed)
    # rare words of a row meet their counts by word; a rare word is rare among all rows, so no key is hot
    pairs = sequences.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("p")).select("row_id", "p.rare", "p.times")
    found = pairs.join(counts.where("trained > 0").select("word", "trained").hint("shuffle_hash"), F.col("rare") == F.col("word"), "left")
    count = F.coalesce("trained", F.lit(0))
    rare = found.groupBy("row_id").agg(
        F.sum(F.col("times") * F.log10(count + SMOOTH)).alias("rare_logs"), F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )
    out = forward_scores(sequences, hmm).join(rare, "row_id", "left")
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    base = logs - F.col("n_tokens") * F.lit(math.log10(vocabulary.tokens + SMOOTH * (vocabulary.kinds + 1)))
    return out.select(
        "doc_id",
        "train",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("hmm_score") + logs - F.col("own_logs") - F.col("shared_logs")).alias("score"),
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(F.col("doc_id"), 5, 1)
    out = lm_scores(documents(spark, sf_dir), ~held)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op10_lm_scoring": op10_lm_scoring}
ORACLE: dict[str, str] = {}
