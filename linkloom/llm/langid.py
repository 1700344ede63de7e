"""Language ID with interpolated Kneser-Ney character models.

Per language an order-4 character model over letters and single spaces, with absolute discounting,
continuation counts below the highest order and full interpolation. The models of all languages share sorted
arrays of 64-bit n-gram hashes: a binary search finds the n-gram once and a row beside it holds
every language's probability, so that a text is scored for all languages in one pass over its characters.
The language with the lowest cross-entropy a character wins; a rejection threshold is calibrated per
language on held-back rows of the training sample (split-conformal quantile).

The sample is bounded: of each language the rows with the smallest seeded hash, ``FIT_DOCS`` to fit on and up to
``CALIBRATION_DOCS`` more to calibrate on; of a language with fewer rows than 4/3 x ``FIT_DOCS`` a quarter calibrates. The quantile at
``REJECT_SHARE`` exists from 999 calibration rows on; with fewer the limit is the largest value and as much again.

Defined results: ``und`` with score 0 for null text and text without a letter (marks alone are none); ties go to the first language in
code-point order; with no labelled row at all every text is ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, stored

ORDER = 4
#: Rows of a language that a model is fitted on, at most.
FIT_DOCS = 450
#: Further rows of a language that calibrate its threshold, at most: four times what the quantile at REJECT_SHARE needs.
CALIBRATION_DOCS = 4000
SEED = 8
#: Share of in-language texts that the calibrated threshold may reject.
REJECT_SHARE = 0.001
#: Below this many calibration rows a quantile says little: nothing is rejected.
LEAST_CALIBRATION = 50
#: Characters scored at once; bounds memory on very long texts.
BLOCK = 1 << 18
#: Cross-entropies of texts shorter than this are shrunk towards the mean before the threshold sees them.
FULL_LENGTH = 400
#: Characters of evidence that the posterior score takes at most.
EVIDENCE = 40
UNDETERMINED = "und"
SPACE = 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _fold_table() -> tuple[np.ndarray, np.ndarray]:
    """Code point to lower-cased letter, mark or space; and whether it is a letter."""
    table, letter = np.full(sys.maxunicode + 1, SPACE, np.uint32), np.zeros(sys.maxunicode + 1, bool)
    for cp in range(sys.maxunicode + 1):
        ch = chr(cp)
        kind = unicodedata.category(ch)[0]
        if kind in "LM":
            low = ch.lower()
            table[cp], letter[cp] = ord(low) if len(low) == 1 else cp, kind == "L"
    return table, letter


def letters_only(text: str) -> np.ndarray:
    """Lower-case letters and their marks with one space at either end and between runs of them; empty for a text without a letter."""
    table, letter = _fold_table()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not letter[points].any():
        return np.empty(0, np.uint32)
    folded = np.concatenate([[SPACE], table[points], [SPACE]]).astype(np.uint32)
    return folded[np.concatenate([[True], (folded[1:] != SPACE) | (folded[:-1] != SPACE)])]


def gram_hashes(chars: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each position order-1, order, ..."""
    n = len(chars) - order + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(order):
        out = (out + chars[k : k + n].astype(np.uint64) + np.uint64(1)) * _MIX
        out ^= out >> np.uint64(29)
    return out


def find(keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in the sorted keys, and which are there."""
    if not len(keys):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.searchsorted(keys, hashes)
    at[at == len(keys)] = 0
    return at, keys[at] == hashes


@dataclass
class Level:
    """N-grams of one length of one language, by hash: interpolated with nothing yet."""

    grams: np.ndarray
    own: np.ndarray  # discounted share in the context
    suffixes: np.ndarray  # hash of the gram without its first character
    contexts: np.ndarray  # hash of the gram without its last character
    seen: np.ndarray  # the distinct contexts, sorted
    rest: np.ndarray  # what each of them leaves to the shorter grams


def language_levels(texts: list[str], order: int = ORDER) -> list[Level]:
    """Counts of one language for Kneser-Ney: of grams of ``order`` characters, and of the characters before shorter ones."""
    runs = [r for r in map(letters_only, texts) if len(r)]
    pad = np.full(order - 1, SPACE, np.uint32)
    chars = np.concatenate([np.empty(0, np.uint32), *(x for r in runs for x in (pad, r[1:]))])
    sizes = np.array([len(r) + order - 2 for r in runs], np.int64)
    # grams within a text; those that straddle two texts are left out
    place = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.nonzero(place + order <= np.repeat(sizes, sizes))[0]
    levels: list[Level] = []
    for k in range(order, 0, -1):
        hashes, shorter = gram_hashes(chars, k), gram_hashes(chars, k - 1) if k > 1 else np.zeros(len(chars) + 1, np.uint64)
        grams, first, counts = np.unique(hashes[at], return_index=True, return_counts=True)
        at = at[first]
        once, twice = int((counts == 1).sum()), int((counts == 2).sum())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        contexts = shorter[at]
        seen, which, kinds = np.unique(contexts, return_inverse=True, return_counts=True)
        total = np.bincount(which, counts, len(seen))
        levels.insert(0, Level(grams, (counts - discount) / total[which], shorter[at + 1], contexts, seen, discount * kinds / total))
        at = at + 1  # each distinct gram is one character before its suffix
    return levels


@dataclass
class KneserNey:
    """The models of all languages. Index k of the lists belongs to n-grams of k+1 characters."""

    languages: list[str]
    keys: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    context_keys: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    unseen: np.ndarray | None = None
    mean: np.ndarray | None = None
    limit: np.ndarray | None = None

    @classmethod
    def merge(cls, levels: dict[str, list[Level]]) -> KneserNey:
        """Interpolate each language over the n-grams of all, in sorted arrays."""
        langs = sorted(levels)
        model, below = cls(langs), None
        if not langs:
            return model
        for k in range(len(levels[langs[0]])):
            own = [levels[lang][k] for lang in langs]
            keys, first = np.unique(np.concatenate([x.grams for x in own]), return_index=True)
            contexts = np.concatenate([x.contexts for x in own])[first]
            seen = np.unique(np.concatenate([x.seen for x in own]))
            prob, rest = np.zeros((len(keys), len(langs))), np.ones((len(seen), len(langs)))
            for j, x in enumerate(own):
                rest[np.searchsorted(seen, x.seen), j] = x.rest
                prob[np.searchsorted(keys, x.grams), j] = x.own
            # characters that no language has share one place in the alphabet
            shorter = 1 / (len(keys) + 1) if k == 0 else below[np.searchsorted(model.keys[-1], np.concatenate([x.suffixes for x in own])[first])]
            prob += rest[np.searchsorted(seen, contexts)] * shorter
            if k == 0:
                model.unseen = np.log2(rest[0] / (len(keys) + 1)).astype(np.float32) if len(seen) else np.zeros(len(langs), np.float32)
            model.keys.append(keys)
            model.logp.append(np.log2(prob).astype(np.float32))
            model.context_keys.append(seen if k else np.empty(0, np.uint64))
            model.backoff.append((np.log2(rest) if k else np.zeros((0, len(langs)))).astype(np.float32))
            below = prob
        return model

    def log2_probs(self, chars: np.ndarray) -> np.ndarray:
        """log2 P(character | the characters before it) for every language, from position order-1 on."""
        order = len(self.keys)
        n = len(chars) - order + 1
        out = np.zeros((max(n, 0), len(self.languages)), np.float32)
        todo = np.arange(max(n, 0))
        for k in range(order - 1, -1, -1):
            if not len(todo):
                return out
            hashes = gram_hashes(chars, k + 1)[todo + order - 1 - k]
            at, there = find(self.keys[k], hashes)
            out[todo[there]] += self.logp[k][at[there]]
            todo = todo[~there]
            if k and len(todo):
                at, known = find(self.context_keys[k], gram_hashes(chars, k)[todo + order - 1 - k])
                out[todo[known]] += self.backoff[k][at[known]]
        out[todo] += self.unseen
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in bits a character of every text and language; the number of characters scored (0: no letter)."""
        order, sums, sizes = len(self.keys), np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        pad = np.full(order - 1, SPACE, np.uint32)
        parts, owners, held = [], [], 0

        def flush() -> None:
            if not parts:
                return
            lp = self.log2_probs(np.concatenate(parts))
            # windows that straddle two texts end inside a text's leading pad and are left out
            ends = np.cumsum([len(p) for p in parts])
            for (i, fresh), part, end in zip(owners, parts, ends):
                first = end - len(part)
                sums[i] += lp[first : end - order + 1].sum(axis=0, dtype=np.float64)
                sizes[i] += fresh
            parts.clear()
            owners.clear()

        for i, text in enumerate(texts):
            chars = letters_only(text) if text else np.empty(0, np.uint32)
            if not len(chars):
                continue
            chars = np.concatenate([pad, chars[1:]])
            for at in range(0, len(chars) - order + 1, BLOCK):
                part = chars[at : at + BLOCK + order - 1]
                parts.append(part)
                owners.append((i, len(part) - order + 1))
                held += len(part)
                if held >= BLOCK:
                    flush()
                    held = 0
        flush()
        return -sums / np.maximum(sizes, 1)[:, None], sizes

    def calibrate(self, rows: list[tuple[str, np.ndarray, int]], share: float = REJECT_SHARE) -> None:
        """rows: (language, entropies, size) of texts that the counts haven't seen."""
        k = len(self.languages)
        self.mean, self.limit = np.zeros(k), np.full(k, np.inf)
        for j, lang in enumerate(self.languages):
            # a text that another model fits better is mislabelled for this purpose
            own = [(h[j], n) for was, h, n in rows if was == lang and n and int(np.argmin(h)) == j]
            if len(own) < LEAST_CALIBRATION:
                continue
            h, n = np.array([x for x, _ in own]), np.array([x for _, x in own])
            self.mean[j] = np.average(h, weights=n)
            odd = np.sort(self._oddness(h, n, self.mean[j]))
            rank = math.ceil((len(odd) + 1) * (1 - share))
            # a quantile beyond the sample (small tables only): its largest value and as much again
            self.limit[j] = odd[rank - 1] if rank <= len(odd) else 2 * odd[-1] + 0.5

    @staticmethod
    def _oddness(h, n, mean):
        return (h - mean) * np.sqrt(np.minimum(n, FULL_LENGTH) / FULL_LENGTH)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, posterior score, cross-entropy and whether the text is rejected, for each text."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool)
        h, n = self.entropies(texts)
        best = h.argmin(axis=1)
        low = h[np.arange(len(h)), best]
        weight = np.minimum(n, EVIDENCE)[:, None]
        score = 1 / np.exp2(-(h - low[:, None]) * weight).sum(axis=1)
        void = n == 0
        langs = [UNDETERMINED if v else self.languages[b] for v, b in zip(void, best)]
        mean, limit = (self.mean, self.limit) if self.mean is not None else (np.zeros(len(self.languages)), np.full(len(self.languages), np.inf))
        odd = self._oddness(low, n, mean[best]) > limit[best]
        return langs, np.where(void, 0.0, score), np.where(void, 0.0, low), void | odd


def _sample(train: DataFrame, fit_docs: int, calibration_docs: int) -> DataFrame:
    """At most fit_docs + calibration_docs rows (lang, text, calibrates) of every language, by seeded hash of id and text.

    Rows that repeat both are one row. Those of a language whose hash is too large to be among the wanted (but for six standard
    deviations, and the error of the estimate of their number) never reach the window.
    """
    wanted = fit_docs + calibration_docs
    keyed = train.select("lang", "text", F.xxhash64(F.lit(SEED), "doc_id", "text").alias("rank_key")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one row a language, as many as there are models
    sizes = keyed.groupBy("lang").agg(F.approx_count_distinct("rank_key", 0.02).alias("n"))
    share = F.least(F.lit(1.0), F.lit(1.1 * (wanted + 6 * math.sqrt(wanted) + 20)) / F.col("n"))
    last = F.when(share >= 1.0, F.lit(2**63 - 1)).otherwise((share * float(2**64) - float(2**63)).cast("long"))
    cuts = stored(sizes.select(F.col("lang").alias("of"), last.alias("last")), "lang-cuts")
    early = keyed.join(F.broadcast(cuts), F.col("lang") == F.col("of")).where(F.col("rank_key") <= F.col("last"))
    early = stored(early.groupBy("lang", "rank_key").agg(F.first("text").alias("text")), "lang-sample")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("rank_key"))
    fits = F.least(F.lit(fit_docs), F.floor(F.count(F.lit(1)).over(Window.partitionBy("lang")) * 0.75))
    ranked = early.select("lang", "text", nth.alias("nth"), fits.alias("fits")).where(F.col("nth") <= wanted)
    return ranked.select("lang", "text", (F.col("nth") > F.col("fits")).alias("calibrates"))


_PARTS = ["grams", "own", "suffixes", "contexts", "seen", "rest"]


def train_language_models(train: DataFrame, fit_docs: int = FIT_DOCS, calibration_docs: int = CALIBRATION_DOCS, order: int = ORDER) -> KneserNey:
    """Fit on train (doc_id, text, lang): each language on the executors, from its bounded sample; the driver merges their sorted arrays."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        levels = language_levels(list(frame.text), order)
        rows = [{"lang": frame.lang.iloc[0], "k": k, **{p: getattr(x, p).tobytes() for p in _PARTS}} for k, x in enumerate(levels)]
        return pd.DataFrame(rows, columns=["lang", "k", *_PARTS])

    sample = stored(_sample(train, fit_docs, calibration_docs), "lang-ranked")
    fitted = sample.where(~F.col("calibrates")).groupBy("lang").applyInPandas(fit, "lang string, k int, " + ", ".join(f"{p} binary" for p in _PARTS))
    levels: dict[str, list] = {}
    for r in fitted.orderBy("lang", "k").toLocalIterator():
        parts = [np.frombuffer(r[p], np.float64 if p in ("own", "rest") else np.uint64) for p in _PARTS]
        levels.setdefault(r.lang, []).append(Level(*parts))
    # a language whose texts have no letter has no model
    model = KneserNey.merge({lang: x for lang, x in levels.items() if len(x[0].grams)})
    if model.languages:
        shared = train.sparkSession.sparkContext.broadcast(model)

        def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in batches:
                h, n = shared.value.entropies(list(frame.text))
                yield pd.DataFrame({"lang": frame.lang, "h": list(h), "n": n})

        held = sample.where("calibrates").select("lang", "text").mapInPandas(measure, "lang string, h array<double>, n long")
        model.calibrate([(r.lang, np.array(r.h), r.n) for r in held.collect()])
    return model


#: Rows scored together.
ROWS = 256


def predict_udf(model: KneserNey):
    """Arrow UDF from a text column to struct(lang_pred, score, cross_entropy, rejected)."""

    @F.arrow_udf("struct<lang_pred:string,score:double,cross_entropy:double,rejected:boolean>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            langs, rest = [], []
            for at in range(0, len(texts), ROWS):
                got, *more = model.predict(texts.slice(at, ROWS).to_pylist())
                langs += got
                rest.append(more)
            score, low, out = (np.concatenate([r[i] for r in rest]) if rest else np.empty(0) for i in range(3))
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(low, pa.float64()), pa.array(out.astype(bool))],
                ["lang_pred", "score", "cross_entropy", "rejected"],
            )

    return predict


def identify(docs: DataFrame, model: KneserNey) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy and rejected of every row."""
    return docs.select("doc_id", predict_udf(model)("text").alias("p")).select("doc_id", "p.*")


def drop_rejected(docs: DataFrame, model: KneserNey) -> DataFrame:
    """The rows of docs whose language is known and that the calibrated threshold accepts."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), predict_udf(model)("text").alias("p"))
    return rows.where(~F.col("p.rejected")).select("row.*")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held = held_out(F.col("doc_id"), 4, 2)
    model = train_language_models(docs.where(~held))
    return identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


QUERIES = {"op8_language_id": op8_language_id}
ORACLE: dict[str, str] = {}
