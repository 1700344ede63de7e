"""Proposals for texts alike: bands of minimum hashes, and the check on whole shingle sets.

64-bit SimHash fingerprints of two texts whose shingle sets have a Jaccard similarity of 0.8 differ in about ten bits, which no byte
count reaches. Operator 9, where it links by text similarity, therefore takes further proposals from here: two texts meet if they share
one of 20 bands of 5 minimum hashes (at similarity 0.8 with probability 0.9997, more above) and the share of their 100 minimum hashes that
agree is at least ``similarity - SLACK``. Proposals are only that: every link is verified on the two whole shingle sets.

A bucket (texts of one band) of m texts is never multiplied out where its texts hang together, and never gathered in one task. First, in
chunks of about CHUNK texts, each text meets its neighbour in a seeded order, another one in each band. Then, only in buckets that verified links leave
in several components, the texts outside the largest component meet all others of the bucket in blocks of about CHUNK x CHUNK texts of usual length. A block
has the shingle sets, so that it verifies its pairs itself and returns links only: pairs that are alike but not enough grow with the square of a group. A pair
is verified in the first band that it shares, and not any more once links of the block connect it. Texts of one component needn't meet, the groups being the
components. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, with_facts

BANDS, ROWS = 20, 5
#: Almost four standard deviations of the estimate from 100 minimum hashes at similarity 0.8.
SLACK = 0.15
#: Texts of a bucket that are gathered together, about.
CHUNK = 4096
#: Shingles of a text of usual length; one with more counts as several where blocks are dealt out.
USUAL = 256
#: Shingles hashed at once; bounds memory on very long texts.
BLOCK = 1 << 12
_RNG = np.random.default_rng(9)
_FACTORS = _RNG.integers(0, 2**31, (BANDS * ROWS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _RNG.integers(0, 2**32, (BANDS * ROWS, 1), dtype=np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each of the 100 hash functions over the shingle hashes (64 bits, at least one)."""
    words = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    for at in range(0, len(words), BLOCK):
        np.minimum(low, (words[None, at : at + BLOCK] * _FACTORS + _SHIFTS).min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    out = np.zeros(BANDS, np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        out = (out ^ column) * _MIX
        out ^= out >> np.uint64(29)
    return out


def byte_each(low: np.ndarray) -> bytes:
    """A byte of each minimum, mixed: the high byte of a minimum is hardly ever other than zero."""
    return (low * _MIX >> np.uint64(56)).astype(np.uint8).tobytes()


def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    x, y = (np.concatenate([np.empty(0, np.int64), *side]) for side in (a, b))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def bucket_sizes(posted: DataFrame) -> DataFrame:
    """(bucket, n) of the buckets of two texts or more of posted (node, place, bucket)."""
    return posted.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def neighbours(members: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Pairs (a, b) that follow each other in a chunk of a bucket, in a seeded order that differs from band to band; members: node, place, bucket, n."""
    salt = F.pmod(F.xxhash64("place", "node"), F.ceil(F.col("n") / chunk))
    chunks = members.groupBy("place", "bucket", salt.alias("chunk")).agg(F.collect_list("node").alias("nodes")).where(F.size("nodes") > 1)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for place, nodes in zip(batch.column("place").to_pylist(), batch.column("nodes")):
                nodes = nodes.values.to_numpy()
                nodes = nodes[np.argsort((nodes.view(np.uint64) ^ np.uint64(place + 1)) * (_MIX + np.uint64(2 * place)))]
                a.append(nodes[:-1])
                b.append(nodes[1:])
            yield _pairs(a, b)

    return chunks.select("place", "nodes").mapInArrow(walk, "a long, b long").distinct()


def reach(both: np.ndarray, x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of x and y shingles that share ``both`` have the similarity."""
    return (both >= similarity * (x + y - both) - 1e-9) & (both > 0)


def block_links(place: int, ms: pa.StructArray, similarity: float) -> tuple[list[int], list[int]]:
    """Links from the asking texts of a block to texts of other components, as many as connect them."""
    node, root = ms.field("node").to_numpy(), ms.field("root").to_numpy().copy()
    asks, minor = (ms.field(c).to_numpy(zero_copy_only=False) for c in ("asks", "minor"))
    low = np.frombuffer(b"".join(ms.field("low").to_pylist()), np.uint8).reshape(len(node), -1)
    earlier = ms.field("bands").flatten().to_numpy().reshape(len(node), -1)[:, :place]
    sizes, held = ms.field("held").value_lengths().to_numpy().astype(np.int64), ms.field("held").flatten().to_numpy().view(np.uint64)
    starts = np.cumsum(sizes) - sizes
    others, a, b = np.nonzero(~asks)[0], [], []
    for k in np.nonzero(asks)[0]:
        # of two texts outside the largest component the one with the smaller node asks
        rest = others[(root[others] != root[k]) & ~(minor[others] & (node[others] < node[k]))]
        rest = rest[np.minimum(sizes[rest], sizes[k]) >= similarity * np.maximum(sizes[rest], sizes[k]) - 1e-9]
        rest = rest[~(earlier[rest] == earlier[k]).any(axis=1)]
        same = np.count_nonzero(low[rest] == low[k], axis=1)
        near = same >= (similarity - SLACK) * low.shape[1]
        rest = rest[near][np.argsort(-same[near], kind="stable")]
        mine = held[starts[k] : starts[k] + sizes[k]]
        # the likeliest first, and ever more at once
        step = 1
        while len(rest):
            some, rest, step = rest[:step], rest[step:], min(2 * step, 256)
            found = np.concatenate([held[starts[x] : starts[x] + sizes[x]] for x in some])
            hit = mine[np.minimum(np.searchsorted(mine, found), len(mine) - 1)] == found
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes[some]) - sizes[some])
            for x in some[reach(both, sizes[some], sizes[k], similarity)]:
                if root[x] != root[k]:
                    a.append(int(node[k]))
                    b.append(int(node[x]))
                    root[root == root[x]] = root[k]
            rest = rest[root[rest] != root[k]]
    return a, b


def across(members: DataFrame, signatures: DataFrame, roots: DataFrame, sets_of, similarity: float, chunk: int = CHUNK) -> DataFrame:
    """Verified links (a, b) between texts of a bucket in different components; a is outside the largest component. sets_of(nodes, tag) has their shingle sets."""
    placed = members.select("place", "bucket", "node").join(roots, "node", "left").select("place", "bucket", "node", F.coalesce("root", "node").alias("root"))
    placed = stored(placed, "rooted")
    parts = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("m"))
    torn = parts.groupBy("bucket").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.sum("m").alias("n"), F.count(F.lit(1)).alias("parts"))
    torn = stored(torn.where("parts > 1").select("bucket", "main", "n"), "torn")
    told = stored(with_facts(placed, torn, "bucket", "n", placed.count(), ["main", "n"]), "torn-members")
    sets = sets_of(told.select("node"), "across")
    minor = F.col("root") != F.col("main")
    told = told.join(sets.select("node", F.ceil(F.size("held") / USUAL).alias("weight")), "node").select("place", "bucket", "node", "root", minor.alias("minor"), "weight", "n")
    told = stored(told, "weighed")
    sizes = told.groupBy("bucket").agg(F.max("n").alias("n"), F.sum("weight").alias("all"), F.sum(F.when(F.col("minor"), F.col("weight")).otherwise(0)).alias("minors"))
    deal = [F.ceil(F.col(c) / chunk).cast("int").alias(name) for c, name in (("all", "blocks"), ("minors", "lanes"))]
    told = with_facts(told.drop("n"), stored(sizes.select("bucket", "n", *deal), "deals"), "bucket", "n", told.count(), ["blocks", "lanes"])
    mine, theirs = F.pmod(F.xxhash64("node"), "blocks").cast("int"), F.pmod(F.xxhash64("node"), "lanes").cast("int")
    facts = ["place", "bucket", "node", "root", "minor"]
    each = told.select(*facts, F.lit(False).alias("asks"), mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("j"))
    asks = told.where("minor").select(*facts, F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), theirs.alias("j"))
    full = each.union(asks).join(signatures.select("node", "low", "bands").join(sets, "node"), "node")
    grid = full.groupBy("place", "bucket", "i", "j").agg(F.collect_list(F.struct("node", "root", "low", "bands", "held", "minor", "asks")).alias("ms"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, ms in zip(batch.column(0).to_pylist(), batch.column(1)):
                a, b = block_links(place, ms.values, similarity)
                yield _pairs([np.array(a, np.int64)], [np.array(b, np.int64)])

    return grid.select("place", "ms").mapInArrow(walk, "a long, b long").distinct()


def agree(least: float) -> Column:
    """Whether low_a and low_b (a byte a minimum hash) agree in a share of at least ``least``."""

    @F.arrow_udf("boolean")
    def enough(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            x, y = (np.frombuffer(b"".join(s.to_pylist()), np.uint8).reshape(len(s), -1) for s in (left, right))
            yield pa.array(np.count_nonzero(x == y, axis=1) >= least * BANDS * ROWS)

    return enough("low_a", "low_b")


def alike(similarity: float) -> Column:
    """Whether the Jaccard similarity of the shingle sets of_a and of_b (sorted hashes) reaches the bound."""

    @F.arrow_udf("boolean")
    def reaches(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = []
            for x, y in zip(left, right):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                # the sizes alone can rule a pair out
                both = 0 if min(len(x), len(y)) < similarity * max(len(x), len(y)) else len(np.intersect1d(x, y, assume_unique=True))
                out.append(bool(reach(both, len(x), len(y), similarity)))
            yield pa.array(out, pa.bool_())

    return reaches("of_a", "of_b")


def proposals(signatures: DataFrame, verify, roots_of, sets_of, similarity: float, chunk: int = CHUNK) -> list[DataFrame]:
    """Verified edges (a, b) among signatures (stored; node, bands, low); verify(pairs, tag) checks pairs, roots_of(edges) finds components, sets_of(nodes, tag) shingle sets."""
    posted = signatures.select("node", F.posexplode("bands").alias("place", "shared")).select("node", "place", F.xxhash64("place", "shared").alias("bucket"))
    sizes = stored(bucket_sizes(posted), "bucket-sizes")
    told = with_facts(posted, sizes, "bucket", "n", signatures.count() * BANDS, ["n"])
    members = stored(told.select("node", "place", "bucket", "n"), "buckets")

    def promising(pairs: DataFrame) -> DataFrame:
        left, right = (signatures.select(F.col("node").alias(x), F.col("low").alias(f"low_{x}")) for x in "ab")
        return pairs.join(left, "a").join(right, "b").where(agree(similarity - SLACK)).select("a", "b")

    near = verify(promising(neighbours(members, chunk)), "near")
    return [near, stored(across(members, signatures, roots_of(near), sets_of, similarity, chunk), "across")]
