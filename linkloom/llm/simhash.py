"""SimHash near-dedup over a byte-position inverted index with count filtering.

A 64-bit fingerprint has eight positional bytes. Two fingerprints that differ in at most ``max_bits``
= 2 bits differ in at most two bytes, so they share at least 6 of the 8 positional bytes: the guaranteed
minimum count. The inverted index posts a fingerprint under sets of positions with their bytes: a list a single (position, byte) would hold
N/256 fingerprints, and its tallies would be quadratic in N. The eight positions make four bundles of two; two
differing bytes spoil two bundles at most, so a pair within the distance shares two bundles whole and meets in one of
six lists keyed by four positional bytes. In a list the shared positional bytes of a met pair are tallied, pairs that reach the minimum count are
retained, and the Hamming distance is verified.

Lists longer than ``LONG_LIST`` are dealt out under longer sets, of the list's four positions and two more. A pair in the list with six shared bytes shares
one of them whole, so none is lost; such a list varies in two bytes only and holds at most 65,536 entries whatever the input. Fingerprints are made
distinct first, so a group of exact copies is one posting. Of each list a spanning forest of its links is emitted, never all pairs;
every link stays represented by a path. Components come from alternating
large-star and small-star contraction, written to the shared folder after each round.

Where a pipeline asks for similar texts rather than near fingerprints (keep_one_per_group), the posting lists only propose, on fingerprints of five-word
shingles; module ``bands`` proposes the pairs beyond their reach, and a link is a verified Jaccard similarity.

Defined results: null or word-less text has fingerprint zero and links like any other; null doc_ids take part
and never name a component unless all its ids are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bands
from .common import WORD, attach_facts, documents, may_hold, stored

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BYTES = 8
#: Entries of a posting list that are walked as they are; longer lists are dealt out under longer sets of positions.
LONG_LIST = 4096
MAX_ROUNDS = 50
#: The pipeline's stage: words a shingle and least Jaccard similarity of the shingle sets.
STAGE_SHINGLE, SIMILARITY = 5, 0.8
#: Rows handed to the bit counter at once; bounds memory on very long texts.
BLOCK = 1 << 15


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; the whole sequence where it is shorter; none for no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(width)))))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(grams))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is set when over half of the hashes have it."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits((counts * 2 > len(hashes)).astype(np.uint8))
    return int(bits.view(">u8")[0])


def simhash_udf(width: int = SHINGLE):
    """Arrow UDF from a text column to its fingerprint as a signed long."""

    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = np.fromiter((fingerprint(shingle_hashes(x, width)) for x in texts.to_pylist()), np.uint64, len(texts))
            yield pa.array(out.view(np.int64))

    return simhash


def guaranteed_bytes(max_bits: int) -> int:
    """Positional bytes that two fingerprints share at least when they differ in max_bits bits at most."""
    if not 0 <= max_bits < BYTES:
        raise ValueError(f"the byte count filter holds for 0 to {BYTES - 1} bits, not {max_bits}")
    return BYTES - max_bits


def posting_places(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions to post under, one of which any pair within max_bits bits shares.

    The positions are dealt to max_bits + 2 bundles (as many as there are bytes at most). Differing bits spoil max_bits bundles at most, so that the
    others, two unless bytes run out, are shared whole: a set is the positions of so many bundles.
    """
    n = min(BYTES, max_bits + 2)
    bundles = [tuple(range(BYTES * i // n, BYTES * (i + 1) // n)) for i in range(n)]
    return [tuple(p for bundle in some for p in bundle) for some in combinations(bundles, n - max_bits)]


def longer_places(places: tuple[int, ...], max_bits: int) -> list[tuple[int, ...]]:
    """The sets of guaranteed_bytes(max_bits) positions that hold places: a pair that shares places and the guaranteed count shares one of them whole."""
    rest = [p for p in range(BYTES) if p not in places]
    return [tuple(sorted(places + more)) for more in combinations(rest, guaranteed_bytes(max_bits) - len(places))]


def _mask(places: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * p) for p in places)


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _masks(sets: list[tuple[int, ...]]) -> Column:
    return F.array(*[F.lit(_signed(_mask(s))) for s in sets])


def forest(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the distinct fingerprints of one posting list.

    A breadth-first walk in which each step tallies the positional bytes that one fingerprint shares with those not yet reached, retains
    the guaranteed count and verifies the bits.
    """
    least = guaranteed_bytes(max_bits)
    left, edges = np.sort(values.view(np.uint64)), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            apart = left ^ at
            tally = np.count_nonzero(apart.view(np.uint8).reshape(-1, BYTES) == 0, axis=1)
            near = tally >= least
            near[near] = np.bitwise_count(apart[near]) <= max_bits
            if near.any():
                edges += [(int(at), int(x)) for x in left[near]]
                queue += list(left[near])
                left = left[~near]
    return edges


def posting_lists(prints: DataFrame, max_bits: int = MAX_BITS, long: int = LONG_LIST) -> DataFrame:
    """fps: the posting lists of two entries or more of the distinct fingerprints (stored, column fp).

    A list of more than ``long`` entries is dealt out under longer sets of positions. It shares its own positions, so a pair in it with the guaranteed count
    shares one of the longer sets, and meets there.
    """
    sets = posting_places(max_bits)
    posted = prints.select("fp", F.posexplode(_masks(sets)).alias("place", "mask")).select("fp", "place", F.col("fp").bitwiseAND(F.col("mask")).alias("shared"))
    # lists whose keys collide here are at worst dealt out without need
    posted = posted.withColumn("posting", F.xxhash64("place", "shared"))
    lengths = stored(posted.groupBy("posting").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long).withColumn("is_long", F.lit(True)), "long-lists")

    def grouped(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    if lengths.isEmpty():
        return grouped(posted, "place", "shared")
    told = attach_facts(posted, lengths, "posting", "n", prints.count() * len(sets), ["is_long"])
    more = F.element_at(F.array(*[_masks(longer_places(s, max_bits)) for s in sets]), F.col("place") + 1)
    dealt = told.where("is_long").select("fp", "place", F.posexplode(more).alias("sub", "mask")).select("fp", "place", "sub", F.col("fp").bitwiseAND(F.col("mask")).alias("shared"))
    return grouped(told.where("is_long IS NULL"), "place", "shared").union(grouped(dealt, "place", "sub", "shared"))


def links(prints: DataFrame, max_bits: int = MAX_BITS, long: int = LONG_LIST) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (stored, column fp): a spanning forest of every posting list."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [e for fps in batch.column(0) for e in forest(fps.values.to_numpy(), max_bits)]
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return posting_lists(prints, max_bits, long).mapInArrow(walk, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, root) of every node in edges (a, b): root is the smallest node of its component.

    Alternating large-star and small-star contraction; what is left after the last round is a star a component.
    Raises if ``max_rounds`` rounds don't suffice: a partial answer is never returned.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    now = stored(edges.select(a.alias("u"), b.alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        now = stored(small, "stars")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
        mark = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_groups(prints: DataFrame, max_bits: int = MAX_BITS, edges: DataFrame | None = None) -> DataFrame:
    """Facts a distinct fingerprint of prints (doc_id, fp): n, root fingerprint, component_id, keep (doc_id, fp) of the component.

    ``edges`` (a, b), if given, link the fingerprints instead of their distance.
    """
    distinct = stored(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")), "prints")
    if edges is None:
        edges = stored(links(distinct, max_bits), "links")
    roots = components(edges)
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "n", "first_id", F.coalesce("root", "fp").alias("root"))
    # null ids last: an id names the component if there is one
    best = F.min(F.struct(F.col("first_id").isNull(), F.col("first_id"), F.col("fp"))).alias("best")
    tops = rooted.groupBy("root").agg(best, F.count(F.lit(1)).alias("prints")).where("prints > 1")
    tops = stored(tops.select("root", "prints", F.col("best.first_id").alias("top_id"), F.col("best.fp").alias("top_fp")), "tops")
    told = attach_facts(rooted, tops, "root", "prints", distinct.count(), ["top_id", "top_fp"])
    # a component of one print has its own facts
    alone = F.col("top_fp").isNull()
    return told.select(
        "fp",
        "n",
        F.when(alone, F.col("first_id")).otherwise(F.col("top_id")).alias("component_id"),
        F.coalesce("top_fp", "fp").alias("keep_fp"),
    )


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_components(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row a document: doc_id, fingerprint, component_id."""
    prints = stored(docs.select("doc_id", simhash_udf(width)("text").alias("fp")), "simhash")
    facts = stored(near_groups(prints, max_bits), "groups")
    out = attach_facts(prints, facts, "fp", "n", prints.count(), ["component_id"])
    return out.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


# --- links by text similarity -------------------------------------------------------------------------------------


def text_node(text: Column) -> Column:
    """The node of a text: its hash, and one node for all texts without a word."""
    return F.when(F.coalesce(text.rlike(WORD), F.lit(False)), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))


def signature_udf(width: int):
    """Arrow UDF from a text column to struct(fp, bands, low): fingerprint, band keys and a byte of each minimum hash; bands are null without a word."""

    @F.arrow_udf("struct<fp:long,bands:array<long>,low:binary>")
    def signature(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            prints, keys, lows = np.zeros(len(texts), np.uint64), [], []
            for i, text in enumerate(texts):
                hashes = shingle_hashes(text.as_py(), width)
                prints[i] = fingerprint(hashes)
                low = bands.minima(hashes) if len(hashes) else None
                keys.append(None if low is None else bands.band_keys(low).view(np.int64))
                lows.append(None if low is None else bands.byte_each(low))
            parts = [pa.array(prints.view(np.int64)), pa.array(keys, pa.list_(pa.int64())), pa.array(lows, pa.binary())]
            yield pa.StructArray.from_arrays(parts, ["fp", "bands", "low"])

    return signature


def shingles_udf(width: int):
    """Arrow UDF from a text column to the sorted set of its shingle hashes."""

    @F.arrow_udf("array<long>")
    def shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([np.unique(shingle_hashes(x.as_py(), width)).view(np.int64) for x in texts], pa.list_(pa.int64()))

    return shingles


def similar_links(docs: DataFrame, similarity: float = SIMILARITY, width: int = STAGE_SHINGLE, max_bits: int = MAX_BITS) -> list[DataFrame]:
    """Edges (a, b) between the nodes of texts whose sets of ``width``-word shingles have a Jaccard similarity of at least ``similarity``.

    Proposed by the posting lists of their fingerprints and by bands of minimum hashes; each verified on both whole shingle sets.
    """
    noded = docs.select(text_node(F.col("text")).alias("node"), "text").where("node <> 0")
    signatures = noded.select("node", signature_udf(width)("text").alias("s")).groupBy("node").agg(F.first("s").alias("s"))
    signatures = stored(signatures.select("node", "s.*"), "signatures")

    def sets_of(nodes: DataFrame, tag: str) -> DataFrame:
        wanted = stored(nodes.distinct(), f"{tag}-nodes")
        # texts that nobody asks for don't move
        texts = noded.where(may_hold(wanted, "node")).join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
        return stored(texts.select("node", shingles_udf(width)("text").alias("held")), "shingles")

    def verify(pairs: DataFrame, tag: str) -> DataFrame:
        pairs = stored(pairs, f"{tag}-pairs")
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), tag)
        left, right = (sets.select(F.col("node").alias(x), F.col("held").alias(f"of_{x}")) for x in "ab")
        return stored(pairs.join(left, "a").join(right, "b").where(bands.alike(similarity)).select("a", "b"), tag)

    # texts of one fingerprint meet the first of them, and the first ones of linked fingerprints meet
    prints = stored(signatures.groupBy("fp").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")), "prints")
    equal = attach_facts(signatures.select("node", "fp"), prints.where("n > 1"), "fp", "n", signatures.count(), ["first"])
    equal = equal.where("first <> node").select(F.col("first").alias("a"), F.col("node").alias("b"))
    ends = [prints.select(F.col("fp").alias(x), F.col("first").alias(f"node_{x}")) for x in "ab"]
    linked = links(prints.select("fp"), max_bits).join(ends[0], "a").join(ends[1], "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    found = [verify(equal.union(linked), "printed")]
    return found + bands.proposals(signatures, verify, lambda near: components(found[0].union(near)), sets_of, similarity)


def keep_one_per_group(docs: DataFrame, similarity: float = SIMILARITY, width: int = STAGE_SHINGLE) -> DataFrame:
    """The rows of docs that stay: the one with the smallest doc_id of every group linked by similar_links().

    Rows that repeat both doc_id and text are copies of one document; one of them stays. Texts without a word are one group; null ids come last.
    """
    prints = stored(docs.select("doc_id", text_node(F.col("text")).alias("fp")), "nodes")
    edges = reduce(DataFrame.union, similar_links(docs, similarity, width))
    facts = stored(near_groups(prints, edges=edges), "groups")
    told = attach_facts(prints, facts, "fp", "n", prints.count(), ["component_id", "keep_fp"])
    wins = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("keep_fp"))
    # one row a (doc_id, fp) that occurs: whether it stays, and how often it is there
    fate = stored(told.groupBy("doc_id", "fp").agg(F.max(wins).alias("wins"), F.count(F.lit(1)).alias("times")), "fate")
    lost = fate.where(~F.col("wins")).select("doc_id", "fp")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", text_node(F.col("text")).alias("fp"))
    same = lambda x, y: x.doc_id.eqNullSafe(y.doc_id) & (x.fp == y.fp)
    kept = rows.join(lost, same(rows, lost), "left_anti")
    twice = fate.where(F.col("wins") & (F.col("times") > 1)).select("doc_id", "fp")
    if not twice.isEmpty():
        once = kept.join(twice, same(kept, twice), "left_anti")
        more = kept.join(twice, same(kept, twice), "left_semi").groupBy("doc_id", "fp").agg(F.first("row").alias("row"))
        kept = once.select("row").union(more.select("row"))
    return kept.select("row.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))


QUERIES = {"op9_simhash": op9_simhash}
ORACLE: dict[str, str] = {}
