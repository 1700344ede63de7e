"""The byte-position index of operator 9 against brute force."""

import itertools
import random

import pytest
import xxhash

from linkloom.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def brute(fps, bits):
    """fingerprint: smallest fingerprint of its component."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in itertools.combinations(sorted(root), 2):
        if (x ^ y).bit_count() <= bits:
            p, q = find(x), find(y)
            root[max(p, q)] = min(p, q)
    return {f: find(f) for f in root}


@pytest.mark.parametrize("bits", range(8))
def test_every_pair_within_the_distance_shares_a_list(bits):
    sets = simhash.posting_places(bits)
    for spoilt in itertools.combinations(range(8), bits):
        meets = [s for s in sets if not set(s) & set(spoilt)]
        assert meets
        for s in meets:  # and one of the longer sets of that list
            longer = simhash.longer_places(s, bits)
            assert all(set(s) <= set(x) and len(x) == 8 - bits for x in longer)
            assert any(not set(x) & set(spoilt) for x in longer)
    with pytest.raises(ValueError):
        simhash.posting_places(8) and simhash.guaranteed_bytes(8)


@pytest.mark.parametrize(("bits", "long"), [(2, 4096), (2, 5), (1, 5), (4, 7)])
def test_links_equal_brute_force_with_hot_bytes(spark, bits, long):
    rng = random.Random(bits * 100 + long)
    fps = {0, 2**64 - 1}
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(8):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            fps.add(x)
    # half of all fingerprints share four bytes or more, so that lists are long
    fps |= {0x1122334400000000 | rng.getrandbits(32) for _ in range(150)} | {0x1122334455660000 | rng.getrandbits(12) for _ in range(100)}
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(table, bits, long).collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in edges)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    assert {f: find(f) for f in fps} == brute(fps, bits)


def test_whole_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = {}
    for r in docs:
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", (r.text or "").translate(LOWER)) if w]
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hs = [xxhash.xxh64_intdigest(g.encode("utf-8"), 42) for g in grams]
        prints[r.doc_id] = sum((sum(h >> b & 1 for h in hs) * 2 > len(hs)) << b for b in range(64))
    roots, first = brute(set(prints.values()), 2), {}
    for i, f in prints.items():
        first[roots[f]] = min(first.get(roots[f], i), i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op9_simhash(spark, sf).collect()}
    assert got == {i: (f"{f:016x}", first[roots[f]]) for i, f in prints.items()}
