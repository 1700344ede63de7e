"""Operators against brute force, exact round trips and held-out rows."""

import hashlib
import itertools
import math
import random
import re
import string
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import exact_dedup, hmm, langid, licenses, mixing, packing, quality, registry, simhash, toxicity, warc
from linkloom.llm.common import attach_facts, scratch_path

SF = "/root/testdata/sf0.001"


def test_registry():
    names = [n.split("_")[0] for n in registry.queries()]
    assert sorted(names) == sorted(f"op{k}" for k in range(1, 11))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "pages"):
        con.sql(f"create view {table} as from '{SF}/{table}.parquet'")
    got, want = registry.queries()[name](spark, SF).toPandas(), con.sql(registry.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    rows = lambda frame: sorted(frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist(), key=repr)
    assert sorted(got.columns) == columns
    assert rows(got) == rows(want)


def test_attach_facts_hot_and_cold(spark):
    members = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")).union(spark.createDataFrame([(9999, None)], "id long, k string"))
    facts = members.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = attach_facts(members, facts, "k", "n", members.count(), ["top"]).collect()
    assert len(got) == 5001
    assert all(r.top == (None if r.k is None else 4998 if r.k == "hot" else r.id) for r in got)


def test_exact_groups_tell_colliding_digests_apart(spark):
    rows = [(i, ["aa", "AA", "bb", "cc", None, ""][i % 6]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs, digest=lambda c: F.length(c).cast("string")).collect()}
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").lower(), []).append(i)
    assert got == {i: (max(g), len(g), i == max(g)) for g in groups.values() for i in g}


def test_quality_statistics_and_bound(spark):
    text = "a b c d a b c\na b c x\n\na b c x\n"
    r = quality.text_statistics(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id").first()
    words = text.split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    assert (r.n_words, r.n_repeat_words, r.n_dup_lines, r.word_chars) == (len(words), len(covered), 1, 15)
    for n, k, p in [(50, 0, 0.01), (50, 3, 0.1), (500, 20, 0.03), (40, 39, 0.5)]:
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_tail(k, n, p) == pytest.approx(exact, rel=1e-9)
    assert 0 < quality.binomial_tail(9_000, 10**6, 0.01) < 1e-20


def test_quality_thresholds_keep_the_good(spark):
    rng = random.Random(1)
    good = [(k, " ".join(rng.choice(["plain", "words", "here", "tree"]) + str(rng.randint(0, 10**6)) for _ in range(60))) for k in range(1500)]
    junk = [(k, " ".join("a#$%" + str(rng.randint(0, 10**6)) for _ in range(60))) for k in range(1500, 1700)]
    docs = spark.createDataFrame([(*r, "en") for r in good + junk], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k < 1500)) for k in range(1700) if k % 2], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.quality_rules(docs, labels).where("kept").collect()}
    assert len([k for k in range(1500) if k in kept]) >= 0.95 * 1500
    assert not [k for k in range(1500, 1700) if k in kept]


def test_license_suppression(spark):
    docs = spark.createDataFrame([(1, "Licensed under CC BY-NC 4.0. GNU Lesser General Public License, version 2.1"), (2, "nothing at all")], "doc_id long, text string")
    r = {x.doc_id: x for x in licenses.license_scan(docs).collect()}
    assert r[1].labels == "cc-by,cc-by-nc-4.0,gpl,lgpl-2.1" and r[1].base_labels == "cc-by,gpl" and 0 < r[1].score <= 1
    assert (r[2].labels, r[2].score, r[2].first_word) == ("", 0.0, None)
    assert len(licenses.rules()) > 300


def test_license_base_facts(spark):
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    odd = ["CC-BY cc by, cc  by", "all rights\nreserved", "x" * 50 + " cc byte", "General Public License general public license", "École cc by é", "cc", "...", "", None]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(-1 - k, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.license_scan(docs).collect()}
    for r in docs.collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate(lower))
        at = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        places = [i for i, _ in at]
        assert got[r.doc_id] == (len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))), r.text[:200]


def test_tokens_equal_the_tokenizer():
    encode = packing.TokenBytes(packing.tokenizer_path(), cache=50)
    for c in range(0x250):
        for t in (f"a{chr(c)}b", f"X {chr(c)}{chr(c)} 1{chr(c)}2 '{chr(c)}s", chr(c)):
            assert encode(t) == encode.slow(t), hex(c)
    for t in ("", "don't we'll I'M", "<|endoftext|> x", "ΑΣ Σ", "कमल", "á", "x" * 5000):
        assert encode(t) == encode.slow(t)


def test_pieces_and_packing(spark):
    docs = spark.createDataFrame([(k, "word " * n) for k, n in enumerate([0, 1, 4094, 4095, 4096, 9000, 300, 700])], "doc_id long, text string")
    rows = packing.pack_documents(docs).collect()
    encode = packing.TokenBytes(packing.tokenizer_path())
    for d in docs.collect():
        ids = np.frombuffer(encode.slow(d.text) + b"\1\0\0\0", "<u4")
        mine = sorted((r for r in rows if r.doc_id == d.doc_id), key=lambda r: r.piece)
        assert [r.start for r in mine] == list(range(0, len(ids), 4096))
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in mine) and sum(r.length for r in mine) == len(ids)
    for s in {r.sequence_id for r in rows}:
        own = sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and sum(r.length for r in own) <= 4096


def test_best_two_fit():
    rng = np.random.default_rng(3)
    for high in (30, 60, 100):
        lengths = rng.integers(1, high + 1, 400)
        bins, offsets = packing.best_two_fit(lengths, 100)
        fill = np.bincount(bins, weights=lengths)
        assert fill.max() <= 100 and (fill > 0).all() and len(fill) <= math.ceil(lengths.sum() / 100 * 1.12)
    # the greedy 6 + 3 leaves a gap of 1; the smallest gives way to two that fill the bin
    bins, _ = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert bins[0] == bins[2] == bins[3] != bins[1]


def test_budget_is_met():
    rng = random.Random(5)
    for _ in range(200):
        sizes = np.array(sorted(rng.sample(range(1, 40), rng.randint(1, 5))))
        counts = np.array([rng.randint(1, 3) for _ in sizes])
        budget = rng.randint(0, int((sizes * counts).sum()))
        take = mixing.fit_budget(sizes, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        share = np.array([int(c) * budget // int((sizes * counts).sum()) for c in counts]) if budget else 0 * counts
        best = min(abs(budget - int((np.array(t) * sizes).sum())) for t in itertools.product(*(range(int(a), int(b) + 1) for a, b in zip(share, counts))))
        assert abs(budget - int((take * sizes).sum())) == best


def test_targets(spark):
    totals = spark.createDataFrame([(None, 0), ("c", 100), ("a", 100), ("b", 100)], "source string, words long")
    got = {r.source: (r.weight, r.target) for r in mixing.with_targets(totals).collect()}
    assert got == {"a": (5.0, 200.0), "b": (2.0, pytest.approx(250 * 2 / 3)), "c": (1.0, pytest.approx(250 / 3)), None: (5.0, 0.0)}


def test_budget_above_the_first_words():
    rng = np.random.default_rng(8)
    for _ in range(60):
        sizes = np.sort(rng.choice(np.arange(1, 40) * int(rng.integers(1, 4)), 6, replace=False))
        counts = rng.integers(1, 30, 6)
        budget = int(rng.integers(1, (sizes * counts).sum()))
        # a bound far below the remainder gives sums as near as the whole dynamic program does
        near, whole = (abs(budget - int((mixing.fit_budget(sizes, counts, budget, first) * sizes).sum())) for first in (4, 1 << 18))
        assert near == whole


def test_mix_is_stable_and_near_target(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = (sorted(map(tuple, mixing.mix(docs.repartition(k)).collect()), key=repr) for k in (2, 5))
    assert a == b
    for src in {r[1] for r in a}:
        own = [r for r in a if r[1] == src]
        assert abs(sum(r[2] * r[5] for r in own) - own[0][4]) <= max(r[2] for r in own) and all(r[5] <= 2 for r in own)


def brute_components(fps, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(zip(ids, fps), 2):
        if (x ^ y).bit_count() <= 2:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_simhash_components(spark):
    rng = random.Random(2)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(300):  # chains and clusters
        x = rng.choice(fps)
        for _ in range(rng.randint(0, 2)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    prints = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "doc_id long, fp long")
    facts = {r.fp: r.component_id for r in simhash.near_groups(prints).collect()}
    want = brute_components(fps, list(range(len(fps))))
    assert all(facts[s] == want[i] for i, s in enumerate(signed))


def test_simhash_fingerprint():
    import xxhash

    words = "The quick brown fox jumps over the lazy dog".split()
    grams = [" ".join(words[i : i + 3]).lower() for i in range(len(words) - 2)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    assert simhash.fingerprint(simhash.shingle_hashes(" ".join(words))) == sum((sum(h >> b & 1 for h in hs) * 2 > len(hs)) << b for b in range(64))


def test_kneser_ney_sums_to_one():
    m = langid.KneserNey.merge({"x": langid.language_levels(["banana bandana anna"])})
    for context in ("ana", "ban", "zzz"):
        total = sum(2 ** float(m.log2_probs(np.array([ord(c) for c in context + ch], np.uint32))[0, 0]) for ch in "abdn ")
        unknown = 2 ** float(m.log2_probs(np.array([ord(c) for c in context + "q"], np.uint32))[0, 0])
        assert total + unknown == pytest.approx(1, abs=1e-5)


def test_language_held_out(spark):
    rows = langid.op8_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.95 * len(rows)


def test_long_texts_score_alike_in_blocks(monkeypatch):
    m = langid.KneserNey.merge({"x": langid.language_levels(["ababab baba"] * 3), "y": langid.language_levels(["aaaaa"] * 5)})
    texts = ["abab baba " * 200, None, "", "a"]
    whole = m.entropies(texts)[0]
    monkeypatch.setattr(langid, "BLOCK", 64)
    assert np.allclose(m.entropies(texts)[0], whole, atol=1e-5)


def test_maximal_segments():
    rng = random.Random(4)
    for _ in range(200):
        places = sorted(rng.sample(range(30), rng.randint(0, 8)))
        scores = [rng.choice([2.0, 1.0, -1.5]) for _ in places]
        line = [-0.25] * 30
        for p, s in zip(places, scores):
            line[p] = s
        found = toxicity.maximal_segments(line)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in toxicity.segments(np.array(line))]
        best = max((sum(line[a : b + 1]) for a in range(30) for b in range(a, 30)), default=0)
        if best > 0:
            assert max(s for *_, s in found) == pytest.approx(best)
        assert all(s == pytest.approx(sum(line[a : b + 1])) for a, b, s in found)
        assert all(x[1] < y[0] for x, y in zip(found, found[1:]))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = toxicity.op7_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean) and sum(r.predicted for r in toxic) >= 0.6 * len(toxic)


def test_warc_rejects_magic_in_payloads(spark):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nX-Page-Id: 999\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(1, "u", "plain é"), (2, "u", "a " + fake + " b"), (3, None, None), (4, "a\r\nX-Page-Id: 5", "x" * 150), (5, "u", "x" * 150), (6, "u", "WARC/1.0\r\n"), (7, "u", fake * 3)]
    rows += [(20 + i, "v", f"p{i} é" * i + (fake if i % 3 == 0 else "")) for i in range(12)]
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    try:
        got = {r.page_id: r for r in warc.page_records(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == len(rows)
    for k, _, html in rows:
        body = (html or "").encode()
        assert (got[k].payload_bytes, got[k].payload_digest, got[k].intact) == (len(body), hashlib.sha256(body).hexdigest(), True)
    assert (got[5].record_type, got[5].refers_to, got[4].record_type) == ("revisit", 4, "response")


def test_forward_is_exact_and_training_helps():
    rng = np.random.default_rng(0)
    m = hmm.Hmm.initial(np.array([5.0, 3, 2, 1]), states=3)
    seqs = [rng.integers(0, 4, n).astype(np.int32) for n in (1, 3, 5)]
    for s, got in zip(seqs, m.log10_likelihoods(seqs)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for a, b, o in zip(path, path[1:], s[1:]):
                p *= m.move[a, b] * m.emit[o, b]
            total += p
        assert got == pytest.approx(math.log10(total), abs=1e-9)
    seqs = [np.tile([0, 1, 2, 3], 30).astype(np.int32) for _ in range(4)]
    before = m.log10_likelihoods(seqs).sum()
    for _ in range(5):
        totals = [np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))]
        m.expected(seqs, totals)
        assert totals[2].sum() == pytest.approx(480, rel=1e-4)
        m = hmm.Hmm.from_counts(*totals)
    assert m.log10_likelihoods(seqs).sum() > before


def test_lm_base_scores(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "B c"), (3, "zzz a"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in hmm.lm_scores(docs, F.col("doc_id") < 3, rounds=2).collect()}
    c = {"a": 2, "b": 2, "c": 1, None: 2}
    n, v = 7, 4
    for k, t in ((1, ["a", "b", "a", None]), (3, ["zzz", "a", None]), (4, [None])):
        assert got[k].base_score == pytest.approx(sum(math.log10((c.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in t))
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (len(t), sum(w in c for w in t), n)
        assert got[k].score < 0
