"""Every operator and stage on odd rows and on empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkloom.llm import exact_dedup, hmm, langid, licenses, mixing, packing, quality, simhash, toxicity, warc
from linkloom.llm.common import scratch_path


def labels(spark, column):
    return spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (5, 1), (8, 0)], f"doc_id long, {column} int")


def pages(docs):
    return docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"), "digest", "size", "n")


def warc_records(spark, docs):
    path = scratch_path(spark, "test")
    warc.write_archives(pages(docs), path, file_records=4)
    return warc.page_records(spark, path)


ROW_FOR_ROW = {
    "exact": lambda s, d: exact_dedup.exact_groups(d),
    "quality": lambda s, d: quality.quality_rules(d, labels(s, "quality")),
    "licenses": lambda s, d: licenses.license_scan(d),
    "warc": warc_records,
    "mixing": lambda s, d: mixing.mix(d),
    "toxicity": lambda s, d: toxicity.score_toxicity(d, toxicity.train_toxicity(d, labels(s, "toxic"))),
    "language": lambda s, d: langid.identify(d, langid.train_language_models(d)),
    "simhash": lambda s, d: simhash.near_components(d),
    "lm": lambda s, d: hmm.lm_scores(d, F.col("doc_id") % 2 == 0, rounds=1),
}


@pytest.mark.parametrize("name", ROW_FOR_ROW)
def test_odd_rows(spark, odd_docs, name):
    out = ROW_FOR_ROW[name](spark, odd_docs)
    assert len(out.collect()) == odd_docs.count()


@pytest.mark.parametrize("name", ROW_FOR_ROW)
def test_empty_table(spark, no_docs, name):
    assert ROW_FOR_ROW[name](spark, no_docs).collect() == []


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, odd_docs, no_docs, k):
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, odd_docs, "")
    if k < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == odd_docs.columns
    assert out.count() > 0
    assert stage(spark, no_docs, "").count() == 0


def test_defined_results(spark, odd_docs):
    kept = exact_dedup.keep_one_per_text(odd_docs)
    assert kept.count() == odd_docs.select(F.translate(F.coalesce("text", F.lit("")), exact_dedup.ascii_lower.__globals__["UPPER"], exact_dedup.ascii_lower.__globals__["LOWER"])).distinct().count()
    same = [r for r in exact_dedup.exact_groups(odd_docs).collect() if r.group_size == 4]
    assert len(same) == 4 and {r.keep_id for r in same} == {2} and sum(r.kept for r in same) == 2
    found = {r.doc_id: r for r in licenses.license_scan(odd_docs.where("doc_id = 8")).collect() if r.n_base}
    assert (found[8].n_base, found[8].first_word, found[8].last_word, found[8].base_labels) == (2, 6, 8, "cc-by")
    near = simhash.near_components(odd_docs).collect()
    assert {r.component_id for r in near if r.fingerprint == "0" * 16} == {3}
    scored = hmm.lm_scores(odd_docs, F.lit(True), rounds=1).where("n_tokens = 1").collect()
    assert len(scored) == 3 and len({(r.base_score, r.score) for r in scored}) == 1
