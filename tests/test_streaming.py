from linkloom.operators import tokens
from linkloom.plans.records import records_view
from linkloom.streaming.incremental import match_batch, start_matching

SF = "/root/testdata/sf0.001"


def test_stream_gives_the_batch_result(spark, tmp_path):
    records = records_view(spark, SF)
    t = tokens.typed_tokens(records)
    index = tokens.weighted_postings(t, tokens.token_weights(t)).where("src = 1")
    index.write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    new = records.where("src <> 1").repartition(3)
    new.write.parquet(str(tmp_path / "new"))
    want = {(r.i, r.j, r.bs) for r in match_batch(spark.read.parquet(str(tmp_path / "new")), index).collect()}
    stream = spark.readStream.schema(new.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "new"))
    out = str(tmp_path / "out")
    q = start_matching(stream, index, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    got = {(r.i, r.j, r.bs) for r in spark.read.parquet(out).collect()}
    assert got == want and want
