"""Record tables in and result lists out."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
SOURCES, SPLITS = (1, 2, 3), ("train", "test")


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = RECORD, quoted: bool = False) -> DataFrame:
    """Tab-separated text with a header; all strings; a missing value is the empty string. Without quoting, quotes are letters."""
    reader = spark.read.schema(schema).option("sep", "\t").option("header", True)
    if not quoted:
        reader = reader.option("quote", "").option("escape", "")
    return reader.csv(path).na.fill("")


def write_tsv(df: DataFrame, path: str) -> None:
    """One text file with a header; nothing is quoted, nulls and empty strings are empty."""
    df.na.fill("").coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_partitioned(df: DataFrame, path: str, by: str = "country_n") -> None:
    """Partitioned by a column, so that later filters on it prune files."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, *keys: str) -> None:
    """A table whose joins on keys need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def convert(spark: SparkSession, tsv_dir: str, out_dir: str) -> list[str]:
    """All splits and sources, and the training truth, from TSV to Parquet; returns what was written."""
    made = []
    for split in SPLITS:
        for n in SOURCES:
            path = f"{out_dir}/{split}/s{n}.parquet"
            read_tsv(spark, f"{tsv_dir}/{split}_source{n}.tsv").write.mode("overwrite").parquet(path)
            made.append(path)
    path = f"{out_dir}/train/gt.parquet"
    read_tsv(spark, f"{tsv_dir}/train_ground_truth.tsv", TRUTH).write.mode("overwrite").parquet(path)
    return [*made, path]


def explode_truth(truth: DataFrame) -> DataFrame:
    """(source1_entity_id, entity_id): one row a true pair."""
    ids = F.transform(F.split("matched_entity_ids", ","), lambda x: F.trim(x))
    return truth.select("source1_entity_id", F.explode(F.filter(ids, lambda x: x != "")).alias("entity_id"))


def result_lists(pairs: DataFrame, records: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """One row for every source-1 record: its partners' ids, ascending, comma-joined; empty without any."""
    names = records.select("idx", "entity_id")
    told = pairs.select("i", "j").join(names.select(F.col("idx").alias("j"), F.col("entity_id").alias("je")), "j")
    lists = told.groupBy("i").agg(F.array_join(F.array_sort(F.collect_list("je")), ",").alias(column))
    ones = records.where("src = 1").select(F.col("idx").alias("i"), F.col("entity_id").alias("source1_entity_id"))
    return ones.join(lists, "i", "left").select("source1_entity_id", F.coalesce(column, F.lit("")).alias(column))


def save_json(spark: SparkSession, value, path: str) -> None:
    """A small driver-side value, as one line of text in any store Spark can write."""
    spark.createDataFrame([(json.dumps(value, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path).first().value)
