"""Checks of a result file: structure by its text, content by joins. Every check yields (rule, n, examples)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXAMPLES = 5
HEADERS = {"matching": "source1_entity_id\tmatched_entity_ids", "candidates": "source1_entity_id\tcandidate_entity_ids"}


def structural_errors(spark: SparkSession, path: str, kind: str) -> list[str]:
    """Errors of the file as text: missing, empty, wrong separator, wrong header, rows without a tab."""
    try:
        lines = spark.read.text(path)
        first = lines.first()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return ["missing"]
        raise
    if first is None:
        return ["empty"]
    header = HEADERS[kind]
    if "\t" not in first.value:
        return ["comma instead of tab" if "," in first.value else "no tab in header"]
    errors = [] if first.value == header else ["wrong header"]
    bad = lines.where(~F.contains("value", F.lit("\t"))).count()
    return errors + ([f"{bad} rows without a tab"] if bad else [])


def content_errors(lists: DataFrame, records: DataFrame, check_ids: bool = True) -> DataFrame:
    """(rule, n): how many findings each of the seven content rules has; lists: source1_entity_id, ids."""
    ids = F.filter(F.split("ids", ","), lambda x: x != "")
    rows = lists.select("source1_entity_id", ids.alias("l"))
    each = rows.select("source1_entity_id", F.explode("l").alias("id"))
    ones = records.where("src = 1").select(F.col("entity_id").alias("source1_entity_id"))
    others = records.where("src <> 1").select(F.col("entity_id").alias("id"))
    rules = {
        "duplicate source-1 row": rows.groupBy("source1_entity_id").count().where("count > 1"),
        "repeated id in a list": rows.where(F.size("l") > F.size(F.array_distinct("l"))),
        "source-1 id in a list": each.where(F.col("id").startswith("S1-")),
        "unknown prefix": each.where(~F.col("id").rlike("^S[123]-")),
        "source-1 entity missing": ones.join(rows, "source1_entity_id", "left_anti"),
        "unknown source-1 entity": rows.join(ones, "source1_entity_id", "left_anti"),
    }
    if check_ids:
        rules["unknown id"] = each.where(F.col("id").rlike("^S[23]-")).join(others, "id", "left_anti")
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n") for rule, df in rules.items()]
    return reduce(DataFrame.union, counted)
