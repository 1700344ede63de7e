"""Shared pieces of the training-data operators: text normal forms, scratch tables and skew-safe joins.

Working columns never meet the caller's columns: operators either select the few columns they
need or keep the whole input row in one struct, so extra columns of any name are harmless.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: A key counts as hot when it holds at least this share of all rows, so that at most
#: HOT_SHARE keys can be hot: that is the proven bound of what attach_facts() broadcasts.
HOT_SHARE = 1000
#: Marks of may_hold(), and how many of them Spark's bitmaps have.
MARKS, MARKS_A_ROW = 1 << 23, 1 << 15


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder named by spark.checkpoint.dir; a temporary folder where that is unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"file://{tempfile.mkdtemp(prefix='linkloom-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/linkloom-{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach_facts(members: DataFrame, facts: DataFrame, key: str, n: str, total: int, values: list[str]) -> DataFrame:
    """Left-join one row of facts a key onto members, however many members a key has.

    ``facts`` has one row for each non-null ``key`` and in ``n`` its number of members out of ``total``.
    Keys holding at least 1/HOT_SHARE of all members (so at most HOT_SHARE keys) are joined by broadcast;
    their members then go to the shuffled join under a scattered key that matches nothing there.
    """
    hot = F.col(n) * HOT_SHARE >= F.lit(total)
    hot_facts = facts.where(hot).select(F.col(key).alias("__hot_key"), F.struct(*values).alias("__hot"))
    cold_facts = facts.where(~hot).select(F.col(key).alias("__cold_key"), F.struct(*values).alias("__cold"))
    scattered = F.xxhash64(F.monotonically_increasing_id()).cast(members.schema[key].dataType)
    probe = members.join(F.broadcast(hot_facts), F.col(key) == F.col("__hot_key"), "left")
    probe = probe.withColumn("__probe", F.when(F.col("__hot_key").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(scattered))
    probe = probe.withColumn("__real", F.col("__hot_key").isNull() & F.col(key).isNotNull())
    joined = probe.join(cold_facts, (F.col("__probe") == F.col("__cold_key")) & F.col("__real"), "left")
    return joined.select(*members.columns, *[F.coalesce(F.col(f"__hot.{v}"), F.col(f"__cold.{v}")).alias(v) for v in values])


def with_facts(members: DataFrame, facts: DataFrame, key: str, n: str, total: int, values: list[str]) -> DataFrame:
    """Inner join of one row of facts a key with members, however many members a key has; members without facts go.

    ``facts`` (stored) has in ``n`` the members of a key out of ``total``. Only members of keys with at least 1/HOT_SHARE of all
    (at most HOT_SHARE keys, told apart by value) meet a broadcast; all others meet their facts in a shuffled join.
    """
    hot = [r[0] for r in facts.where(F.col(n) * HOT_SHARE >= F.lit(total)).select(key).collect()]
    told = facts.select(key, *values)
    if not hot:
        return members.join(told, key).select(*members.columns, *values)
    is_hot = F.col(key).isin(hot)
    cold = members.where(~is_hot).join(told.where(~is_hot), key)
    return cold.select(*members.columns, *values).union(members.where(is_hot).join(F.broadcast(told.where(is_hot)), key).select(*members.columns, *values))


def may_hold(wanted: DataFrame, key: str) -> Column:
    """Whether the long column ``key`` may be among those of wanted: always where it is, seldom where it isn't. One megabyte of marks whatever the input."""
    place = F.pmod(F.xxhash64(key), F.lit(MARKS)) + 1
    rows = wanted.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    marks = np.zeros((MARKS // MARKS_A_ROW, MARKS_A_ROW // 8), np.uint8)
    for k, bits in rows.collect():
        marks[k - 1] = np.frombuffer(bits, np.uint8)
    marks = marks.ravel()

    @F.arrow_udf("boolean")
    def marked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for at in batches:
            at = at.to_numpy() - 1
            yield pa.array((marks[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return marked(place)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
