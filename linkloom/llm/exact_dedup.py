"""Exact dedup by skew-safe combining, in DataFrame functions only.

Three combining stages, each of which compares the full content and not only its digest:

1. local      - map-side partial aggregation inside every input partition;
2. salted     - the same groups merged by (digest, salt, content), the salt spreading a hot digest;
3. global     - the salt winners merged by (digest, content); at most ``salts`` rows a text arrive here.

Group facts then go back to the members by digest. Keys with a large share of all rows are joined by a
bounded broadcast, and digests that two different texts share are told apart by their content.

Defined results: null text counts as empty; a null doc_id loses against any other; rows that repeat a
doc_id inside a group share its verdict in ``exact_groups`` while ``keep_one_per_text`` returns one row a
text whatever the ids; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, attach_facts, documents, shuffle_partitions, stored

SALTS = 64


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _salt(doc_id: Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(salts)).cast("int")


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest`` only routes rows; two texts with one digest stay apart, as the content itself is compared.
    """
    spark = docs.sparkSession
    total = docs.count()
    base = docs.select("doc_id", ascii_lower(F.coalesce("text", F.lit(""))).alias("content"))
    base = base.withColumn("digest", digest(F.col("content")))
    salted = (
        base.groupBy("digest", _salt(F.col("doc_id"), salts).alias("salt"), "content")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    merged = (
        salted.repartition(shuffle_partitions(spark), "digest")
        .groupBy("digest", "content")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )
    # partitioned by digest already: neither aggregation moves rows again
    by_digest = merged.groupBy("digest").agg(
        F.count(F.lit(1)).alias("classes"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    by_digest = stored(by_digest, "exact-groups")
    narrow = base.select("doc_id", "digest", F.lit(None).cast("string").alias("content"))
    facts = by_digest.withColumn("rows", F.col("group_size"))
    if by_digest.where("classes > 1").isEmpty():
        out = attach_facts(narrow, facts, "digest", "rows", total, ["keep_id", "group_size"])
    else:
        clash = by_digest.where("classes > 1").select("digest")
        clear = narrow.join(clash, "digest", "left_anti").select("doc_id", "digest", "content")
        mixed = base.join(clash, "digest", "left_semi").withColumn("class", F.struct("digest", "content"))
        classes = merged.join(clash, "digest", "left_semi").withColumn("class", F.struct("digest", "content"))
        told = mixed.select("doc_id", F.col("class.digest").alias("digest"), F.col("class.content").alias("content")).join(
            classes.select("digest", "content", "keep_id", "group_size"), ["digest", "content"]
        )
        out = attach_facts(clear, facts.where("classes = 1"), "digest", "rows", total, ["keep_id", "group_size"])
        out = out.unionByName(told.select("doc_id", "digest", F.lit(None).cast("string").alias("content"), "keep_id", "group_size"))
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one_per_text(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of docs that stay, with their own columns: of equal texts the one with the largest doc_id.

    The winner's row travels through the combining stages itself, so no join follows and each text is
    shuffled twice. The local and salted stages compare the text as it stands (finer than the normal
    form), the global stage its normal form.
    """
    spark = docs.sparkSession
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    base = docs.select(F.struct(*rest).alias("rest"), "doc_id", "text")
    base = base.withColumn("digest", F.unhex(sha256(ascii_lower(F.coalesce("text", F.lit(""))))))
    best = F.max_by(F.struct("rest", "doc_id"), F.struct("doc_id")).alias("best")
    salted = base.groupBy("digest", _salt(F.col("doc_id"), salts).alias("salt"), "text").agg(best)
    winners = (
        salted.repartition(shuffle_partitions(spark), "digest")
        .select("digest", ascii_lower(F.coalesce("text", F.lit(""))).alias("content"), "text", "best")
        .groupBy("digest", "content")
        .agg(F.max_by(F.struct("best.rest", "text"), F.struct("best.doc_id")).alias("best"))
    )
    return winners.select(*[(F.col("best.text") if c == "text" else F.col(f"best.rest.`{c}`")).alias(c) for c in docs.columns])


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


QUERIES = {"op1_exact_dedup": op1_exact_dedup}

ORACLE = {
    "op1_exact_dedup": """
WITH base AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS content
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM base WINDOW w AS (PARTITION BY content)
"""
}
