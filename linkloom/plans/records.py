"""Records view: business-style records made from the documents table, so that every operator has real input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a text that a record has.
WORDS = 14
VIEW = ["idx", "entity_id", "src", "country_n", "name_core", "addr_core"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """idx, entity_id, src (1 to 3), country_n, name_core (words 1-4), addr_core (a house number and words 5-14)."""
    docs = table(spark, sf_dir, "documents")
    # only the stretch that holds the words in use is split
    head = F.regexp_extract(F.lower("text"), f"^(?:[^a-z0-9]*+[a-z0-9]++){{0,{WORDS}}}+", 0)
    words = F.filter(F.split(F.regexp_replace(head, "[^a-z0-9]+", " "), " "), lambda w: w != "")
    src = (F.pmod("doc_id", F.lit(3)) + 1).cast("int")
    named = docs.select(F.col("doc_id").alias("idx"), src.alias("src"), F.col("lang").alias("country_n"), words.alias("w"))
    number = (F.pmod("idx", F.lit(97)) + 1).cast("string")
    return named.select(
        "idx",
        F.concat(F.lit("S"), F.col("src").cast("string"), F.lit("-"), F.col("idx").cast("string")).alias("entity_id"),
        "src",
        "country_n",
        F.array_join(F.slice("w", 1, 4), " ").alias("name_core"),
        F.array_join(F.concat(F.array(number), F.slice("w", 5, 10)), " ").alias("addr_core"),
    )


def truth_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(i, j): a record of source 1 and one of source 2 or 3 with the same language and first 60 characters."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.substring("text", 1, 60).alias("head"))
    one = docs.where(F.pmod("doc_id", F.lit(3)) == 0).select(F.col("doc_id").alias("i"), "lang", "head")
    other = docs.where(F.pmod("doc_id", F.lit(3)) != 0).select(F.col("doc_id").alias("j"), "lang", "head")
    return one.join(other, ["lang", "head"]).select("i", "j")


def truth_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, head_id) of records with a language and a text: truth_view() pairs a source-1 record with the others of its head_id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.substring("text", 1, 60).alias("head"))
    heads = docs.groupBy("lang", "head").agg(F.min("doc_id").alias("head_id"))
    return docs.join(heads, ["lang", "head"]).select("doc_id", "head_id")


RECORDS_SQL = """records AS (
  SELECT idx, 'S' || src || '-' || idx AS entity_id, src, country_n, array_to_string(w[1:4], ' ') AS name_core,
         array_to_string(list_concat([CAST(idx % 97 + 1 AS VARCHAR)], w[5:14]), ' ') AS addr_core
  FROM (SELECT doc_id AS idx, CAST(1 + doc_id % 3 AS INTEGER) AS src, lang AS country_n,
               list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents))"""

TRUTH_SQL = """truth AS (
  SELECT a.doc_id AS i, b.doc_id AS j FROM documents a JOIN documents b
  ON a.lang = b.lang AND substr(a.text, 1, 60) = substr(b.text, 1, 60) AND a.doc_id % 3 = 0 AND b.doc_id % 3 <> 0)"""
