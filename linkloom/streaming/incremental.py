"""Incremental matching: new records of sources 2 and 3 as a stream against the index of source 1."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.blocking import candidate_pairs
from ..operators.tokens import typed_tokens


def match_batch(new: DataFrame, index: DataFrame) -> DataFrame:
    """Scored candidate pairs of a batch of records against weighted postings of source 1 (with w and df)."""
    tokens = typed_tokens(new).join(index.select("country_n", "typ", "token", "w", "df").distinct(), ["country_n", "typ", "token"])
    return candidate_pairs(index.select("idx", "src", "country_n", "typ", "token", "w", "df").unionByName(tokens.select("idx", "src", "country_n", "typ", "token", "w", "df")))


def start_matching(stream: DataFrame, index: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs match_batch on every micro-batch; sink gets (pairs, batch id) and must be idempotent by batch id."""

    def each(batch: DataFrame, batch_id: int) -> None:
        sink(match_batch(batch, index).withColumn("batch", F.lit(batch_id)), batch_id)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()
