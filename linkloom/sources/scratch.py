"""Tables written between stages, in the shared folder that spark.checkpoint.dir names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def materialised(df: DataFrame, tag: str) -> DataFrame:
    """Write df and read it back, so that what follows doesn't compute it anew; a temporary folder where no shared one is set."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"file://{tempfile.mkdtemp(prefix='linkloom-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/linkloom-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
