"""Tile batches that arrive in a folder are scored as they come, each once, and the stream ends when none is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import scoring


def score_arrivals(spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str) -> StreamingQuery:
    """Plane files of ``source`` to scored plane yields in ``sink``; the checkpoint remembers what is done."""
    arriving: DataFrame = spark.readStream.schema(schema).parquet(source)
    scored = scoring.plane_yields(scoring.usable_planes(arriving))
    return scored.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(sink)
