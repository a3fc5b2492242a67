"""Scoring a stream with a fitted model. A transform keeps no state between rows, so the batch
model serves unchanged."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessel.sources.sinks import score


def score_stream(model: PipelineModel, stream: DataFrame, key: list[str] | str, path: str,
                 checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Append ``(key, prediction)`` as Parquet.

    Progress is kept beside the output, so a restart on the same output goes on where the last run ended.
    """
    where = checkpoint or path.rstrip("/") + ".progress"
    writer = (score(model, stream, key).writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", where))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
