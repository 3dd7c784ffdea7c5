"""Apply a fitted model to a Structured Streaming table.

The transform of most models is a projection, so it needs no state and no
watermark.  A model that runs jobs of its own (a neighbour search) is applied to
each micro-batch as a table.  Either way each row gives what the batch transform
would give; for a model that is not row-local the batch is the micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def is_row_local(model) -> bool:
    """Whether a model, or every stage of a pipeline model, is one projection."""
    return all(map(is_row_local, getattr(model, "stages", []))) and getattr(model, "row_local", True)


def write_transformed(model, stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start a query that appends transformed rows to parquet files under ``path``.

    The file sink and the checkpoint make each row appear once across restarts.
    Models that are not row-local write a folder ``batch=<id>`` per micro-batch,
    which a restart replaces.
    """
    if is_row_local(model):
        writer = model.transform(stream).writeStream.format("parquet").outputMode("append").option("path", path)
    else:
        write = lambda batch, number: model.transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")
        writer = stream.writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
