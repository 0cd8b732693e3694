"""First hop: appends a stream of documents to a table or to a folder of Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def _writer(
    stream: DataFrame, checkpoint: str, trigger: dict[str, object], file_format: str
) -> DataStreamWriter:
    return (
        stream.writeStream.format(file_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .trigger(**trigger)
    )


def append_stream_to_table(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    trigger: dict[str, object],
    file_format: str = "parquet",
    path: str | None = None,
) -> StreamingQuery:
    """Appends to ``table``, which is created if need be; ``path`` is where a new one is kept."""
    writer = _writer(stream, checkpoint, trigger, file_format)
    if path is not None:
        writer = writer.option("path", path)
    return writer.toTable(table)


def append_stream_to_folder(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict[str, object],
    file_format: str = "parquet",
) -> StreamingQuery:
    """Appends to the files of ``path``; Spark's file sink writes every micro-batch exactly once."""
    return _writer(stream, checkpoint, trigger, file_format).start(path)
