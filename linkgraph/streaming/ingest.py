"""Snapshots read as streams: each new file once, then the stream ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from linkgraph.sources import registers


def filings(spark: SparkSession, folder: str, retrieved_at: str = "") -> tuple[DataFrame, DataFrame]:
    """Streams of records and relationships of the filings in a folder's files."""
    rows = registers.filing_rows(spark.readStream.text(folder))
    return registers.filing_records(rows, retrieved_at), registers.filing_relationships(rows)


def append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what is new since the last call to the Parquet below path; a call that fails may be made again."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
