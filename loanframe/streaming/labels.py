"""Row-wise operators on a stream of loan rows.

Labels and business rules are stateless projections, so the batch functions
run on a streaming table as they are; there is no state and no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanframe.operators.labels import with_labels
from loanframe.sources.tables import LOAN_SCHEMA


def read_loan_stream(spark: SparkSession, folder: str, fmt: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(LOAN_SCHEMA).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(folder)


def write_labelled_stream(stream: DataFrame, folder: str, checkpoint: str):
    """Labels every arriving row and appends it to a table; returns the query."""
    return (
        with_labels(stream).writeStream.format("parquet").outputMode("append")
        .option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
