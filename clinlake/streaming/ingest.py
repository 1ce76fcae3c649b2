"""Bundle files as a stream: new files to bronze, new bronze rows to silver.

No query keeps state; the file checkpoint alone says what has been read. With
``availableNow`` a run takes what has arrived and ends, so it can be scheduled like a batch.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clinlake.operators.bronze import build_bronze
from clinlake.operators.silver import FLATTENERS, SILVER_TABLES
from clinlake.sources.contracts import BRONZE
from clinlake.sources.files import bundle_columns, bundle_reader
from clinlake.sources.manifest import land_bundles
from clinlake.sources.tables import upsert, upsert_buckets


def read_bundle_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    loaded_at: Column | None = None,
    glob: str | None = None,
) -> DataFrame:
    reader = bundle_reader(spark.readStream, glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return bundle_columns(reader.load(path), loaded_at)


def stream_bronze(
    spark: SparkSession,
    path: str,
    sink: str,
    checkpoint: str,
    max_files: int | None = None,
    loaded_at: Column | None = None,
) -> StreamingQuery:
    """Append the resources of new bundle files to the parquet folder ``sink``."""
    bronze = build_bronze(read_bundle_stream(spark, path, max_files, loaded_at))
    return (
        bronze.writeStream.format("parquet")
        .partitionBy("resource_type")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(sink)
    )


def stream_land(
    spark: SparkSession,
    path: str,
    raw: str,
    manifest_table: str,
    checkpoint: str,
    location: str | None = None,
    max_files: int | None = None,
    loaded_at: Column | None = None,
) -> StreamingQuery:
    """New bundle files to two sinks from one parse: resources to the raw table, every file to the manifest.

    A micro-batch that is run again finds its files in the manifest, or its interrupted start there and the resources
    in the raw table, and lands nothing twice.
    """
    bundles = read_bundle_stream(spark, path, max_files, loaded_at)

    def both(batch: DataFrame, _: int) -> None:
        land_bundles(batch, raw, manifest_table, location)

    return (
        bundles.writeStream.foreachBatch(both)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint folder. A new checkpoint in the same place is another stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def stream_upsert(
    spark: SparkSession,
    bronze_path: str,
    resource_type: str,
    table: str,
    checkpoint: str,
    location: str | None = None,
    max_files: int | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Upsert new bronze rows of one type into its silver table; with a number of buckets, into the touched ones only.

    The table notes the last batch of the stream together with the snapshot that holds it, so a batch that is run again after
    a failure writes nothing. In a table by buckets it replaces the same keys by the same rows.
    """
    _, key = SILVER_TABLES[resource_type]
    reader = spark.readStream.schema(BRONZE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    bronze = reader.parquet(bronze_path)

    def merge(batch: DataFrame, number: int) -> None:
        if buckets is None:
            upsert(batch, table, key, location=location, batch=(stream_id(spark, checkpoint), number))
        else:
            upsert_buckets(batch, table, key, buckets, location)

    return (
        FLATTENERS[resource_type](bronze)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
