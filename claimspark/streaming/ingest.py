"""Incremental ingestion: files that arrive in a folder become chunks, each content once.

An extension: sources are finite files, but a folder that grows is read as a
stream, so unchanged content is never converted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimspark.operators.chunking import chunk_documents
from claimspark.sources.readers import convert_files, extension_of, route
from claimspark.functions.text import slug_udf

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(spark: SparkSession, folder: str) -> DataFrame:
    raw = spark.readStream.format("binaryFile").schema(_FILES).load(folder)
    title = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    rows = raw.select("path", title.alias("title"), extension_of("path").alias("extension"), route("path").alias("r"), F.sha2("content", 256).alias("content_sha256"), "modificationTime", "content")
    return (
        rows.select("path", "title", F.concat_ws("-", slug_udf("title"), F.substring("content_sha256", 1, 12)).alias("source_id"), "extension", "r.backend", "content_sha256", "modificationTime", "content")
        .withWatermark("modificationTime", "30 days")
        .dropDuplicatesWithinWatermark(["content_sha256"])
    )


def ingest_stream(spark: SparkSession, folder: str, out: str, state: str) -> StreamingQuery:
    """Append the chunks of new files to parquet; a batch that is run again overwrites its own part."""

    def write(batch: DataFrame, number: int) -> None:
        docs = convert_files(batch.drop("modificationTime")).where("markdown is not null")
        keyed = docs.withColumn("conversion_id", F.col("source_id"))
        chunk_documents(keyed).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arriving_files(spark, folder).writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
