"""Documents that arrive in a folder: each micro-batch runs the batch operators on its files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexstrata.operators.structure import labelled
from lexstrata.sources.blocks import DOCUMENT, blocks_of


def watch_documents(spark: SparkSession, path: str, per_batch: int = 1000) -> DataFrame:
    """A stream of (file, value) of the JSON documents that appear in ``path``."""
    return spark.readStream.option("maxFilesPerTrigger", per_batch).option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("file"), "value")


def label_stream(documents: DataFrame, out: str, checkpoint: str, profile: str = "it") -> StreamingQuery:
    """Labels the blocks of each document and appends them to ``out``; a document is whole in its batch."""
    inner = DOCUMENT.removeprefix("blocks ")

    def batch(df: DataFrame, number: int) -> None:
        listed = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", inner)).otherwise(F.from_json("value", DOCUMENT)["blocks"])
        rows = blocks_of(df.select("file", listed.alias("blocks"))).withColumn("profile", F.lit(profile))
        labelled(rows).select("file", "ordine", "testo", "label", "number", F.lit(number).alias("batch")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return documents.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
