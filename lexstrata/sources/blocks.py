"""Reading scanned blocks: from JSON documents and from the delivered table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexstrata.functions.profiles import profile_of
from lexstrata.functions.runtime import read_table

#: One block of an input document; every field may be missing.
BLOCK = "text string, content string, testo string, page_index int, page int, page_reading_index int, page_order int, block_type string, block_type_canonical string, document_zone string, zone string, bbox array<double>, bbox_inherited boolean, ocr_score double, confidenza double, selected_from string, source_model string, source_order int, page_agreement_score double, recovered_extra_candidate boolean"
#: Input documents: an object with blocks, or the list of blocks itself (read with the second schema).
DOCUMENT = f"blocks array<struct<{', '.join(p.replace(' ', ':', 1) for p in BLOCK.split(', '))}>>"


def _first_text(*columns: Column) -> Column:
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in columns))


def blocks_of(documents: DataFrame) -> DataFrame:
    """Blocks of ``documents`` (file, blocks): aliases resolved, defaults set, empty texts dropped.

    ``ordine`` is the place in the document before anything is dropped. A null field falls back like a missing one.
    """
    b = documents.select("file", F.posexplode("blocks").alias("ordine", "b"))
    rows = b.select(
        "file",
        "ordine",
        F.coalesce("b.page", "b.page_index").alias("page"),
        F.coalesce("b.page_order", "b.page_reading_index", "ordine").alias("page_order"),
        F.col("b.block_type").alias("block_type"),
        F.coalesce("b.block_type_canonical", "b.block_type").alias("block_type_canonical"),
        F.coalesce("b.document_zone", "b.zone").alias("document_zone"),
        F.col("b.bbox").alias("bbox"),
        F.coalesce("b.bbox_inherited", F.lit(False)).alias("bbox_inherited"),
        F.coalesce("b.ocr_score", "b.confidenza").alias("ocr_score"),
        F.coalesce("b.recovered_extra_candidate", F.lit(False)).alias("recovered_extra_candidate"),
        F.col("b.selected_from").alias("selected_from"),
        F.col("b.source_model").alias("source_model"),
        F.coalesce("b.source_order", "ordine").alias("source_order"),
        F.col("b.page_agreement_score").alias("page_agreement_score"),
        _first_text(F.col("b.text"), F.col("b.content"), F.col("b.testo")).alias("testo"),
    )
    return rows.where(F.col("testo").isNotNull())


def documents_at(spark: SparkSession, path: str, glob: str = "*.json") -> list[str]:
    """Paths of the documents of a file or folder, sorted; an error that says where nothing was found.

    Only names are listed, by Spark's own file listing, so any file system it knows will do.
    """
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(place):
        raise FileNotFoundError(f"there is no {path}")
    found = [path] if system.getFileStatus(place).isFile() else sorted(str(f.getPath().toString()) for f in system.globStatus(jvm.org.apache.hadoop.fs.Path(place, glob)) if f.isFile())
    if not found:
        raise FileNotFoundError(f"{path} has no documents {glob}")
    return found


def invalid_documents(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """file and bytes of the documents that aren't JSON, empty ones included; ``read_documents`` leaves them out."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=glob).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"), "value")
    return raw.where(F.try_parse_json("value").isNull()).select("file", "bytes")


def read_documents(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Blocks of the JSON documents in a file or directory; both document shapes are read, invalid files give no rows."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=glob).select(F.col("_metadata.file_name").alias("file"), "value")
    inner = DOCUMENT.removeprefix("blocks ")
    listed = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", inner)).otherwise(F.from_json("value", DOCUMENT)["blocks"])
    return blocks_of(raw.select("file", listed.alias("blocks")))


def delivered_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table ocr_blocks without second deliveries, with the profile of each file.

    Equal rows differ in ``ingested_at``; the first delivery stays.
    """
    blocks = read_table(spark, sf_dir, "ocr_blocks")
    once = blocks.withColumn("_n", F.row_number().over(Window.partitionBy("block_id").orderBy("ingested_at"))).where("_n = 1").drop("_n")
    labels = read_table(spark, sf_dir, "language_config").select("file", profile_of(F.col("code")).alias("profile"))
    return once.join(labels, "file", "left").withColumn("profile", F.coalesce("profile", F.lit("it")))


def count_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks, pages and characters of each file."""
    return blocks.groupBy("file").agg(F.count(F.lit(1)).alias("blocks"), F.count_distinct("page").alias("pages"), F.sum(F.length("testo")).alias("chars"))
