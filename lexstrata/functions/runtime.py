"""Session-level helpers shared by all operators."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``read_table`` for work that is heavy on CPU: a table with fewer splits than cores is dealt to all of them.

    Larger tables have more splits than cores and are read as they are, without a shuffle.
    """
    df = read_table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: the cluster's ``spark.checkpoint.dir``.

    Only where that is unset and driver and executors are one process (master ``local``) a temporary folder takes its
    place; on a cluster it has to be set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    return os.path.join(tempfile.gettempdir(), f"lexstrata-checkpoints-{os.getpid()}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder; columnar, so later reads can prune columns."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once for each application, so that their Python finds it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="lexstrata-"), "lexstrata_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted([*root.rglob("*.py"), *root.rglob("*.json")]):
            z.write(f, str(Path(root.name) / f.relative_to(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
