"""What has been done: the table that decides which documents and steps have to run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STEPS = ("language", "analysis", "classification", "review", "tree")


def pending_steps(inputs: DataFrame, done: DataFrame) -> DataFrame:
    """(file, step) that have to run: ``inputs`` has file, signature, profile; ``done`` file, step, signature, profile.

    A step is done where its signature is the input's and its profile unchanged (the language step makes the profile and
    ignores it). The first pending step makes all later ones pending, except that the language step alone doesn't.
    """
    steps = inputs.select("file", "signature", "profile", F.posexplode(F.array(*map(F.lit, STEPS))).alias("n", "step"))
    known = done.select("file", "step", "signature", F.col("profile").alias("_profile")).withColumn("_done", F.lit(True)).dropDuplicates(["file", "step", "signature"])
    joined = steps.join(known, ["file", "step", "signature"], "left")
    finished = F.coalesce(F.col("_done") & ((F.col("step") == "language") | F.col("_profile").eqNullSafe(F.col("profile"))), F.lit(False))
    first = F.min(F.when(~finished & (F.col("step") != "language"), F.col("n"))).over(Window.partitionBy("file"))
    return joined.withColumn("_first", first).where(~finished | ((F.col("step") != "language") & (F.col("n") >= F.coalesce("_first", F.lit(99))))).select("file", "step")


def content_signatures(blocks: DataFrame) -> DataFrame:
    """file, signature and blocks of delivered blocks (file, block_id, testo).

    The signature combines a hash of each block by exclusive or, so order doesn't matter, parts are combined before the
    shuffle, and no task holds a file; a block delivered twice counts once.
    """
    once = blocks.select("file", "block_id", "testo").distinct()
    own = F.conv(F.substring(F.md5(F.concat(F.col("block_id").cast("string"), F.lit(":"), F.coalesce("testo", F.lit(""))).cast("binary")), 1, 15), 16, 10).cast("bigint")
    return once.groupBy("file").agg(F.bit_xor(own).alias("signature"), F.count(F.lit(1)).alias("blocks"))


def finished_steps(inputs: DataFrame, records: DataFrame, trees: DataFrame) -> DataFrame:
    """What the tables at hand prove as done: (file, step, signature, profile) for ``pending_steps``.

    A named language proves the first step; records of a file prove that it was analysed and classified, without any
    that wait also the review; a tree proves the last step.
    """
    base = inputs.select("file", "signature", "profile")
    named = base.where("profile <> ''").withColumn("step", F.lit("language"))
    states = records.groupBy("file").agg(F.count_if(F.col("review_status") == "pending_llm_review").alias("waiting"))
    known = base.join(states, "file")
    steps = known.select("file", "signature", "profile", F.explode(F.array_compact(F.array(F.lit("analysis"), F.lit("classification"), F.when(F.col("waiting") == 0, "review")))).alias("step"))
    built = base.join(trees.select("file").distinct(), "file", "left_semi").withColumn("step", F.lit("tree"))
    out = None
    for part in (named, steps, built):
        one = part.select("file", "step", "signature", "profile")
        out = one if out is None else out.unionByName(one)
    return out
