"""Running the steps over all documents: configuration, selection of steps, order of phases and what is done already."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexstrata.operators.manifest import STEPS, pending_steps

#: Other names of steps (fixed values).
ALIASES = {"f0": "language", "f1a": "analysis", "f1b": "classification", "f1c": "review", "f2": "tree"}
GROUPS = {"f1": ("analysis", "classification", "review"), "all": STEPS}
#: What runs a step's model; steps of one model stand together, so it is started once.
MODELS = {"language": "large", "analysis": "large", "classification": "small", "review": "large", "tree": None}
#: Stages of a step that need different models.
STAGES = {"analysis": (("analysis", "large"), ("embeddings", None))}


@dataclass(frozen=True)
class Config:
    """Settings of a run; each can be set by the environment as LEXSTRATA_ and its name in upper case."""

    accept_above: float = 0.90
    neighbours: int = 3
    review_batch: int = 8
    retries: int = 3
    least_chunk: int = 60
    most_chunk: int = 220
    overlap: int = 40
    first_blocks: int = 0
    review: bool = True
    reuse_verdicts: bool = False
    language: str = "it"
    profile_path: str = ""


def truth(text: str) -> bool:
    """Whether a setting says yes."""
    return text.strip().lower() in ("1", "true", "yes", "on", "si", "sì")


def load_config(env: Mapping[str, str] | None = None, **own: object) -> Config:
    """Settings: what is given here, else the environment, else the default; a value of the wrong type is an error that names it."""
    env = os.environ if env is None else env
    values: dict[str, object] = {}
    for f in fields(Config):
        name = f"LEXSTRATA_{f.name.upper()}"
        if f.name in own:
            values[f.name] = own[f.name]
        elif env.get(name, "") != "":
            kind = type(f.default)
            try:
                values[f.name] = truth(env[name]) if kind is bool else kind(env[name])
            except ValueError as error:
                raise ValueError(f"{name} must be {kind.__name__}, not {env[name]!r}") from error
    return Config(**values)


def step_names(names: Iterable[str]) -> list[str]:
    """Steps of some names, aliases and groups, once each, in their order; an unknown name is an error."""
    wanted: set[str] = set()
    for name in names:
        low = name.strip().lower()
        if low in GROUPS:
            wanted.update(GROUPS[low])
        elif (step := ALIASES.get(low, low)) in STEPS:
            wanted.add(step)
        else:
            raise ValueError(f"{name!r} is no step; steps are {', '.join(STEPS)}")
    return [s for s in STEPS if s in wanted]


def selected(only: Iterable[str] = (), first: str | None = None, skip: Iterable[str] = ()) -> list[str]:
    """The steps to run: ``only`` these (all if empty), from ``first`` on, without ``skip``."""
    steps = step_names(only) or list(STEPS)
    if first:
        steps = [s for s in steps if STEPS.index(s) >= STEPS.index(step_names([first])[0])]
    left_out = set(step_names(skip))
    return [s for s in steps if s not in left_out]


def phases(steps: Iterable[str]) -> list[tuple[str, str, str | None]]:
    """(step, stage, model) in the order of a run: every step over all documents before the next, so each model is started as rarely as possible."""
    return [(step, stage, model) for step in steps for stage, model in STAGES.get(step, ((step, MODELS[step]),))]


def run(inputs: DataFrame, done: DataFrame, work: Mapping[str, Callable[[DataFrame, str], None]], steps: Iterable[str] = STEPS, force: bool = False) -> list[tuple[str, str, int]]:
    """(step, stage, documents) of what was run: each phase gets the documents (file) that still need its step, if there are any.

    ``work`` has a function of (files, stage) for each step; one that fails ends the run, and what was done before counts.
    """
    waiting = inputs.select("file", F.explode(F.array(*map(F.lit, STEPS))).alias("step")) if force else pending_steps(inputs, done)
    waiting = waiting.where(F.col("step").isin(*steps)).persist()
    counts = {r["step"]: r["count"] for r in waiting.groupBy("step").count().collect()}
    out = []
    for step, stage, _ in phases(steps):
        if counts.get(step):
            work[step](waiting.where(F.col("step") == step).select("file"), stage)
            out.append((step, stage, counts[step]))
    waiting.unpersist()
    return out


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    """The command line: a file or folder of documents, where results go and which steps to run."""
    parser = argparse.ArgumentParser(prog="lexstrata", description="Structures scanned documents.")
    parser.add_argument("input")
    parser.add_argument("--output", default="out")
    parser.add_argument("--glob", default="*.json")
    parser.add_argument("--steps", nargs="*", default=[])
    parser.add_argument("--from", dest="first", default=None)
    parser.add_argument("--skip", nargs="*", default=[])
    parser.add_argument("--force", action="store_true")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Labels the documents of a folder and writes their blocks with labels; the steps with models need ``run`` with functions of one's own."""
    from lexstrata.operators.structure import prepared
    from lexstrata.session import build_session
    from lexstrata.sources.blocks import documents_at, read_documents
    from lexstrata.sources.sinks import write_json_lines

    args = arguments(argv)
    steps = selected(args.steps, args.first, args.skip)
    spark = spark or build_session()
    documents_at(spark, args.input, args.glob)
    config = load_config()
    if "tree" in steps:
        blocks = read_documents(spark, args.input, args.glob).withColumn("profile", F.lit(config.language)).withColumn("block_id", F.xxhash64("file", "ordine"))
        write_json_lines(prepared(blocks).drop("bbox"), f"{args.output}/blocks")
    return 0
