"""Writing results: one document as JSON, tables as partitioned JSON or Parquet, XML as files, the artefacts of a tree."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexstrata.functions.text import resource_name


def write_report(path: str | Path, payload: object) -> None:
    """One JSON document: UTF-8, indented by 2, other scripts as they are; folders are made, and a reader never sees half a file."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    half = target.with_name(f".{target.name}.{os.getpid()}")
    half.write_text(json.dumps(payload, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    half.replace(target)


def write_json_lines(df: DataFrame, path: str, by: str = "file") -> None:
    """Rows as JSON lines, one folder for each value of ``by``; a large value is written by many tasks."""
    df.withColumn("_part", resource_name(F.col(by))).write.mode("overwrite").partitionBy("_part").option("ignoreNullFields", "false").json(path)


def write_xml_files(documents: DataFrame, path: str, name_col: str = "file", xml_col: str = "xml") -> DataFrame:
    """Each document's XML as one file in ``path``, a folder that all executors share; returns (file, path, bytes) and runs when that is read."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for name, resource, xml in zip(part[name_col], part["_name"], part[xml_col]):
                data = (xml or "").encode("utf-8")
                target = os.path.join(path.removeprefix("file://"), f"{resource}.xml")
                os.makedirs(os.path.dirname(target), exist_ok=True)
                with open(f"{target}.part", "wb") as f:
                    f.write(data)
                os.replace(f"{target}.part", target)
                out.append((name, target, len(data)))
            yield pd.DataFrame(out, columns=["file", "path", "bytes"])

    return documents.select(name_col, resource_name(F.col(name_col)).alias("_name"), xml_col).mapInPandas(run, "file string, path string, bytes bigint")


def write_vectors(examples: DataFrame, path: str, encoder, text_col: str = "text", batch: int = 256) -> None:
    """``examples`` with their vectors of length one as Parquet; ``encoder`` takes a list of texts and returns a list of vectors.

    A zero vector stays zero; a null text is encoded as the empty one.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            vectors = []
            for at in range(0, len(part), batch):
                vectors += encoder([t if isinstance(t, str) else "" for t in part[text_col].iloc[at : at + batch]])
            out = []
            for v in vectors:
                size = sum(x * x for x in v) ** 0.5
                out.append([x / size if size else 0.0 for x in v])
            yield part.assign(embedding=out)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in examples.schema.fields)
    examples.mapInPandas(run, f"{fields}, embedding array<float>").write.mode("overwrite").parquet(path)


def write_states(records: DataFrame, path: str) -> None:
    """Records by the state they are in, one folder each: accepted, low_confidence, reviewed, missing and failed."""
    status = F.coalesce("review_status", F.lit(""))
    state = F.when(status.isin("deterministic", "accepted_slm"), "accepted").when(status == "llm_reviewed", "reviewed").when(status == "llm_review_missing", "missing").when(status == "pending_llm_review", "low_confidence").otherwise("failed")
    records.withColumn("state", state).write.mode("overwrite").partitionBy("state").parquet(path)


def write_artefacts(path: str, nodes: DataFrame, contents: DataFrame, chunks: DataFrame, elements: DataFrame, xml: DataFrame, report: DataFrame) -> None:
    """The five artefacts of trees below ``path``: tree (nodes and contents), chunks, elements, XML and report, partitioned by file."""
    for name, df in {"tree/nodes": nodes, "tree/contents": contents, "chunks": chunks, "elements": elements, "report": report}.items():
        write_json_lines(df, f"{path}/{name}")
    xml.select("file", "xml").write.mode("overwrite").parquet(f"{path}/xml")
