"""Sinks: JSON lines by folder commit, one-row reports, markdown."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from prefmill.sources.jsonl import InputError


def distinct_paths(*paths: str) -> None:
    """Refuse outputs of one job that would overwrite each other."""
    real = [os.path.realpath(p) for p in paths]
    if len(set(real)) != len(real):
        raise InputError(f"outputs share a path: {paths}")


def write_jsonl(df: DataFrame, path: str, overwrite: bool = False, partition_by: list[str] | None = None) -> None:
    """JSON lines as a folder; readers trust its _SUCCESS mark. Nulls are kept as keys."""
    w = df.write.mode("overwrite" if overwrite else "errorifexists").option("ignoreNullFields", "false")
    (w.partitionBy(*partition_by) if partition_by else w).json(path)


def write_observed(df: DataFrame, path: str, overwrite: bool = False, **metrics: Column) -> dict:
    """Write JSON lines and return metrics of the rows as they pass (rows, and the given aggregates)."""
    seen = Observation()
    write_jsonl(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]), path, overwrite)
    return seen.get


def markdown_report(title: str, sections: dict[str, DataFrame], path: str, digits: int = 4) -> None:
    """A report of several small tables, one a section."""
    body = "".join(f"\n## {name}\n\n{markdown_table(df, digits=digits)}" for name, df in sections.items())
    _replace(path, f"# {title}\n{body}")


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append; the order of rows is never part of the result."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_report(report: dict, path: str) -> None:
    """A small pretty JSON file, put in place in one step."""
    _replace(path, json.dumps(report, ensure_ascii=False, indent=2) + "\n")


def _replace(path: str, text: str) -> None:
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=folder)
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(temp, path)


def markdown_table(df: DataFrame, most: int = 80, digits: int = 4) -> str:
    """A summary frame as a markdown table of at most ``most`` lines."""
    def cell(x) -> str:
        return "n/a" if x is None else f"{x:.{digits}f}" if isinstance(x, float) else str(x)

    rows = df.limit(most).collect()
    head = f"| {' | '.join(df.columns)} |\n|{'---|' * len(df.columns)}\n"
    return head + "".join(f"| {' | '.join(cell(x) for x in r)} |\n" for r in rows)


def score_lines(df: DataFrame) -> list[str]:
    """Lines 'category | single | multi' with two decimals, for a console."""
    return [" | ".join(f"{x:.2f}" if isinstance(x, float) else str(x) for x in r) for r in df.collect()]
