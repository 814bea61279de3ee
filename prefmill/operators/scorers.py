"""The boundary to models: batch scorers over Arrow, with dead letters.

A scorer takes a list of row dicts and returns one dict a row. A batch that
raises is tried row by row; rows that still raise become failures with stage
and reason. Scorer output is written before it is used again, so that a model
is not called twice for a row.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from prefmill.scratch import stored
from prefmill.sources.jsonl import InputError

Scorer = Callable[[list[dict]], list[dict]]


def score(df: DataFrame, make: Callable[[], Scorer], schema: str, stage: str, batch_size: int = 8, attempts: int = 1, keep: list[str] | None = None, delay: float = 0.0) -> DataFrame:
    """Rows of ``keep`` columns with the scorer's fields and error (null if scored).

    ``make`` builds the scorer once a task. Filter before: Spark does not move
    a filter through this step. ``delay`` is waited (seconds, doubled each
    time) before a row is tried again.
    """
    kept = keep or df.columns
    made = T.StructType.fromDDL(schema)
    out = T.StructType([*[df.schema[c] for c in kept], *made.fields, T.StructField("stage", T.StringType()), T.StructField("error", T.StringType())])
    names = [f.name for f in made.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, arrow = make(), to_arrow_schema(out)
        for batch in batches:
            for at in range(0, batch.num_rows, batch_size):
                rows = batch.slice(at, batch_size).to_pylist()
                result = []
                try:
                    result = [dict(zip(names, map(g.get, names), strict=True)) | {"error": None} for g in scorer(rows)]
                    if len(result) != len(rows):
                        raise ValueError("a scorer must return one result a row")
                except Exception:
                    result = [_alone(scorer, r, names, attempts, delay) for r in rows]
                yield pa.RecordBatch.from_pylist([{**{c: r[c] for c in kept}, **g, "stage": stage if g["error"] else None} for r, g in zip(rows, result, strict=True)], schema=arrow)

    return df.mapInArrow(run, out)


def _alone(scorer: Scorer, row: dict, names: list[str], attempts: int, delay: float = 0.0) -> dict:
    reason = ""
    for k in range(attempts):
        if k and delay:
            time.sleep(delay * 2 ** (k - 1))
        try:
            got = scorer([row])[0]
            return {n: got.get(n) for n in names} | {"error": None}
        except Exception as e:
            reason = f"{type(e).__name__}: {e}"[:1000]
    return dict.fromkeys(names) | {"error": reason or "no attempt"}


def split(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scored rows, failures)."""
    return scored.where("error is null").drop("stage", "error"), scored.where("error is not null")


#: Prompt strategies at most.
STRATEGIES = 1000


def two_turns(questions: DataFrame, strategies: DataFrame, make: Callable[[], Scorer], batch_size: int = 8) -> DataFrame:
    """Both turns of every question under every prompt strategy; the second turn sees the first's answer.

    ``strategies`` (at most ``STRATEGIES`` rows) has strategy and prefix. There
    is a row for each question and strategy: outputs (null for a turn that was
    not answered), stage and error (null if both were). The first turn's
    answers are stored, so no model is called twice for a row.
    """
    known = strategies.select("strategy", "prefix").limit(STRATEGIES + 1).collect()
    if len(known) > STRATEGIES:
        raise InputError(f"more than {STRATEGIES} strategies")
    listed = F.array(*[F.struct(F.lit(r["strategy"]).alias("strategy"), F.lit(r["prefix"]).alias("prefix")) for r in known]) if known else F.array().cast("array<struct<strategy: string, prefix: string>>")
    rows = questions.select("id", "category", "questions", F.inline(listed))
    first = rows.withColumn("messages", F.concat("prefix", F.col("questions")[0]))
    one = stored(score(first, make, "output string", "turn 1", batch_size, keep=["id", "category", "questions", "strategy", "prefix"]), "first-turns")
    second = one.where("error is null").withColumn("first", F.col("output")).withColumn("messages", F.concat_ws("\n\n", F.concat("prefix", F.col("questions")[0]), "output", F.col("questions")[1])).drop("output", "stage", "error")
    two = score(second, make, "output string", "turn 2", batch_size, keep=["id", "category", "questions", "strategy", "first"])
    failed = one.where("error is not null").withColumn("first", F.lit(None).cast("string"))
    both = two.unionByName(failed.select(*two.columns))
    return both.select("id", "category", "questions", "strategy", F.array("first", "output").alias("outputs"), "stage", "error")
