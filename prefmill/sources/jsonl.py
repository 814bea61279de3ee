"""JSON-lines sources with explicit schemas, and path handling."""

from __future__ import annotations

import glob
import json
import os
from collections import Counter
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


class InputError(ValueError):
    """A record or file breaks its contract."""


def read_tolerant(spark: SparkSession, paths: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their text and file); blank lines and a BOM are passed over."""
    fields = T.StructType.fromDDL(schema).add(CORRUPT, T.StringType())
    rows = spark.read.schema(fields).option("columnNameOfCorruptRecord", CORRUPT).json(paths).withColumn("_file", F.col("_metadata.file_path"))
    # Spark refuses to read the corrupt column alone, so the filter looks at a field of the record too
    seen = F.coalesce(F.col(fields.fields[0].name).cast("string"), F.lit("")) != "\0"
    return rows.where(F.col(CORRUPT).isNull() & seen).drop(CORRUPT, "_file"), rows.where(F.col(CORRUPT).isNotNull() & seen).select("_file", CORRUPT)


def read_strict(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Rows of files in which every line must be an object of the schema."""
    good, bad = read_tolerant(spark, paths, schema)
    first = bad.limit(3).collect()
    if first:
        raise InputError("; ".join(f"{r['_file']}:{r['_line']}: {r[CORRUPT][:120]}" for r in with_lines(spark, bad.limit(3)).collect()))
    return good


def with_lines(spark: SparkSession, bad: DataFrame) -> DataFrame:
    """Bad rows with the numbers of the lines that they are (_line); only the files that have any are read again."""
    bad = bad.dropDuplicates()
    found = None
    for r in bad.select("_file").distinct().collect():  # a row a broken file
        lines = read_numbered(spark, r["_file"]).select(F.lit(r["_file"]).alias("_file"), F.col("line").alias("_line"), F.col("raw").alias(CORRUPT))
        found = lines if found is None else found.unionByName(lines)
    return bad.withColumn("_line", F.lit(None).cast("long")) if found is None else bad.join(found, ["_file", CORRUPT]).orderBy("_file", "_line")


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with their numbers, for reports on one file.

    Lines are numbered by byte order of the file's splits; only the lines
    before each split are counted, nothing is gathered.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", "\\A\ufeff", "").alias("raw"), F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_at"))
    counts = {r["_p"]: r["n"] for r in lines.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a split
    before, total = {}, 0
    for p in sorted(counts):
        before[p] = total
        total += counts[p]
    start = F.create_map(*[F.lit(x) for kv in before.items() for x in kv]) if before else F.create_map(F.lit(0), F.lit(0))
    return lines.select((F.col("_at") - F.shiftleft(F.col("_p").cast("long"), 33) + start[F.col("_p")] + 1).cast("long").alias("line"), "raw")


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of any JSON-lines file that has them."""
    return read_strict(spark, path, "id long").select("id").where("id is not null").distinct()


def sniff(spark: SparkSession, path: str) -> str:
    """'sft' if the first record has messages, else 'raw'."""
    first = spark.read.text(path).where(F.trim("value") != "").first()
    if first is None:
        raise InputError(f"{path} has no rows")
    return "sft" if "messages" in json.loads(first["value"].lstrip("\ufeff")) else "raw"


def load_stage(spark: SparkSession, path: str, sft: str, raw: str) -> DataFrame:
    """Rows of either format, told by the first record, with source_format."""
    kind = sniff(spark, path)
    return read_strict(spark, path, sft if kind == "sft" else raw).withColumn("source_format", F.lit(kind))


def _listed(spark: SparkSession, pattern: str) -> list[tuple[str, str]]:
    """(file, path relative to its root) in any file system that Spark opens."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for s in fs.globStatus(at) or []:
        root = s.getPath()
        if s.isFile():
            out.append((root.toString(), root.getName()))
            continue
        files = fs.listFiles(root, True)
        while files.hasNext():
            f = files.next().getPath().toString()
            if f.endswith(".jsonl"):
                out.append((f, f[len(root.toString()) :].lstrip("/")))
    return out


def expand_inputs(patterns: list[str], hidden: bool = False, skip_suffix: str = "_reeval", spark: SparkSession | None = None) -> list[tuple[str, str]]:
    """(file, path relative to its root) of files, folders and globs, each once, sorted.

    Hidden parts and folders that end in ``skip_suffix`` are left out; two
    inputs with one relative path are an error, as are patterns without match.
    With a session, patterns with a scheme are listed by Spark's file systems.
    """
    found: dict[str, str] = {}
    for pattern in patterns:
        p = Path(pattern)
        if spark is not None and "://" in pattern:
            hits = [(f, Path(rel)) for f, rel in _listed(spark, pattern)]
        elif p.is_dir():
            hits = [(f, f.relative_to(p)) for f in p.rglob("*.jsonl")]
        elif p.is_file():
            hits = [(p, Path(p.name))]
        else:
            hits = [(Path(f), Path(os.path.basename(f))) for f in glob.glob(pattern, recursive=True) if os.path.isfile(f)]
        hits = [(f, rel) for f, rel in hits if not any((not hidden and part.startswith(".")) or part.endswith(skip_suffix) for part in rel.parts)]
        if not hits:
            raise InputError(f"no input matches {pattern}")
        for f, rel in hits:
            found[f if isinstance(f, str) else str(f.resolve())] = str(rel)
    twice = {r for r, n in Counter(found.values()).items() if n > 1}
    if twice:
        raise InputError(f"several inputs would be written to {sorted(twice)[:5]}")
    return sorted(found.items())


def category_prompts(spark: SparkSession, folder: str, files: dict[str, str]) -> DataFrame:
    """category, rubric: one text file a category, none empty; a handful of rows."""
    names = spark.createDataFrame([(c, f) for c, f in files.items()], "category string, file string")
    texts = spark.read.text(folder, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("value").alias("rubric"))
    out = names.join(texts, "file", "left").select("category", "rubric")
    missing = [r["category"] for r in out.where("rubric is null or trim(rubric) = ''").collect()]
    if missing:
        raise InputError(f"no rubric for {missing}")
    return out


def load_config(path: str) -> dict:
    """A mapping from a JSON file, or from YAML where a YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml

        out = yaml.safe_load(text)
    except ImportError:
        out = json.loads(text)
    if not isinstance(out, dict):
        raise InputError(f"{path} is not a mapping")
    return out
