"""Files of a resumable workflow: documents, rows of its stages, states, guarded destinations."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import urls
from lodestone.sources.jsonl import read_lines


def read_json(path: str, default=None):
    """A small JSON document, or ``default`` where the file is missing."""
    if not os.path.exists(path):
        return default
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def plain(value):
    """A value as JSON writes it: dates in ISO form, sets as sorted lists, paths as texts."""
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (set, frozenset)):
        return sorted(value, key=str)
    return value.value if hasattr(value, "value") else str(value)


def write_json(path: str, value) -> None:
    """Write a small document whole or not at all."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, made = tempfile.mkstemp(dir=folder, suffix=".part")
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2, default=plain)
        f.flush()
        os.fsync(f.fileno())
    os.replace(made, path)


def write_rows(rows: DataFrame, path: str, append: bool = False) -> None:
    """Rows as JSON lines, times in ISO form; the committer makes the write whole or nothing."""
    guard(path)
    rows.write.mode("append" if append else "overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").json(path)


def guard(path: str, closed: str = "final") -> None:
    """Refuse a destination below a folder that later stages own."""
    if closed in PurePosixPath(path.split("://", 1)[-1]).parts:
        raise ValueError(f"{path} lies below a folder named {closed!r}")


def stage_rows(spark: SparkSession, path: str, schema: str, needed: tuple[str, ...]) -> DataFrame:
    """Rows of a stage's JSON lines that are objects and have the ``needed`` fields; (file, line_no) keep their order."""
    names = [f.split()[0].split(":")[0] for f in schema.split(", ")]
    rows = read_lines(spark, path).where("kind = 'object'").select("file", "line_no", F.from_json("line", schema).alias("r")).select("file", "line_no", *[f"r.{n}" for n in names])
    for n in needed:
        rows = rows.where(F.col(n).isNotNull() & (F.trim(F.col(n).cast("string")) != ""))
    return rows


def load_prepared(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Prepared rows: those with an id and a name."""
    return stage_rows(spark, path, schema, ("candidate_id", "name"))


def load_verified(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Verified rows: those with a name."""
    return stage_rows(spark, path, schema, ("name",))


def load_facts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Facts of finished runs (outcome success or empty), the last row of each address in normal form."""
    rows = stage_rows(spark, path, schema, ("official_url", "outcome")).where("outcome in ('success', 'empty')")
    rows = rows.withColumn("page", urls.normalize_url(F.col("official_url"))).where("page is not null and facts is not null")
    row = F.struct(*rows.columns)
    return rows.groupBy(F.col("page").alias("_page")).agg(F.max_by(row, F.struct("file", "line_no")).alias("row")).select("row.*")


def verification_input(spark: SparkSession, resolved: str, prepared: str, schema: str) -> DataFrame:
    """The resolved rows if that file exists, though it be empty, else the prepared ones, else none."""
    for path, needed in ((resolved, ("name",)), (prepared, ("candidate_id", "name"))):
        if os.path.exists(path):
            return stage_rows(spark, path, schema, needed)
    return stage_rows(spark, resolved, schema, ())


class State:
    """The log of a stage's runs: the last ``keep``; a run that began at a known time replaces its entry; a broken file starts anew."""

    def __init__(self, path: str, keep: int = 50):
        self.path, self.keep = path, keep

    def runs(self) -> list[dict]:
        try:
            data = read_json(self.path, {})
        except ValueError:
            data = {}
        runs = data.get("runs") if isinstance(data, dict) else None
        return [r for r in runs if isinstance(r, dict)] if isinstance(runs, list) else []

    def add(self, run: dict) -> None:
        rest = [r for r in self.runs() if r.get("started_at") != run.get("started_at")]
        write_json(self.path, {"runs": [*rest, run][-self.keep :]})
