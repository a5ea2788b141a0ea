"""Session helpers: table access, lineage cuts and input spreading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "lodestone") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where that setting is absent, a run on one machine gets a temporary folder once; a cluster
    must name its own, or the call fails.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/").rsplit("/", 1)[0]
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="lodestone-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint, so lost executors cost no recomputation."""
    spark = df.sparkSession
    base = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint(eager=True)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for a written table."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table of the shared folder that is no longer needed."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Give work that is heavy on the CPU enough tasks.

    Only an input with fewer splits than ``factor`` times the cores is redistributed; a large
    table keeps its scan partitions and pays no shuffle.
    """
    want = factor * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want // 2 else df


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a table whose size is bounded by its meaning; fails loudly beyond ``limit``."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it is meant to be a small dimension")
    return rows


def maybe_broadcast(df: DataFrame, rows: int, limit: int = 100_000) -> DataFrame:
    """Hint a broadcast only for a side whose counted ``rows`` lie under ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per context.

    Workers that can import it already lose nothing; those on other machines get it from the driver.
    """
    import os
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_lodestone_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="lodestone-code-"), "lodestone.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(target)
    context._lodestone_shipped = True
    return spark
