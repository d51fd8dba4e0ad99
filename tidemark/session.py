"""Session helpers: shared folder, literal dimension tables, lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which a query's shuffle files go when it ends, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "tidemark", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, a session in one local process (tests) gets a temporary
    folder, registered so that ``checkpoint()`` works there too; on a cluster
    that would be lost on other machines, and an error says so.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (never reused, never cleared)."""
    return f"{shared_folder(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that start and end within leave no shuffle files; for results written, as nothing reads those again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from there.

    Used where a result is read several times: the work before it is done once
    and survives the loss of executors, later reads prune columns, and its
    shuffle files go at once.
    """
    path = scratch_path(df.sparkSession, "cut")
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sql_literal(value, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    if isinstance(value, str) and kind.lower() == "string":
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST('{value}' AS {kind})"


def literal_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A dimension given in code, as a LocalRelation with exact size statistics.

    ``schema`` is ``"name type, name type"`` with simple types.  The optimiser
    knows the size, so joins to it become broadcast joins without a hint.
    """
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    body = ", ".join(
        "(" + ", ".join(_sql_literal(v, kind) for v, (_, kind) in zip(row, fields)) + ")" for row in rows
    )
    names = ", ".join(name for name, _ in fields)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
