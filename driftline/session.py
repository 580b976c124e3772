"""Session settings, shared storage and plan size estimates."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What may be broadcast, by the optimizer's estimate; checked wherever data of the caller's is.
BROADCAST_BYTES = 64 << 20


def build_session(app: str = "driftline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume.

    Adaptive execution sizes shuffle partitions and splits skewed joins; UTC keeps
    epoch arithmetic and timestamps without zone in agreement.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path every executor can reach, for tables and stream checkpoints.

    It lies below `spark.checkpoint.dir`. Only a local session may do without that
    setting, since there the machine's own temporary folder is shared by definition.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="driftline-")
    run = _RUN.get()
    return f"{root.rstrip('/')}/driftline/{f'{run}/' if run else ''}{purpose}-{uuid.uuid4().hex}"


# The run whose scratch tables lie together.
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what is stored within: results must have been written or collected by then.

    Of nested contexts the outermost removes everything. A context that fails removes its tables too.
    """
    if _RUN.get():
        yield
        return
    run = f"run-{uuid.uuid4().hex}"
    token = _RUN.set(run)
    try:
        yield
    finally:
        _RUN.reset(token)
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/driftline/{run}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, or None where there is none."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None
    # Spark's default for a relation of unknown size is the largest long.
    return size if size < (1 << 63) - 1 else None


def is_plain_read(df: DataFrame) -> bool:
    """Whether the frame is a read of files with projections and filters only, so that evaluating it again costs little more than reading."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = {m[1] for line in plan.splitlines() if (m := re.match(r"[\s:+\-|]*([A-Z]\w*)", line))}
    return nodes <= {"Project", "Filter", "Relation", "Union"}


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to a shared folder and read back: computed once, and of known size."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, purpose: str, **of: Column) -> tuple[DataFrame, dict[str, Any]]:
    """`stored`, and what the aggregates `of` give for its rows, taken as they are written: loops need no further queries for them.

    Where Spark leaves them out, as it may for plans found to be empty, the stored rows are asked.
    """
    wanted = [c.alias(name) for name, c in of.items()]
    seen = Observation()
    rows = stored(df.observe(seen, *wanted), purpose)
    return rows, seen.get or rows.agg(*wanted).first().asDict()


def settled(spark: SparkSession, purpose: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What `build` gives, stored; the tables that it stores on the way are removed."""
    path = shared_dir(spark, purpose)
    with scratch(spark):
        rows = build()
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Collect the driver's garbage, Python's first, which holds frames of the JVM's.

    Spark removes shuffles and broadcasts of frames that are no longer used only after that. A loop of many small queries
    would else let the heap grow to its limit before.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The frame marked for broadcast if its size is known to be small, else as it is."""
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= limit else df


def spread(scan: DataFrame, bytes_per_task: int = 512 << 10) -> DataFrame:
    """A scan of few large pieces, spread over the cores before costly work on each row.

    Files that do not split leave most cores idle. A scan that already has as many pieces as
    cores, or too little data for more tasks, is returned as it is.
    """
    size = estimated_bytes(scan)
    cores = scan.sparkSession.sparkContext.defaultParallelism
    tasks = cores if size is None else min(cores, size // bytes_per_task)
    return scan.repartition(tasks) if tasks >= 2 * scan.rdd.getNumPartitions() else scan


def few_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[tuple]) -> DataFrame:
    """A handful of fixed rows, built inside the JVM."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
