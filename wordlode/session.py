"""Lineage cuts and size-checked small tables, shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordlode.sources.tables import write_table


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wordlode-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    Spark knows the true size of a written table, so it broadcasts only what is
    small, and it no longer carries the conditions that led to the rows into
    other sides of a join, where it would check them again on every row.
    """
    path = shared_path(df.sparkSession, "table")
    write_table(df, path, "errorifexists")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_in_place(df: DataFrame, arrange) -> DataFrame:
    """Checkpoint ``arrange(df)`` so that its partitioning and order stay usable.

    Later joins and groups on the same keys then need no shuffle. Adaptive plans
    do not report their partitioning, so ``arrange`` is planned without them, on a
    written copy and in a session of its own: the settings of the caller, and of
    other threads of that session, stay as they are. In a join the result has to
    stand on the right, as the left side names the session.
    """
    written = cut_lineage(df)
    apart = df.sparkSession.newSession()
    apart.conf.set("spark.sql.adaptive.enabled", "false")
    copy = apart.read.schema(written.schema).parquet(*written.inputFiles())
    held = arrange(copy).checkpoint()
    drop_table(written)
    return held


def drop_table(df: DataFrame) -> None:
    """Delete the folder of a written table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Below this many bytes per core a table is dealt out anew.
SMALL_BYTES_PER_CORE = 32 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal out a small table over all cores.

    A small file is one row group, hence one task, however much work each row
    is. Large tables and tables of a file per core already have a task for each
    core and stay untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores * SMALL_BYTES_PER_CORE or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)


# Rows of a few numbers in one part of a gathered table.
GATHERED_ROWS = 500_000


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has at most about ``rows`` narrow rows, in no more parts than these are worth.

    A part for each core, or for ``GATHERED_ROWS`` rows if that is more: a small table that leaves a shuffle of many
    partitions would be as many files, each a task to read and a new process of the file system to write.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-rows // GATHERED_ROWS)))


def bounded_list(df: DataFrame, column: str, max_rows: int) -> list[str]:
    """The distinct non-empty strings of a column, for lists that are short by definition.

    More than ``max_rows`` of them are an error, and never reach the driver.
    """
    terms = cut_lineage(df.select(F.col(column).alias("term")).where("term <> ''").distinct())
    n = terms.count()
    if n > max_rows:
        raise ValueError(f"{n} rows in {column!r}, {max_rows} at most")
    return sorted(row["term"] for row in terms.collect())
