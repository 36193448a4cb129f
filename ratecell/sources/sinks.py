"""Sinks: managed tables and exhibit files.

Writes go to shared storage (a catalog table or a folder under the cluster's
shared paths), never to a machine-local folder. A written table is also how a
long plan is cut: the next step reads it back instead of recomputing the
lineage, and a lost executor costs a task retry, not a restart from the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_table(df: DataFrame, table: str, fmt: str = "parquet",
               partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None,
               sort_by: Sequence[str] = ()) -> None:
    """Replace a managed table: the new one is written aside first, so that a failed write leaves the
    old one and the frame may read the table it replaces. ``bucket_by=(n, keys)`` co-locates a
    later join on those keys (no shuffle when both sides share the bucketing)."""
    aside = f"{table}__new"
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {aside}")
    if bucket_by:           # each bucket meets in one task and becomes one file
        df = df.repartition(bucket_by[0], *bucket_by[1])
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, keys = bucket_by
        w = w.bucketBy(n, *keys)
        if sort_by:
            w = w.sortBy(*sort_by)
    w.saveAsTable(aside)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    df.sparkSession.sql(f"ALTER TABLE {aside} RENAME TO {table}")


def copy_table(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> None:
    """A separate copy per scoring run, so two runs never share an input."""
    save_table(spark.table(source), target, fmt)


def exhibit_path(folder: str, ticket: int | str, filename: str, free_form: str,
                 fileformat: str = "parquet") -> str:
    return f"{folder.rstrip('/')}/{ticket}/{filename}/{free_form}.{fileformat}"


def write_exhibit(df: DataFrame, folder: str, ticket: int | str, filename: str, free_form: str,
                  fileformat: str = "parquet", dry_run: bool = False,
                  log: list | None = None) -> str:
    """Write an exhibit under ``folder/ticket/filename/free_form``; with
    ``dry_run`` nothing is written and the path is only recorded."""
    path = exhibit_path(folder, ticket, filename, free_form, fileformat)
    if log is not None:
        log.append({"path": path, "written": not dry_run})
    if not dry_run:
        df.write.mode("overwrite").format(fileformat).save(path)
    return path


def write_exhibits(exhibits: Mapping[str, DataFrame], folder: str, ticket: int | str,
                   filename: str, dry_run: bool = False, guards: Mapping[str, object] | None = None) -> list[dict]:
    """Write several exhibits. ``guards``: for an exhibit's name the ``checks.Guard`` that watches its rows;
    it is checked after the write, and an exhibit that fails it is removed before the error is raised. Its
    counts join the log."""
    log: list[dict] = []
    for free_form, df in exhibits.items():
        path = write_exhibit(df, folder, ticket, filename, free_form, dry_run=dry_run, log=log)
        guard = (guards or {}).get(free_form)
        if guard is not None and not dry_run:
            try:
                log[-1]["guard"] = guard.check()
            except AssertionError:
                remove_folder(df.sparkSession, path)
                raise
    return log


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system that Spark writes to."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


def materialize(df: DataFrame, name: str, bucketed: tuple[str, int] | None = None) -> DataFrame:
    """Write ``df`` once as parquet under the session's shared checkpoint folder
    and read it back: later consumers start from these files (column-pruned,
    filter-pushed) instead of re-running the lineage, and a lost executor
    re-reads files rather than recomputing joins. ``bucketed``: see ``materialize_bucketed``."""
    if bucketed:
        return materialize_bucketed(df, name, *bucketed)
    path, _ = _new_folder(df.sparkSession, name)
    with _no_shuffle_files(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``materialize`` as a table bucketed on ``key``, for later joins and aggregates whose keys hold ``key``:
    they read its buckets without an exchange. For joins on more keys than ``key`` that takes a setting, which is
    filled in if the session has none. No exchange is added before the write either, so ``df`` should be
    partitioned by ``key`` into as many partitions, as after a join on it."""
    _join_on_buckets(df.sparkSession)
    path, table = _new_folder(df.sparkSession, name)
    _tables.setdefault(df.sparkSession.sparkContext.applicationId, []).append(table)
    with _no_shuffle_files(df.sparkSession):
        (df.write.mode("errorifexists").option("compression", "zstd").option("path", path).format("parquet")
         .bucketBy(buckets, key).saveAsTable(table))
    return df.sparkSession.table(table)


def _join_on_buckets(spark: SparkSession) -> None:
    if spark.conf.get(CO_PARTITION, None) is None:
        spark.conf.set(CO_PARTITION, "false")


def _new_folder(spark: SparkSession, name: str) -> tuple[str, str]:
    """A new folder under the shared checkpoint folder, which ``release`` deletes, and its name."""
    import uuid
    from ratecell.session import ensure_checkpoint_dir
    unique = f"{name}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/materialized/{unique}"
    _materialized.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path, unique


@contextmanager
def _no_shuffle_files(spark: SparkSession):
    """A write's exchanges are of no use once the files are there: they leave the disk at its end."""
    with _conf(spark, CLEANUP, "true"):
        yield


@contextmanager
def small_methods(spark: SparkSession):
    """For writes of rows that many expressions make: Spark then keeps to methods that HotSpot compiles (8,000
    bytes) and makes wide projections of several, instead of one that is interpreted."""
    with _conf(spark, HUGE_METHOD, "8000"):
        yield


@contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


_materialized: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}


def release(spark: SparkSession) -> int:
    """Delete what ``materialize`` and ``materialize_bucketed`` have written for this application, once the
    frames that read it are done with (after their exhibits are written). Returns how many folders went."""
    for table in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    paths = _materialized.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_folder(spark, path)
    return len(paths)


def save_side(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """A side of a later join as a table bucketed and sorted on its keys, one file per bucket, and read back.
    Two sides saved alike join without an exchange, as long as nothing changes the keys in between: map
    codes before saving. ``path``: where the files go, else the warehouse. An existing table raises."""
    w = (df.repartition(buckets, *keys).write.format("parquet").mode("errorifexists")
         .bucketBy(buckets, *keys).sortBy(*keys))
    (w.option("path", path) if path else w).saveAsTable(table)
    return df.sparkSession.table(table)


def save_partitions(df: DataFrame, path: str, by: str, run: str, bucketed: tuple[str, int] | None = None) -> DataFrame:
    """Write ``df`` into a table folder partitioned by ``by`` and give what the folder holds: partitions that ``df`` has
    rows of are replaced, all others keep their files. ``run`` names the job in the lineage column ``run_id``.
    ``bucketed=(key, buckets)``: into a new folder, whose partitions are bucketed too, for joins as after
    ``materialize_bucketed``; ``df`` should hold few buckets in a partition."""
    spark = df.sparkSession
    w = df.withColumn("run_id", F.lit(run)).write.option("compression", "zstd").partitionBy(by)
    if bucketed is None:
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        return spark.read.parquet(path)
    import uuid
    _join_on_buckets(spark)
    table = f"partitions_{uuid.uuid4().hex}"
    _tables.setdefault(spark.sparkContext.applicationId, []).append(table)
    w.mode("errorifexists").option("path", path).format("parquet").bucketBy(bucketed[1], bucketed[0]).saveAsTable(table)
    return spark.table(table)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint to the session's shared checkpoint folder."""
    return df.checkpoint(eager=True)
