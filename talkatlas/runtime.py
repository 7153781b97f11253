"""Shared building blocks: bounded collects, small joins, top-n, stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_stored_paths: list[str] = []
# A table of this many rows is small enough for the driver and for a broadcast.
SMALL_ROWS = 4096
# A key counts as frequent beyond this many rows; of more keys than this, the most frequent ones do.
HOT_ROWS = 1000
HOT_KEYS = 10_000


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which all executors share.

    It comes from ``spark.checkpoint.dir``.  Where that is unset, a folder in
    the session's warehouse is used, which is on storage shared by all
    executors as well.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/_work")
    return context.getCheckpointDir()


def write_stored(df: DataFrame, path: str) -> None:
    """Write ``df`` as parquet and let its shuffle files go at once.

    What follows reads the table, so the shuffle files behind it are of no more
    use, and without this they would pile up until the driver collects garbage.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, with its lineage cut.

    Later steps read only the columns they need, and losing an executor does
    not bring back the work before.  A table is preferred to ``checkpoint()``
    also because the latter carries the constraints of the old plan along, and
    in a loop these grow until planning takes longer than the work.
    """
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    _stored_paths.append(path)
    write_stored(df, path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def _located(spark: SparkSession, name: str):
    """A path, and the file system that it is on."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, name: str) -> None:
    path, files = _located(spark, name)
    files.delete(path, True)


def path_exists(spark: SparkSession, name: str) -> bool:
    path, files = _located(spark, name)
    return files.exists(path)


def qualified(spark: SparkSession, name: str) -> str:
    """The path with the scheme of its file system."""
    path, files = _located(spark, name)
    return files.makeQualified(path).toUri().toString()


def publish(spark: SparkSession, written: str, place: str) -> bool:
    """Move a finished folder to its place in one step; delete it if another one is there.

    Returns whether this folder was the one.
    """
    context = spark.sparkContext
    jvm, (source, files), (target, _) = context._jvm, _located(spark, written), _located(spark, place)
    options = context._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    folders = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), context._jsc.hadoopConfiguration())
    try:
        # Unlike FileSystem.rename, this neither replaces a folder nor moves into it.
        folders.rename(files.makeQualified(source), files.makeQualified(target), options)
    except Py4JJavaError:
        if not files.exists(target):
            raise
        files.delete(source, True)
        return False
    return True


def discard(table: DataFrame) -> None:
    """Delete what ``stored`` has written, once nothing that reads it is left to run."""
    _delete(table.sparkSession, table.stored_path)
    _stored_paths.remove(table.stored_path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end all tables that were stored inside.

    What is needed later has to be written elsewhere before.
    """
    start = len(_stored_paths)
    try:
        yield
    finally:
        for path in _stored_paths[start:]:
            _delete(spark, path)
        del _stored_paths[start:]


def row_blocks(df: DataFrame, key: str, block_rows: int = SMALL_ROWS) -> Iterator[list]:
    """All rows of a table that is usually small, as lists of bounded size.

    A table of at most ``block_rows`` rows comes in one list.  A larger one is
    stored, split by key hash and handed out one part at a time, so the
    driver never holds more than one part.
    """
    rows = df.limit(block_rows + 1).collect()
    if len(rows) <= block_rows:
        yield sorted(rows, key=lambda r: r[key])
        return
    df = stored(df)
    # Twice as many parts as needed leaves room for an uneven hash.
    parts = 2 * -(-df.count() // block_rows)
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    for i in range(parts):
        block = df.where(part == i).limit(2 * block_rows + 1).collect()
        if len(block) > 2 * block_rows:
            raise RuntimeError(f"{key} is not distinct enough to split into blocks")
        if block:
            yield sorted(block, key=lambda r: r[key])


def with_last(items: Iterable) -> Iterator[tuple[object, bool]]:
    """Each item, with whether it is the last one."""
    items = iter(items)
    try:
        held = next(items)
    except StopIteration:
        return
    for following in items:
        yield held, False
        held = following
    yield held, True


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows (runs a job)."""
    return df.limit(max_rows + 1).count() <= max_rows


def salt_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_small(
    rows: DataFrame,
    small: DataFrame,
    on: str,
    how: str = "left",
    bound: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to a table with one row per key that is usually small.

    ``bound`` is a proven limit on the rows of ``small``; without one they are
    counted.  Within the limit ``small`` is broadcast.  Beyond it both sides are
    shuffled, and only frequent keys are copied, as far as their rows go over
    several salts, so that a key with a large share of all rows is not joined in
    one task and the copies are fewer than the rows.  ``counts`` has the rows of
    each key as ``_n``, where they are known; without it they are counted.
    """
    within = bound <= SMALL_ROWS if bound is not None else is_small(small)
    if within:
        return rows.join(F.broadcast(small), on, how)
    spread, copies = _salted(rows, small, on, counts)
    # Unhinted, a table that is small on disk would be broadcast whatever it holds in memory.
    return spread.join(copies.hint("merge"), [on, "_salt"], how).drop("_salt")


def _salted(
    rows: DataFrame, small: DataFrame, on: str, counts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt``; ``small`` has a copy for each salt of a frequent key."""
    salts = salt_count(rows.sparkSession)
    if counts is None:
        counts = rows.groupBy(on).agg(F.count("*").alias("_n"))
    frequent = counts.where(F.col(on).isNotNull() & (F.col("_n") > HOT_ROWS)).orderBy(F.desc("_n"), on).limit(HOT_KEYS)
    copies = F.least(F.ceil(F.col("_n") / F.lit(HOT_ROWS)), F.lit(salts)).cast("int")
    frequent = F.broadcast(stored(frequent.select(on, copies.alias("_copies"))))
    # A null key meets nothing, so its rows may go anywhere.
    parts = F.when(F.col(on).isNull(), F.lit(salts)).otherwise(F.coalesce("_copies", F.lit(1)))
    spread = rows.join(frequent, on, "left").withColumn("_salt", F.pmod(F.spark_partition_id(), parts))
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))
    return spread.drop("_copies"), small.join(frequent, on, "left").withColumn("_salt", each).drop("_copies")


def top_n_per_group(
    df: DataFrame, group: str, order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group, with their rank from 1.

    ``order`` has to be a total order within a group.  The rows of a group are
    first cut to ``n`` per salt, then to ``n`` overall.  The salt is the input
    partition, so a task sends at most ``n`` rows of a group, and no task reads
    more than its share of a hot group.
    """
    salts = salt_count(df.sparkSession)
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    part = Window.partitionBy(group, "_salt").orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    return (
        salted.withColumn("_n", F.row_number().over(part))
        .where(F.col("_n") <= n)
        .drop("_n", "_salt")
        .withColumn(rank, F.row_number().over(whole))
        .where(F.col(rank) <= n)
    )
