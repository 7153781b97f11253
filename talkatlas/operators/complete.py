"""Distributed prompt completion with a function supplied by the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.checks import require_columns
from talkatlas.runtime import join_small, salt_count, stored

Completer = Callable[[str], str]
ANSWERS = "key STRING, raw STRING, error STRING"
# With version 2 of Hadoop's committer a file is in its place once its task has ended.
COMMIT_BY_TASK = ("mapreduce.fileoutputcommitter.algorithm.version", "2")
# So many slices at most are tasks of one job, which bounds what the driver keeps of it.
JOB_SLICES = 4096


def complete(
    df: DataFrame,
    prompt_col: str,
    completer_factory: Callable[[], Completer],
    max_tasks: int | None = None,
    calls_in_flight: int = 1,
) -> DataFrame:
    """Replace a prompt column by ``raw`` (the answer) and ``error``.

    ``completer_factory`` runs once per task and returns the function that is
    called with each prompt, so a client is opened where it is used.  A call
    that raises gives a null answer and its message in ``error``; the other
    rows go on.  The prompt column may hold one prompt or an array of them;
    ``raw`` and ``error`` then are arrays as well, and the row stays whole, so
    several prompts per row need no shuffle.

    ``max_tasks`` bounds the tasks that call at the same time.  The answers are
    costly and a retried task asks again: write the result before reusing it,
    or use ``complete_logged``.
    """
    require_columns(df, prompt_col)
    many = isinstance(df.schema[prompt_col].dataType, T.ArrayType)
    kept = [c for c in df.columns if c != prompt_col]
    answer = T.ArrayType(T.StringType()) if many else T.StringType()
    schema = T.StructType(
        [df.schema[c] for c in kept]
        + [T.StructField("raw", answer), T.StructField("error", answer)]
    )
    arrow_answer = pa.list_(pa.string()) if many else pa.string()

    def ask_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = completer_factory()

        def ask(prompt: str | None) -> tuple[str | None, str | None]:
            try:
                return str(call(prompt)), None
            except Exception as failure:
                return None, f"{type(failure).__name__}: {failure}"

        def ask_row(prompts):
            if not many:
                return ask(prompts)
            answers = [ask(p) for p in prompts or []]
            return [a for a, _ in answers], [e for _, e in answers]

        with ThreadPoolExecutor(calls_in_flight) as pool:
            # A slice at a time, so that neither prompts nor answers of a whole batch are held.
            size = max(4 * calls_in_flight, 16)
            for batch in (b.slice(at, size) for b in batches for at in range(0, b.num_rows, size)):
                prompts = batch.column(prompt_col).to_pylist()
                answers = list(pool.map(ask_row, prompts))
                columns = [batch.column(c) for c in kept]
                columns.append(pa.array([a for a, _ in answers], arrow_answer))
                columns.append(pa.array([e for _, e in answers], arrow_answer))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    if max_tasks is not None:
        df = df.repartition(max_tasks)
    return df.mapInArrow(ask_all, schema)


def read_answers(spark: SparkSession, log_path: str) -> DataFrame:
    """The answer log: ``key`` (a hash of the prompt), ``raw`` and ``error``; empty if there is none yet."""
    try:
        return spark.read.schema(ANSWERS).parquet(log_path)
    except AnalysisException:
        return spark.createDataFrame([], ANSWERS)


def complete_logged(
    df: DataFrame,
    prompt_col: str,
    completer_factory: Callable[[], Completer],
    log_path: str,
    max_tasks: int | None = None,
    calls_in_flight: int = 1,
    slice_prompts: int = 64,
) -> DataFrame:
    """``complete`` with answers kept in a log across runs.

    Prompts are asked in slices of about ``slice_prompts``, each a task that
    appends it to the log at ``log_path`` when it ends, also where the job fails
    later.  A run that fails can be started again: what the log answers is not asked
    again, so a lost task costs its part of one slice at most.  Equal prompts
    are asked once and share the answer.  Calls that raised are asked again in
    the next run.  A null prompt is not asked.  Of an array of prompts each one
    is logged by itself, so a row that was answered in part goes on with the rest.

    ``log_path`` has to be storage that all executors share, and one run at a
    time may write to it.
    """
    require_columns(df, prompt_col)
    spark = df.sparkSession
    many = isinstance(df.schema[prompt_col].dataType, T.ArrayType)
    each = df.select(F.explode(prompt_col).alias("prompt")) if many else df.select(F.col(prompt_col).alias("prompt"))
    asked = each.where("prompt IS NOT NULL").select(_key(F.col("prompt")).alias("key"), "prompt")
    known = read_answers(spark, log_path).where("error IS NULL").select("key").distinct()
    pending = stored(asked.dropDuplicates(["key"]).join(known, "key", "left_anti"))
    slices = -(-pending.count() // slice_prompts)
    waves = -(-slices // (max_tasks or _job_slices(spark)))
    if waves:
        tasks = max_tasks or max(-(-slices // waves), spark.sparkContext.defaultParallelism)
        if waves > 1:
            # Sorted by wave, so that each wave reads its own rows only.
            dealt = pending.withColumn("wave", F.pmod(F.xxhash64("key"), F.lit(waves)))
            parts = min(slices, salt_count(spark))
            pending = stored(dealt.repartitionByRange(parts, "wave", "key").sortWithinPartitions("wave"))
        for i in range(waves):
            part = pending.where(F.col("wave") == i).select("key", "prompt") if waves > 1 else pending
            answered = complete(part, "prompt", completer_factory, tasks, calls_in_flight)
            answered.write.mode("append").option(*COMMIT_BY_TASK).parquet(log_path)
    # The rows of each different prompt, or array of prompts, are counted once for the joins below.
    if many:
        keys = F.transform(prompt_col, _key)
        lists = df.select(keys.alias("keys")).groupBy("keys").agg(F.count("*").alias("_n"))
        counts = stored(lists.withColumn("_list", _list(F.col("keys"))))
        wanted = counts.select(F.explode("keys").alias("_key"))
    else:
        counts = stored(df.select(_key(F.col(prompt_col)).alias("_key")).groupBy("_key").agg(F.count("*").alias("_n")))
        wanted = counts.select("_key")
    # An answer is preferred to an error of an earlier run.
    best = F.min(F.struct(F.col("error").isNotNull().alias("failed"), "raw", "error")).alias("best")
    answers = read_answers(spark, log_path).groupBy("key").agg(best).select(F.col("key").alias("_key"), "best.raw", "best.error")
    answers = stored(answers.join(wanted.distinct(), "_key", "left_semi"))
    kept = [c for c in df.columns if c != prompt_col]
    if not many:
        found = join_small(df.withColumn("_key", _key(F.col(prompt_col))), answers, "_key", counts=counts)
        return found.select(*kept, "raw", "error")
    listed = df.withColumn("_list", _list(keys))
    found = join_small(listed, _answer_lists(counts, answers), "_list", counts=counts)
    # Like ``complete``, a row without prompts has no answers.
    empty = F.array().cast("array<string>")
    return found.select(*kept, F.coalesce("raw", empty).alias("raw"), F.coalesce("error", empty).alias("error"))


def _job_slices(spark: SparkSession) -> int:
    """How many slices one job may hold: few where a committer of other storage keeps nothing of a failed job."""
    committers = {
        "spark.sql.sources.commitProtocolClass": "org.apache.spark.sql.execution.datasources.SQLHadoopMapReduceCommitProtocol",
        "spark.sql.parquet.output.committer.class": "org.apache.parquet.hadoop.ParquetOutputCommitter",
    }
    by_task = all(spark.conf.get(k) == v for k, v in committers.items())
    return JOB_SLICES if by_task else spark.sparkContext.defaultParallelism


def _key(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def _list(keys: Column) -> Column:
    return F.sha2(F.to_json(keys), 256)


def _answer_lists(lists: DataFrame, answers: DataFrame) -> DataFrame:
    """``_list, raw, error``: the answers of each of the arrays ``keys``, in its order."""
    asked = lists.select("_list", F.posexplode("keys").alias("place", "_key"))
    found = join_small(asked, answers, "_key").groupBy("_list").agg(
        F.array_sort(F.collect_list(F.struct("place", "raw", "error"))).alias("all")
    )
    return stored(found.select("_list", "all.raw", "all.error"))
