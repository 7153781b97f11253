"""Summary and name of every cluster, by completion or from token counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.checks import require_columns
from talkatlas.functions import text
from talkatlas.operators.complete import Completer, complete
from talkatlas.operators.examples import example_bundles
from talkatlas.params import DEFAULT_CRITERIA, NamingParams
from talkatlas.runtime import stored, join_small, top_n_per_group

# The texts of a name and a summary made from token counts.
FALLBACK_NAME_START = "Summarize"
FALLBACK_NAME_TOKENS = 4
FALLBACK_NAME_LENGTH = 80
FALLBACK_TOKENS = 6
FALLBACK_SUMMARY_START = (
    "Participants requested or discussed topics matching a coherent theme. "
    "This cluster differed from nearby groups by emphasizing: "
)

INSTRUCTIONS = (
    "Label one group of a clustering.\n\n"
    "Output exactly two lines:\n"
    "<summary> what the members share, as two sentences </summary>\n"
    "<name> a label for a list of groups </name>\n\n"
    "The label has to hold for the first list below, the members, and to fail for the "
    "second, rows of other groups. Prefer the concrete topic over the broad "
    "field. The label also meets these criteria:\n"
)
CLOSING = "\n\nNow output the two lines."


def cluster_prompt(
    answers: Column, contrastive: Column, criteria: str = DEFAULT_CRITERIA
) -> Column:
    """The naming prompt from arrays of inside and outside statements."""
    return F.concat(
        F.lit(f"{INSTRUCTIONS}<criteria>\n{criteria}\n</criteria>\n\nThe statements:\n<answers>\n"),
        text.statement_block(answers),
        F.lit(
            "\n</answers>\n\nStatements from nearby groups that do NOT belong to this one:\n"
            "<contrastive_answers>\n"
        ),
        text.statement_block(contrastive),
        F.lit(f"\n</contrastive_answers>{CLOSING}"),
    )


def top_tokens(statements: DataFrame, n: int = FALLBACK_TOKENS) -> DataFrame:
    """``(cluster_id, token, count, rank)`` of ``(cluster_id, rank, text)`` rows.

    Equal counts go to the token that occurs first: in the row of lower rank,
    then at the earlier place in its text.
    """
    require_columns(statements, "cluster_id", "rank", "text")
    # Stop words are left out after the explode, and the outer form keeps the
    # optimiser from splitting each text a second time to look for empty lists.
    words = statements.select(
        "cluster_id",
        F.col("rank").alias("row_rank"),
        F.posexplode_outer(text.words(F.col("text"))).alias("place", "token"),
    ).where(F.col("token").isNotNull() & ~F.col("token").isin(*text.STOP_WORDS))
    # Rank and place as one number: a struct would turn the hash aggregation
    # into one that sorts all words.
    wide = "bigint" if isinstance(statements.schema["rank"].dataType, T.IntegerType) else "decimal(28,0)"
    first = F.col("row_rank").cast(wide) * F.lit(2**31) + F.col("place")
    counts = words.groupBy("cluster_id", "token").agg(
        F.count("*").alias("count"), F.min(first).alias("first")
    )
    order = [F.desc("count"), F.asc("first"), F.asc("token")]
    return top_n_per_group(counts, "cluster_id", order, n).drop("first")


def fallback_names(statements: DataFrame) -> DataFrame:
    """``(cluster_id, summary, name)`` from token counts.

    ``statements`` holds ``(cluster_id, rank, text)``.  A cluster whose texts
    have no tokens gets the fixed parts alone.
    """
    best = top_tokens(statements)
    ranked = F.array_sort(F.collect_list(F.struct("rank", "token")))
    lists = best.groupBy("cluster_id").agg(F.transform(ranked, lambda s: s["token"]).alias("tokens"))
    every = statements.select("cluster_id").distinct()
    joined = every.join(lists, "cluster_id", "left")
    found = F.coalesce("tokens", F.array().cast("array<string>"))
    return joined.select(
        "cluster_id", fallback_summary(found).alias("summary"), fallback_name(found).alias("name")
    )


def fallback_name(found: Column) -> Column:
    words = F.transform(F.slice(found, 1, FALLBACK_NAME_TOKENS), lambda w: F.initcap(w))
    joined = F.concat_ws(" ", F.lit(FALLBACK_NAME_START), words)
    return F.substring(joined, 1, FALLBACK_NAME_LENGTH)


def fallback_summary(found: Column) -> Column:
    return F.concat(F.lit(FALLBACK_SUMMARY_START), F.array_join(found, ", "))


def name_bundles(
    bundles: DataFrame,
    completer_factory: Callable[[], Completer],
    criteria: str | None = None,
    max_tasks: int | None = None,
    calls_in_flight: int = 1,
) -> DataFrame:
    """Name clusters from their example bundles.

    Adds ``summary, name, prompt, raw`` and ``error``.  The token-count name is
    used where the call failed or an answer lacks one of the tags.
    """
    require_columns(bundles, "cluster_id", "in_texts", "out_texts")
    prompts = bundles.withColumn(
        "prompt",
        cluster_prompt(
            F.col("in_texts"),
            F.col("out_texts"),
            DEFAULT_CRITERIA if criteria is None else criteria,
        ),
    )
    asked = prompts.select("cluster_id", F.col("prompt").alias("question"))
    # Few rows with a costly call each: they are spread over all tasks.  Stored,
    # so that the answers are not asked for again by later readers.
    tasks = max_tasks or asked.sparkSession.sparkContext.defaultParallelism
    answers = stored(complete(asked, "question", completer_factory, tasks, calls_in_flight))
    statements = bundles.select(
        "cluster_id", F.posexplode("in_texts").alias("rank", "text")
    )
    fallback = fallback_names(statements).withColumnsRenamed(
        {"summary": "own_summary", "name": "own_name"}
    )
    summary = text.tag_text(F.col("raw"), "summary")
    name = text.tag_text(F.col("raw"), "name")
    complete_answer = (summary != "") & (name != "")
    no_tokens = F.array().cast("array<string>")
    return (
        prompts.join(answers, "cluster_id")
        .join(fallback, "cluster_id", "left")
        .withColumn(
            "_summary",
            F.when(complete_answer, summary).otherwise(
                F.coalesce("own_summary", fallback_summary(no_tokens))
            ),
        )
        .withColumn(
            "_name",
            F.when(complete_answer, name).otherwise(
                F.coalesce("own_name", fallback_name(no_tokens))
            ),
        )
        .drop("own_summary", "own_name")
        .withColumnsRenamed({"_summary": "summary", "_name": "name"})
    )


def name_clusters(
    df: DataFrame,
    completer_factory: Callable[[], Completer],
    params: NamingParams | None = None,
    criteria: str | None = None,
    id_col: str = "id",
    vector_col: str = "embedding",
    cluster_ids: Sequence[int] | None = None,
    max_tasks: int | None = None,
    calls_in_flight: int = 1,
) -> DataFrame:
    """Name all clusters, or those in ``cluster_ids``, in one plan.

    One row per cluster: ``cluster_id, summary, name``, the sample sizes, the
    prompt and the raw answer.  ``select("cluster_id", "summary", "name")`` is
    the table to join back; ``audit_table`` the record of what was asked.
    """
    bundles = stored(example_bundles(df, params, id_col, vector_col, cluster_ids))
    named = name_bundles(bundles, completer_factory, criteria, max_tasks, calls_in_flight)
    return named.select(
        "cluster_id",
        "summary",
        "name",
        "in_sample_size",
        "out_sample_size",
        "prompt",
        "raw",
        "error",
    )


def audit_table(named: DataFrame) -> DataFrame:
    """What was asked and answered per cluster, with a file name for each.

    Without an answer, the tags are made from the summary and name in use.
    """
    made = F.concat(
        F.lit("<summary>"),
        F.col("summary"),
        F.lit("</summary>\n<name>"),
        F.col("name"),
        F.lit("</name>"),
    )
    return named.select(
        "cluster_id",
        "prompt",
        F.coalesce("raw", made).alias("raw_output"),
        F.format_string("cluster_%03d_prompt.txt", "cluster_id").alias("prompt_path"),
        F.format_string("cluster_%03d_output.txt", "cluster_id").alias("output_path"),
    )


def attach_names(
    rows: DataFrame, names: DataFrame, cluster_col: str = "cluster_id", bound: int | None = None
) -> DataFrame:
    """Left join of rows to cluster names; rows without a name keep nulls."""
    require_columns(rows, cluster_col)
    names = names.select(F.col("cluster_id").alias(cluster_col), "summary", "name")
    return join_small(rows, names, cluster_col, "left", bound=bound)
