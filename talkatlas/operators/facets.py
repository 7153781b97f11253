"""Four facets per conversation, from one prompt or from four."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.checks import require_columns
from talkatlas.functions import text
from talkatlas.operators.complete import Completer, complete, complete_logged


@dataclass(frozen=True)
class FacetSpec:
    """A facet: its tag, its question and how the answer should look."""

    key: str
    question: str
    opening: str = ""
    with_examples: bool = False
    rule: str = ""


# The tags, their order and the two openings, which the results
# build on.  The wording is free.
FACET_SPECS = (
    FacetSpec(
        "request",
        "What does the user want from the assistant overall?",
        "The user's overall request for the assistant is to",
        True,
        "At most two sentences.",
    ),
    FacetSpec(
        "language",
        "Which human languages are mainly used in the conversation? Leave out "
        "programming languages and write no language codes.",
        rule="Full language names only, for instance Swedish or Korean.",
    ),
    FacetSpec(
        "task",
        "Which task is the assistant asked to carry out?",
        "The task is to",
        True,
        "At most two sentences.",
    ),
    FacetSpec(
        "concerning",
        "How harmful or worrying is the conversation, from 1 (harmless) to 5 "
        "(very worrying)?",
        rule="One number from 1 to 5.",
    ),
)
FACET_KEYS = tuple(spec.key for spec in FACET_SPECS)

_PRIVACY = (
    "Replace anything that could point to a person or a place by a general word. "
    "Report what was said, without judging it."
)
SHOWN = "Below is a conversation between a user and an AI assistant.\n\n"
_EXAMPLES = (
    "<examples>\n"
    "compare two phone contracts and say which is cheaper over a year\n"
    "find out why a unit test passes alone but fails in the suite\n"
    "</examples>\n\n"
)


def _batched_instructions() -> str:
    lines = [
        "\n\nAnswer four questions about this conversation.",
        _PRIVACY,
        "Write exactly these four tags, in this order, and nothing else:",
    ]
    for spec in FACET_SPECS:
        lines.append(f"<{spec.key}> {spec.question} {spec.rule} </{spec.key}>")
        if spec.opening:
            lines.append(f'(Begin the {spec.key} with "{spec.opening}".)')
    return "\n".join(lines)


BATCHED_TAIL = _batched_instructions()


def facet_tail(spec: FacetSpec) -> str:
    """What follows the conversation; the question stands before and after the rules."""
    question = f"<question> {spec.question} </question>"
    opening = f' Begin with "{spec.opening}".' if spec.opening else ""
    return (
        f"\n\nYour task is to answer {question} about this conversation. {_PRIVACY}\n\n"
        + (_EXAMPLES if spec.with_examples else "")
        + f"What is your answer to {question}? {spec.rule}{opening} "
        "Write only the answer, in English, as <answer> ... </answer>."
    )


def batched_prompt(conversation: Column) -> Column:
    """One prompt that asks for all four facets."""
    return F.concat(F.lit(SHOWN), conversation, F.lit(BATCHED_TAIL))


def facet_prompt(conversation: Column, spec: FacetSpec) -> Column:
    """The prompt for a single facet."""
    return F.concat(F.lit(SHOWN), conversation, F.lit(facet_tail(spec)))


def parse_facets(answer: Column) -> list[Column]:
    """The four facet columns of a batched answer; the empty string where absent."""
    return [text.tag_text(answer, key).alias(key) for key in FACET_KEYS]


def extract_facets(
    df: DataFrame,
    completer_factory: Callable[[], Completer],
    max_tasks: int | None = None,
    calls_in_flight: int = 1,
    keep_error: bool = False,
    log_path: str | None = None,
) -> DataFrame:
    """``(id, request, language, task, concerning)`` with one call per row.

    With ``log_path`` the answers are kept there, and a run that is started
    again goes on where the one before ended.
    """
    require_columns(df, "id", "conversation_xml")
    prompts = df.select("id", batched_prompt(F.col("conversation_xml")).alias("prompt"))
    if log_path is None:
        answers = complete(prompts, "prompt", completer_factory, max_tasks, calls_in_flight)
    else:
        answers = complete_logged(prompts, "prompt", completer_factory, log_path, max_tasks, calls_in_flight)
    errors = ["error"] if keep_error else []
    return answers.select("id", *parse_facets(F.col("raw")), *errors)


def extract_facets_one_by_one(
    df: DataFrame,
    completer_factory: Callable[[], Completer],
    max_tasks: int | None = None,
    calls_in_flight: int = 1,
    keep_error: bool = False,
    log_path: str | None = None,
) -> DataFrame:
    """The same table with four calls per row, one per facet.

    With ``keep_error`` an array holds the error of each call, null where it went well.
    With ``log_path`` each answer is kept there, and a run that is started
    again asks only what is missing, also within a row.

    Without a log the four prompts of a row travel as one array, so no shuffle
    is needed to bring the answers back together.
    """
    require_columns(df, "id", "conversation_xml")
    conversation = F.col("conversation_xml")
    prompts = F.array(*[facet_prompt(conversation, spec) for spec in FACET_SPECS])
    asked = df.select("id", prompts.alias("prompts"))
    if log_path is None:
        answers = complete(asked, "prompts", completer_factory, max_tasks, calls_in_flight)
    else:
        answers = complete_logged(asked, "prompts", completer_factory, log_path, max_tasks, calls_in_flight)
    errors = [F.col("error").alias("errors")] if keep_error else []
    return answers.select(
        "id",
        *[
            text.tag_text(F.get("raw", F.lit(i)), "answer").alias(key)
            for i, key in enumerate(FACET_KEYS)
        ],
        *errors,
    )


def with_concern_score(facets: DataFrame) -> DataFrame:
    """Add ``concern_score``, the concern text as an integer from 1 to 5."""
    return facets.withColumn("concern_score", text.concern_score(F.col("concerning")))
