"""Raw conversation records to one XML document per conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkatlas.checks import require_columns
from talkatlas.functions import text


def add_turns(raw: DataFrame, encoded_col: str = "encoded_content") -> DataFrame:
    """Add ``turns``, decoded from the base64 JSON column."""
    require_columns(raw, encoded_col)
    return raw.withColumn("turns", text.decode_turns(F.col(encoded_col)))


def add_xml(
    df: DataFrame,
    id_col: str = "id",
    timestamp_col: str = "created_dttm",
    title_col: str | None = "title",
) -> DataFrame:
    """Add ``conversation_xml`` to a table with ``turns``."""
    require_columns(df, id_col, timestamp_col, "turns", *([title_col] if title_col else []))
    title = F.col(title_col).cast("string") if title_col else None
    xml = text.conversation_xml(F.col(id_col), F.col(timestamp_col), title, F.col("turns"))
    return df.withColumn("conversation_xml", xml)


def conversation_documents(raw: DataFrame, title_col: str | None = "title") -> DataFrame:
    """``(id, conversation_xml)`` of raw records; narrow, one plan."""
    return add_xml(add_turns(raw), title_col=title_col).select(
        F.col("id").cast("string").alias("id"), "conversation_xml"
    )


def first_rows(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """The first ``n`` rows by key; a table has no order of its own in Spark."""
    return df.orderBy(key).limit(n)
