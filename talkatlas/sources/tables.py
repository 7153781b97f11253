"""Readers and writers of the stage tables.

Parquet is the default.  CSV is quoted so that texts with line breaks, commas
and quotes survive, and is always read with an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas import schemas
from talkatlas.checks import require_columns
from talkatlas.operators.naming import audit_table
from talkatlas.runtime import qualified, stored
from talkatlas.sources.text_files import TextFiles

_CSV = {"header": "true", "quote": '"', "escape": '"'}
# Texts keep their outer spaces; by default the writer trims them.
_CSV_WRITE = {
    **_CSV,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
}
_CSV_READ = {**_CSV, "enforceSchema": "false"}
# In this order; undone in reverse.  A backslash then stands only before one of the letters.
_LINE_ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def _on_strings(df: DataFrame, pairs) -> DataFrame:
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            for old, new in pairs:
                column = F.replace(column, F.lit(old), F.lit(new))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def read_csv(spark: SparkSession, path: str, schema: str, one_line: bool = True) -> DataFrame:
    """A CSV table with a header; an empty field is null.

    ``write_csv`` puts every row on one line, so that large files are read by
    many tasks.  In a file of another tool a quoted text can hold line breaks;
    without ``one_line`` it is read as it is, and each file is one task.
    """
    reader = spark.read.schema(schema).options(**_CSV_READ, multiLine=str(not one_line).lower())
    rows = reader.csv(path)
    return _on_strings(rows, [(new, old) for old, new in reversed(_LINE_ESCAPES)]) if one_line else rows


def write_csv(df: DataFrame, path: str, one_line: bool = True) -> None:
    """CSV with a header; ``one_line`` writes line breaks as ``\\n`` and ``\\r``, backslashes as ``\\s``."""
    rows = _on_strings(df, _LINE_ESCAPES) if one_line else df
    rows.write.mode("overwrite").options(**_CSV_WRITE).csv(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Store a stage as parquet and return the stored table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_raw_conversations(spark: SparkSession, path: str, one_line: bool = False) -> DataFrame:
    """The raw records: a CSV with base64 content."""
    return read_csv(spark, path, schemas.RAW_CONVERSATIONS, one_line)


def read_conversation_xml_csv(spark: SparkSession, path: str, one_line: bool = True) -> DataFrame:
    return read_csv(spark, path, schemas.CONVERSATION_XML, one_line)


def read_facets_csv(spark: SparkSession, path: str, one_line: bool = True) -> DataFrame:
    return read_csv(spark, path, schemas.FACETS, one_line)


def read_named_rows_csv(spark: SparkSession, path: str, one_line: bool = True) -> DataFrame:
    return read_csv(spark, path, schemas.NAMED_ROWS, one_line)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.EMBEDDINGS)


def write_cluster_names(names: DataFrame, csv_path: str, json_path: str) -> None:
    """The name table as CSV and as JSON lines."""
    require_columns(names, "cluster_id", "summary", "name")
    # Stored first, so that the names are worked out once for both files.
    table = stored(names.select("cluster_id", "summary", "name"))
    write_csv(table, csv_path)
    table.write.mode("overwrite").option("ignoreNullFields", "false").json(json_path)


def read_cluster_names(spark: SparkSession, json_path: str) -> DataFrame:
    return spark.read.schema(schemas.CLUSTER_NAMES).json(json_path)


def read_cluster_names_csv(spark: SparkSession, csv_path: str) -> DataFrame:
    return read_csv(spark, csv_path, schemas.CLUSTER_NAMES)


def write_audit_texts(named: DataFrame, path: str) -> None:
    """Prompt and answer of each cluster, each as a text file of the agreed name."""
    audit = audit_table(named)
    files = audit.select(
        F.explode(
            F.array(
                F.struct(F.col("prompt_path").alias("file"), F.col("prompt").alias("value")),
                F.struct(F.col("output_path").alias("file"), F.col("raw_output").alias("value")),
            )
        ).alias("f")
    ).select("f.file", "f.value")
    spark = named.sparkSession
    spark.dataSource.register(TextFiles)
    files.write.format("text_files").mode("append").save(qualified(spark, path))


def write_hierarchy(document: DataFrame, path: str) -> None:
    """The hierarchy document as nested JSON."""
    document.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_hierarchy(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.HIERARCHY).json(path)
