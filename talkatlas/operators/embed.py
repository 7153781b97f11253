"""Distributed embedding of one text column."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import IDF, CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.checks import require_columns
from talkatlas.functions.vectors import list_column, unit_rows

Encoder = Callable[[Sequence[str]], np.ndarray]
# Texts that an encoder gets at once.
ENCODED_ROWS = 256


class _Buckets(dict):
    """Token to bucket; a token is hashed when it is first seen."""

    def __init__(self, dim: int) -> None:
        super().__init__()
        self.dim = dim

    def __missing__(self, token: str) -> int:
        digest = hashlib.md5(token.encode()).hexdigest()
        self[token] = place = int(digest[:8], 16) % self.dim
        return place

    def forget_if_large(self) -> None:
        if len(self) > 1_000_000:
            self.clear()


def hashing_encoder(dim: int = 64) -> Callable[[], Encoder]:
    """Factory of a model-free encoder: hashed token counts of length one.

    A stand-in where no pretrained encoder is at hand: it knows shared words,
    not meaning.  Texts without tokens give the zero vector.
    """

    def factory() -> Encoder:
        word = re.compile("[a-z0-9]+")
        buckets = _Buckets(dim)

        def encode(texts: Sequence[str]) -> np.ndarray:
            found = [word.findall(content.lower()) for content in texts]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            places = np.fromiter(map(buckets.__getitem__, chain.from_iterable(found)), np.int64, lengths.sum())
            places += np.repeat(np.arange(len(texts)) * dim, lengths)
            buckets.forget_if_large()
            return unit_rows(np.bincount(places, minlength=len(texts) * dim).reshape(-1, dim).astype(np.float64))

        return encode

    return factory


def embed(
    df: DataFrame,
    encoder_factory: Callable[[], Encoder],
    text_col: str = "request",
    id_col: str = "id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(id, embedding)`` of one text column; a missing text counts as empty.

    Columns in ``keep`` come along, so that no join is needed to put them back.

    ``encoder_factory`` runs once per task, so a model is loaded once and then
    used batch by batch.  The encoder gets a list of texts and returns a matrix.
    """
    require_columns(df, text_col, id_col)
    schema = T.StructType(
        [
            df.schema[id_col],
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            *(df.schema[c] for c in keep),
        ]
    )

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_factory()
        for batch in batches:
            for start in range(0, batch.num_rows, ENCODED_ROWS):
                part = batch.slice(start, ENCODED_ROWS)
                vectors = np.asarray(encode(part.column(1).to_pylist()))
                columns = [part.column(0), list_column(vectors, pa.float32()), *part.columns[2:]]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")
    texts = df.select(id_col, text, *keep)
    return texts.mapInArrow(encode_all, schema)


def fit_idf_encoder(df: DataFrame, dim: int = 64, text_col: str = "request") -> Callable[[DataFrame], DataFrame]:
    """Fit an encoder that weighs tokens by how few rows hold them; no Python worker is used.

    Tokens fall into the buckets of ``hashing_encoder``.  A bucket's count is
    multiplied by ``ln((rows + 1) / (rows with it + 1))`` over ``df``, and the
    vector is scaled to length one.  The result adds ``embedding`` to any table
    with ``text_col``; a missing text counts as empty and gives the zero vector.
    """
    require_columns(df, text_col)
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], inputCol="_buckets", outputCol="_counts")

    def counted(rows: DataFrame) -> DataFrame:
        text = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        tokens = F.regexp_extract_all(text, F.lit("([a-z0-9]+)"), F.lit(1))
        number = lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long")
        buckets = F.transform(tokens, lambda t: F.pmod(number(t), F.lit(dim)).cast("string"))
        return counter.transform(rows.withColumn("_buckets", buckets))

    model = IDF(inputCol="_counts", outputCol="_weighed").fit(counted(df.select(text_col)))
    scale = Normalizer(p=2.0, inputCol="_weighed", outputCol="_unit")

    def encode(rows: DataFrame) -> DataFrame:
        encoded = scale.transform(model.transform(counted(rows)))
        return encoded.withColumn("embedding", vector_to_array("_unit", "float32")).drop("_buckets", "_counts", "_weighed", "_unit")

    return encode
