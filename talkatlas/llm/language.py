"""Language identification by interpolated Kneser-Ney models over characters."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.llm.columns import mix, slices
from talkatlas.runtime import join_small, stored

ORDER = 4
# Labelled rows per language that are read to count n-grams, and to set the limit
# of rejection.  Rows are drawn by a hash of their id, so the bound holds on average.
TRAINING_ROWS = 20_000
CALIBRATION_ROWS = 5_000
# The driver and a task hold one block of languages at a time, of about as many languages
# and entries of sorted arrays at most; each further block is a further pass over the texts.
BLOCK_LANGUAGES = 256
BLOCK_ENTRIES = 8_000_000
# A text is rejected this many times farther from its language than one row in a thousand is.
REJECTION_MARGIN = 2.0
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_START, _END = "\x00", "\x01"
_CACHED_WORDS = 300_000
_CACHED_SCORES = 16_000_000


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    found = _LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def _keys(grams: np.ndarray) -> np.ndarray:
    """A hash per row of symbols."""
    key = np.full(len(grams), grams.shape[1] + 1, np.uint64)
    for i in range(grams.shape[1]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + grams[:, i].astype(np.uint64))
    return key


def _summed(keys: np.ndarray, *values: np.ndarray):
    """Distinct keys in order, where each first stands, and sums of the values."""
    known, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return known, first, *(np.bincount(inverse, v, len(known)) for v in values)


def _find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among the sorted known ones, and its place."""
    place = np.searchsorted(known, keys)
    place[place == len(known)] = 0
    return known[place] == keys, place


class SortedTable:
    """Values by hash, found by binary search in the sorted hashes."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is known, and its place."""
        return _find(self.keys, keys)


class _Counts:
    """Kneser-Ney counts of one language, from its n-grams of the highest order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int) -> None:
        self.alphabet, self.orders = alphabet, {}
        for size in range(grams.shape[1], 0, -1):
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            discount = ones / (ones + 2 * twos) if ones else 0.1
            known, _, total, types = _summed(_keys(grams[:, :-1]), counts, np.ones(len(counts)))
            contexts = SortedTable(known, np.stack([total, types], axis=1))
            self.orders[size] = float(discount), SortedTable(_keys(grams), counts), contexts
            # Below the highest order, a gram counts the different symbols before it.
            _, first, counts = _summed(_keys(grams[:, 1:]), np.ones(len(counts)))
            grams = grams[first, 1:]

    def backoff(self, contexts: np.ndarray) -> np.ndarray:
        """The weight of the next lower order after these contexts; one after unseen ones."""
        discount, _, table = self.orders[contexts.shape[1] + 1]
        known, place = table.find(_keys(contexts))
        total, types = table.values[place].T
        return np.where(known, discount * types / total, 1.0)

    def probability(self, grams: np.ndarray) -> np.ndarray:
        if not grams.shape[1]:
            return np.full(len(grams), 1.0 / self.alphabet)
        discount, table, contexts = self.orders[grams.shape[1]]
        known, place = table.find(_keys(grams))
        count = np.where(known, np.maximum(table.values[place] - discount, 0), 0)
        known, place = contexts.find(_keys(grams[:, :-1]))
        total = np.where(known, contexts.values[place, 0], 1)
        return count / total + self.backoff(grams[:, :-1]) * self.probability(grams[:, 1:])


def sorted_arrays(grams: np.ndarray, counts: np.ndarray, alphabet: int) -> list[np.ndarray]:
    """The model of one language, from its n-grams of the highest order and their counts.

    For each order, from 1 on: hashes of the n-grams, their log-probabilities,
    hashes of the contexts, and the log-weights of the order below after them.
    """
    counted, arrays = _Counts(grams, counts.astype(np.float64), alphabet), []
    while grams.shape[1]:
        of_order = []
        for part, values in ((grams, counted.probability), (grams[:, :-1], counted.backoff)):
            keys, first = np.unique(_keys(part), return_index=True)
            of_order += [keys, np.log(values(part[first])).astype(np.float32)]
        arrays = of_order + arrays
        grams = grams[np.unique(_keys(grams), return_index=True)[1], 1:]
    return arrays


@dataclass
class LanguageModel:
    """The models of a block of languages; a language has entries for what was seen in it only."""

    languages: list[str]
    alphabet: int
    # Per language, the arrays of ``sorted_arrays``.
    arrays: list[list[np.ndarray]]
    # Per language: mean cross-entropy, spread between texts, spread per symbol, limit.
    limits: np.ndarray | None = None

    @property
    def order(self) -> int:
        return len(self.arrays[0]) // 4

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word, with its end, in each language."""
        grams, lengths = word_grams(words, self.order)
        # Words share most n-grams, and each is looked up once.
        _, first, inverse = np.unique(_keys(grams), return_index=True, return_inverse=True)
        grams, starts = grams[first], np.cumsum(lengths) - lengths
        tails = [grams[:, self.order - size :] for size in range(1, self.order + 1)]
        keys = [(_keys(tail), _keys(tail[:, :-1])) for tail in tails]
        scores = np.empty((len(words), len(self.languages)), np.float32)
        for i, arrays in enumerate(self.arrays):
            found = np.full(len(grams), -np.log(self.alphabet), np.float32)
            for size, (whole, before) in enumerate(keys):
                gram, value, context, weight = arrays[4 * size : 4 * size + 4]
                known, place = _find(context, before)
                found = found + np.where(known, weight[place], 0)
                known, place = _find(gram, whole)
                found = np.where(known, value[place], found)
            scores[:, i] = np.add.reduceat(found[inverse], starts)
        return scores

    def scorer(self):
        """A function from texts to log-probabilities per language and numbers of symbols."""
        ids: dict[str, int] = {}
        table = np.zeros((0, len(self.languages)), np.float32)

        def score(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            nonlocal table
            if len(ids) > min(_CACHED_WORDS, _CACHED_SCORES // len(self.languages)):
                ids.clear()
                table = table[:0]
            found = [words_of(t) for t in texts]
            fresh = list({w: None for words in found for w in words if w not in ids})
            if fresh:
                ids.update(zip(fresh, range(len(ids), len(ids) + len(fresh)), strict=True))
                table = np.concatenate([table, self.word_scores(fresh)])
            sums = np.zeros((len(texts), len(self.languages)))
            sizes = np.zeros(len(texts), np.int64)
            for i, words in enumerate(found):
                if words:
                    sums[i] = table[[ids[w] for w in words]].sum(axis=0, dtype=np.float64)
                    sizes[i] = sum(map(len, words)) + len(words)
            return sums, sizes

        return score


def word_grams(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the words, each padded at its start and closed by an end; and how many per word."""
    pad = _START * (order - 1)
    text = "".join([f"{pad}{w}{_END}" for w in words])
    symbols = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(symbols != 0)
    grams = np.stack([symbols[ends - i] for i in range(order - 1, -1, -1)], axis=1)
    return grams, np.fromiter(map(len, words), np.int64, len(words)) + 1


def split_of(doc_id: Column) -> Column:
    """The fold of a row: 1 is held out, 0 is for counting, 2 for calibration."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def _drawn(rows: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of each language, drawn by a hash of their id; ``sizes(lang, count)``."""
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return join_small(rows, sizes, "lang", "inner").where(draw * F.col("count") < most).drop("count")


def _gram_counts(rows: DataFrame, order: int) -> DataFrame:
    """``lang, gram, n``: how often each n-gram occurs."""

    def run(batches):
        seen: dict[str, Counter] = {}

        def flush(name: str) -> pa.RecordBatch:
            words, counts = zip(*seen.pop(name).items(), strict=True)
            grams, lengths = word_grams(list(words), order)
            weights = np.repeat(np.array(counts), lengths)
            _, first, total = _summed(_keys(grams), weights)
            data = np.ascontiguousarray(grams[first]).view(np.uint8).reshape(-1, 4 * order)
            gram = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * order), len(first), [None, pa.py_buffer(data.tobytes())])
            names = pa.array([name] * len(first))
            return pa.RecordBatch.from_arrays(
                [names, gram.cast(pa.binary()), pa.array(total.astype(np.int64))], ["lang", "gram", "n"]
            )

        for part in slices(batches, "text"):
            columns = (part.column(c).to_pylist() for c in ("lang", "text"))
            for name, text in zip(*columns, strict=True):
                seen.setdefault(name, Counter()).update(words_of(text or ""))
            for name in [k for k, v in seen.items() if len(v) > _CACHED_WORDS]:
                yield flush(name)
        for name in [k for k, v in seen.items() if v]:
            yield flush(name)

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, gram binary, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _language_arrays(counts: DataFrame, order: int, alphabet: int) -> DataFrame:
    """``lang, entries, arrays`` from ``lang, gram, n``: one row per language, made in its own task.

    The n-grams of one language are those of a bounded number of rows.
    """

    def run(table: pa.Table) -> pa.Table:
        grams = np.frombuffer(b"".join(table.column("gram").to_pylist()), np.uint32).reshape(-1, order)
        arrays = sorted_arrays(grams, table.column("n").to_numpy(), alphabet)
        found = {"lang": [table.column("lang")[0].as_py()], "entries": [sum(map(len, arrays)) // 2]}
        return pa.table(found | {"arrays": pa.array([[a.tobytes() for a in arrays]], pa.list_(pa.binary()))})

    return counts.groupBy("lang").applyInArrow(run, "lang string, entries long, arrays array<binary>")


def fit(
    docs: DataFrame,
    order: int = ORDER,
    training_rows: int = TRAINING_ROWS,
    calibration_rows: int = CALIBRATION_ROWS,
    block_languages: int = BLOCK_LANGUAGES,
    block_entries: int = BLOCK_ENTRIES,
) -> Iterator[LanguageModel]:
    """Models of the languages in ``docs(doc_id, text, lang)``, held-out rows left aside.

    Languages come in blocks by the hash of their name, most often in a single
    one.  None come if no labelled row of the fold for counting has a letter.
    """
    rows = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where("lang IS NOT NULL AND doc_id IS NOT NULL")
    fold = split_of(F.col("doc_id"))
    sizes = stored(rows.groupBy("lang").agg(F.count_if(fold == 0).alias("train"), F.count_if(fold == 2).alias("check")))
    drawn = _drawn(rows.where(fold == 0), sizes.select("lang", F.col("train").alias("count")), training_rows)
    counts = stored(_gram_counts(drawn, order))
    # The last symbols of the n-grams are all symbols there are; one more stands for all others.
    alphabet = counts.select(F.substring("gram", 4 * order - 3, 4)).distinct().count() + 1
    tables = stored(_language_arrays(counts, order, alphabet))
    languages, entries = tables.agg(F.count("*"), F.coalesce(F.sum("entries"), F.lit(0))).first()
    blocks = max(-(-languages // block_languages), -(-entries // block_entries))
    for block in range(blocks):
        held = tables.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == block).orderBy("lang").toArrow()
        if not len(held):
            continue
        kinds = np.uint64, np.float32
        arrays = [[np.frombuffer(a, kinds[i % 2]) for i, a in enumerate(one)] for one in held.column("arrays").to_pylist()]
        model = LanguageModel(held.column("lang").to_pylist(), alphabet, arrays)
        known = rows.where((fold == 2) & F.col("lang").isin(model.languages))
        drawn = _drawn(known, sizes.select("lang", F.col("check").alias("count")), calibration_rows)
        model.limits = _calibrated(drawn, model)
        yield model


def _calibrated(rows: DataFrame, model: LanguageModel) -> np.ndarray:
    """Limits of rejection, from the cross-entropy of labelled rows in their own language.

    The distance of a text of ``n`` symbols from the mean is measured in
    ``spread + noise / sqrt(n)``: short texts stray more.
    """
    own = F.array_position(F.lit(model.languages), F.col("lang")).cast("int") - 1
    scored = _scored(rows.select("lang", "text"), model).select("lang", "n", F.col("entropies")[own].alias("h")).where("n > 0")
    mean = scored.groupBy("lang").agg(F.median("h").alias("mean"))
    apart = scored.join(F.broadcast(mean), "lang").withColumn("away", F.abs(F.col("h") - F.col("mean")))
    spread = apart.groupBy("lang", "mean").agg(
        F.median("away").alias("spread"), F.median(F.col("away") * F.sqrt("n")).alias("noise")
    )
    z = F.col("away") / (F.col("spread") + F.col("noise") / F.sqrt("n") + 1e-9)
    limits = apart.join(F.broadcast(spread), ["lang", "mean"]).groupBy("lang", "mean", "spread", "noise")
    found = {r["lang"]: r for r in limits.agg(F.percentile(z, F.lit(0.999)).alias("limit")).collect()}
    out = np.array([[0.0, 0.0, 0.0, np.inf]] * len(model.languages))
    for i, name in enumerate(model.languages):
        if name in found:
            r = found[name]
            out[i] = r["mean"], r["spread"], r["noise"], REJECTION_MARGIN * max(r["limit"], 4.0)
    return out


def _scored(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """``rows`` with ``n, entropies``: symbols of ``text``, and nats per symbol in each language."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [*rows.columns, "n", "entropies"]

    def run(batches):
        score = shared.value.scorer()
        for part in slices(batches, "text"):
            sums, sizes = score([t or "" for t in part.column("text").to_pylist()])
            entropy = -sums / np.maximum(sizes, 1)[:, None]
            offsets = np.arange(len(part) + 1, dtype=np.int32) * entropy.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(entropy.ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sizes), lists], names)

    fields = [T.StructField("n", T.LongType()), T.StructField("entropies", T.ArrayType(T.DoubleType()))]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *fields]))


def _best_of(model: LanguageModel) -> Column:
    """``h, name, share, far``: the best language of the block for a scored row.

    ``share`` sums the likelihoods of the block in terms of the best one.
    """
    least = F.array_min("entropies")
    place = F.array_position("entropies", least).cast("int")
    share = F.aggregate("entropies", F.lit(0.0), lambda s, h: s + F.exp((least - h) * F.col("n")))
    limit = F.element_at(F.lit(model.limits.tolist()), place)
    away = (least - limit[0]) / (limit[1] + limit[2] / F.sqrt(F.greatest("n", F.lit(1))) + F.lit(1e-9))
    name = F.element_at(F.lit(model.languages), place)
    return F.struct(least.alias("h"), name.alias("name"), share.alias("share"), (away > limit[3]).alias("far"))


def _better_of(a: str, b: str) -> Column:
    """The better of two results of ``_best_of``, with the likelihoods of both."""
    first = F.struct(F.col(f"{a}.h"), F.col(f"{a}.name")) <= F.struct(F.col(f"{b}.h"), F.col(f"{b}.name"))
    least = F.least(f"{a}.h", f"{b}.h")
    share = sum(F.col(f"{c}.share") * F.exp((least - F.col(f"{c}.h")) * F.col("n")) for c in (a, b))
    name, far = (F.when(first, F.col(f"{a}.{c}")).otherwise(F.col(f"{b}.{c}")) for c in ("name", "far"))
    return F.struct(least.alias("h"), name.alias("name"), share.alias("share"), far.alias("far"))


def predict(rows: DataFrame, models: Iterable[LanguageModel]) -> DataFrame:
    """``row, text, lang_pred, score, rejected`` for ``row, text``.

    The language of the lowest cross-entropy per symbol, ties by name; ``score``
    is its share of the likelihood of all languages.  A text is ``rejected``
    when it lies beyond the calibrated limit of its language.  Null texts and
    texts without a letter are ``und``, with score 0, and rejected.
    """
    so_far = None
    for model in models:
        # All blocks but the last are worked out at once, so that a task holds one block.
        scored = _scored(rows.select("row", "text") if so_far is None else stored(so_far).drop("n"), model)
        best = scored.withColumn("best", _best_of(model)).drop("entropies")
        so_far = best if "before" not in best.columns else best.withColumn("best", _better_of("before", "best")).drop("before")
        so_far = so_far.withColumnRenamed("best", "before")
    if so_far is None:
        unknown = F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
        return rows.select("row", "text", *unknown)
    found = F.col("n") > 0
    return so_far.select(
        "row",
        "text",
        F.when(found, F.col("before.name")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(found, 1 / F.col("before.share")).otherwise(0.0).alias("score"),
        F.when(found, F.col("before.far")).otherwise(True).alias("rejected"),
    )


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row of ``docs(doc_id, text, lang)``.

    Rows with null ``lang`` or ``doc_id`` teach nothing but are predicted; a
    null id is not held out.  Repeated rows are predicted alike.  Other columns
    are not read.  With no labelled row at all everything is ``und``.
    """
    rows = docs.select(F.struct(F.col("doc_id")).alias("row"), F.col("text").cast("string").alias("text"))
    held_out = F.coalesce(split_of(F.col("row.doc_id")) == 1, F.lit(False)).alias("held_out")
    return predict(rows, fit(docs)).select("row.doc_id", held_out, "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that identification rejects."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    return predict(rows, fit(docs)).where("NOT rejected").select("row.*")
