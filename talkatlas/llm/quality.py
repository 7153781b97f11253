"""Quality scores by a linear classifier on n-gram indicators scaled by naive Bayes ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.llm.columns import Powers, mix, slices, text_bytes, word_bounds, word_codes

# Labelled rows that are read, drawn by a hash of the id, so the bound holds on average.
TRAINING_ROWS = 10_000
# One row in so many sets the scale of the scores and is not trained on.
CALIBRATION_SHARE = 5
SLOT_BITS = 18
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
# How much of each weight stays, the rest being their mean size.
INTERPOLATION = 0.75
SEED = 5


def _shapes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Codes of word shapes: runs of small letters, capitals and digits become one sign each."""
    kind = np.arange(256, dtype=np.uint8)
    kind[ord("a") : ord("z") + 1] = kind[128:] = ord("a")
    kind[ord("A") : ord("Z") + 1] = ord("A")
    kind[ord("0") : ord("9") + 1] = ord("0")
    signs = kind[data]
    kept = np.ones(len(signs), bool)
    kept[1:] = signs[1:] != signs[:-1]
    kept[offsets[:-1][offsets[:-1] < len(signs)]] = True
    moved = np.concatenate([[0], np.cumsum(kept)])[offsets]
    starts, ends, rows = word_bounds(signs[kept], moved)
    return word_codes(signs[kept], starts, ends, powers), rows


def _grams(codes: np.ndarray, rows: np.ndarray, size: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` codes within a row, and their rows."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    if len(codes) < size:
        return codes[:0], row[:0]
    count = len(codes) - size + 1
    gram = np.full(count, salt, np.uint64)
    for i in range(size):
        gram = mix(gram * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + count])
    inside = row[:count] == row[size - 1 :]
    return gram[inside], row[:count][inside]


# Distances at which words are compared with themselves.
LAGS = (1, 2, 3, 4)


def _repeats(codes: np.ndarray, rows: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """One code per row for the share of words that return after ``lag`` words, in powers of two."""
    count = len(rows) - 1
    row = np.repeat(np.arange(count), np.diff(rows))
    if len(codes) <= lag:
        return codes[:0], row[:0]
    again = (codes[lag:] == codes[:-lag]) & (row[lag:] == row[:-lag])
    share = np.bincount(row[lag:], again, count) / np.maximum(np.diff(rows), 1)
    level = np.floor(np.log2(np.maximum(share, 2.0**-9))).astype(np.int64) + 9
    return mix((level + 100 * lag + 20_000).astype(np.uint64)), np.arange(count)


def slots(column: pa.Array, powers: Powers, bits: int = SLOT_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct slots of each text, row after row, and the offsets of the rows.

    Words and pairs of words, one to three word shapes in a row, and how many
    words return at short distances.
    """
    data, offsets = text_bytes(column)
    starts, ends, rows = word_bounds(data, offsets)
    words = word_codes(data, starts, ends, powers)
    shapes, shape_rows = _shapes(data, offsets, powers)
    found = [_grams(words, rows, n, n) for n in (1, 2)] + [_grams(shapes, shape_rows, n, 10 + n) for n in (1, 2, 3)]
    found += [_repeats(words, rows, lag) for lag in LAGS]
    keys = [(row << bits) | (gram >> np.uint64(64 - bits)).astype(np.int64) for gram, row in found]
    keys = np.unique(np.concatenate(keys))
    return keys & ((1 << bits) - 1), np.searchsorted(keys >> bits, np.arange(len(column) + 1))


@dataclass
class QualityModel:
    """Weight and squared scale per slot, and the line from margins to scores."""

    weights: np.ndarray
    squares: np.ndarray
    slope: float
    shift: float

    def margins(self, slot: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        # Row by row, so that a margin does not depend on the other texts of a slice.
        some = offsets[1:] > offsets[:-1]
        weight, square = np.zeros((2, len(some)))
        if some.any():
            weight[some], square[some] = (np.add.reduceat(v[slot], offsets[:-1][some]) for v in (self.weights, self.squares))
        return weight / np.sqrt(np.maximum(square, 1e-12))

    def scores(self, slot: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(-(self.slope * self.margins(slot, offsets) + self.shift), -500, 500)))


def log_ratios(rows: list[np.ndarray], label: np.ndarray, size: int) -> np.ndarray:
    """The naive Bayes log-count ratio of each slot, from how many texts of each class have it."""
    parts = []
    for side in (1, 0):
        chosen = [r for r, y in zip(rows, label, strict=True) if y == side]
        count = np.bincount(np.concatenate(chosen), minlength=size) + SMOOTHING
        parts.append(np.log(count / count.sum()))
    return parts[0] - parts[1]


def coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, cost: np.ndarray, size: int):
    """A hinge-loss linear model, by descent on one dual variable after the other."""
    weights = np.zeros(size)
    dual = np.zeros(len(rows))
    norms = np.array([v @ v for v in values])
    order = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            if norms[i]:
                slot, value = rows[i], values[i]
                step = dual[i] - (sign[i] * (weights[slot] @ value) - 1) / norms[i]
                step = min(max(step, 0.0), cost[i])
                if step != dual[i]:
                    weights[slot] += (step - dual[i]) * sign[i] * value
                    dual[i] = step
    return weights


def line(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the labels, by Newton's method."""
    ones = label.sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    found = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        found = found + np.clip(np.linalg.solve(hessian, x.T @ (target - p)), -5, 5)
    return float(max(found[0], 1e-3)), float(found[1])


def fitted(rows: list[np.ndarray], label: np.ndarray, held: np.ndarray, size: int) -> QualityModel:
    """A model of bounded rows.  With one class or none, every text gets the share of label 1."""
    train = ~held
    if len(set(label[train])) < 2:
        share = (label.sum() + 1) / (len(label) + 2)
        return QualityModel(np.zeros(size), np.zeros(size), 1.0, float(np.log(share / (1 - share))))
    chosen = [r for r, t in zip(rows, train, strict=True) if t]
    y = label[train]
    ratio = log_ratios(chosen, y, size)
    values = [ratio[r] / max(np.linalg.norm(ratio[r]), 1e-6) for r in chosen]
    # Both classes weigh the same in the training; the calibration restores their shares.
    cost = COST * len(y) / (2 * np.where(y == 1, y.sum(), len(y) - y.sum()))
    weights = coordinate_descent(chosen, values, np.where(y == 1, 1.0, -1.0), cost, size)
    used = np.abs(weights[weights != 0]).mean() if weights.any() else 0.0
    weights = INTERPOLATION * weights + (1 - INTERPOLATION) * used * (weights != 0)
    model = QualityModel(weights * ratio, ratio**2, 1.0, 0.0)
    check = held if len(set(label[held])) == 2 else train
    some = [r for r, c in zip(rows, check, strict=True) if c]
    margin = model.margins(np.concatenate(some), np.cumsum([0, *map(len, some)]))
    model.slope, model.shift = line(margin, label[check])
    return model


def split_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def fit(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS, bits: int = SLOT_BITS) -> QualityModel:
    """A model of the labelled rows that are not held out.

    A bounded sample of them is read, whole texts each, and fitted in one task.
    Ids with both labels, or a null one, teach nothing.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(split_of(F.col("doc_id")) != 1)
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    known = known.where("quality = other").drop("other")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rate = min(1.0, training_rows / max(known.count(), 1))
    # At most about training_rows pairs of numbers, so the table is small enough to broadcast.
    sample = known.where(draw < int(rate * (1 << 30)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(CALIBRATION_SHARE)) == 0).alias("held")
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "quality", held)

    def read(batches):
        powers = Powers()
        for part in slices(batches, "text"):
            slot, offsets = slots(part.column("text"), powers, bits)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(slot, pa.int32()))
            columns = [part.column(c) for c in ("doc_id", "quality", "held")]
            yield pa.RecordBatch.from_arrays([*columns, lists], ["doc_id", "quality", "held", "slots"])

    def train(batches):
        table = pa.Table.from_batches(list(batches), pa.schema(
            [("doc_id", pa.int64()), ("quality", pa.int32()), ("held", pa.bool_()), ("slots", pa.list_(pa.int32()))]
        ))
        table = table.sort_by("doc_id").combine_chunks()
        found = [np.asarray(s, np.int64) for s in table.column("slots").to_pylist()]
        model = fitted(found, table.column("quality").to_numpy(), table.column("held").to_numpy(), 1 << bits)
        values = [[model.weights.tobytes()], [model.squares.tobytes()], [model.slope], [model.shift]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["weights", "squares", "slope", "shift"])

    read_rows = rows.mapInArrow(read, "doc_id long, quality int, held boolean, slots array<int>")
    schema = "weights binary, squares binary, slope double, shift double"
    found = read_rows.repartition(1).mapInArrow(train, schema).first()
    return QualityModel(np.frombuffer(found["weights"]), np.frombuffer(found["squares"]), found["slope"], found["shift"])


def scored(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS, bits: int = SLOT_BITS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text, ...)``.

    ``score`` estimates the probability of label 1 from the whole text alone;
    ``predicted`` is 1 from 0.5 on.  Null and empty texts have no n-grams and
    get the score of margin 0.  Repeated rows score alike, a null id is not
    held out, other columns are not read.  Without labels of both classes every
    text gets the (smoothed) share of label 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, training_rows, bits))

    def run(batches):
        powers = Powers()
        for part in slices(batches, "text"):
            score = shared.value.scores(*slots(part.column("text"), powers, bits))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])
    held_out = F.coalesce(split_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return rows.mapInArrow(run, schema).select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
