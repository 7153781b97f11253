"""Benchmark items inside documents, up to a share of edits, by pigeonhole pieces and Myers' algorithm."""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.llm.columns import slices

# Edits allowed per character of an item.
ERROR_RATE = 0.08
# Shorter items are looked up as they are, between word boundaries: with edits almost any text would hold them.
MIN_CHARS = 24
# Characters of items that are scanned for at once.
BLOCK_CHARS = 4_000_000


def normal(text: Column) -> Column:
    """Lower-cased, with single spaces for runs of white space and none at the ends."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\s+", " "))


def pieces(length: int, errors: int) -> list[tuple[int, int]]:
    """``errors + 1`` adjacent pieces; of so many one survives that many edits."""
    bounds = [i * length // (errors + 1) for i in range(errors + 2)]
    return list(zip(bounds[:-1], bounds[1:], strict=True))


def masks(pattern: str) -> dict[str, int]:
    """For each character, the bits of the places where it stands in the pattern."""
    found: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        found[c] |= 1 << i
    return dict(found)


def least_distance(places: dict[str, int], length: int, text: str) -> int:
    """The least edit distance of a pattern to any substring of ``text``, a column per step.

    Myers' bit-parallel algorithm: the vertical differences of a column are two
    bit sets, here of whatever length the pattern has.
    """
    full, last = (1 << length) - 1, 1 << (length - 1)
    up, down = full, 0
    score = best = length
    for c in text:
        match = places.get(c, 0) | down
        diagonal = (((match & up) + up) ^ up) | match
        rise = down | (full & ~(diagonal | up))
        fall = up & diagonal
        if rise & last:
            score += 1
        elif fall & last:
            score -= 1
            if score < best:
                best = score
        rise = (rise << 1) & full
        down = rise & diagonal
        up = ((fall << 1) & full) | (full & ~(rise | diagonal))
    return best


class Matcher:
    """Finds the items of one block in normal texts."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float) -> None:
        import ahocorasick

        self.items = [(i, t, int(rate * len(t)) if len(t) >= MIN_CHARS else 0) for i, t in items]
        self.masks: dict[int, dict[str, int]] = {}
        entries = defaultdict(list)
        for number, (_, text, errors) in enumerate(self.items):
            for start, end in pieces(len(text), errors):
                entries[text[start:end]].append((number, start))
        self.automaton = ahocorasick.Automaton()
        for piece, places in entries.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int]]:
        """Id, distance and length of each item within its edits in ``text``."""
        regions = defaultdict(list)
        for end, (size, places) in self.automaton.iter(text):
            for number, start in places:
                _, item, errors = self.items[number]
                begin = end + 1 - size - start - errors
                if len(item) < MIN_CHARS and not _apart(text, begin, end + 1):
                    continue
                regions[number].append((max(begin, 0), begin + len(item) + 2 * errors))
        found = []
        for number, spans in regions.items():
            name, item, errors = self.items[number]
            distance = 0 if item in text else self._verified(number, spans, text)
            if distance <= errors:
                found.append((name, distance, len(item)))
        return found

    def _verified(self, number: int, spans: list[tuple[int, int]], text: str) -> int:
        """The least distance over the spans, which are merged where they overlap."""
        item = self.items[number][1]
        places = self.masks.setdefault(number, {}) or masks(item)
        self.masks[number] = places
        best, reach = len(item), 0
        spans.sort()
        merged = [list(spans[0])]
        for begin, reach in spans[1:]:
            if begin <= merged[-1][1]:
                merged[-1][1] = max(reach, merged[-1][1])
            else:
                merged.append([begin, reach])
        for begin, reach in merged:
            best = min(best, least_distance(places, len(item), text[begin:reach]))
        return best


def _apart(text: str, begin: int, end: int) -> bool:
    """Whether no word goes on over either end of ``text[begin:end]``."""
    before = begin > 0 and text[begin - 1].isalnum() and text[begin].isalnum()
    after = end < len(text) and text[end].isalnum() and text[end - 1].isalnum()
    return not (before or after)


def _blocks(items: DataFrame):
    """Items that have a text, as bounded lists for the driver."""
    usable = items.select(F.col("item_id").cast("long").alias("item_id"), normal(F.col("text")).alias("text"))
    usable = usable.where(F.length("text") > 0).distinct()
    total = usable.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = -(-total // BLOCK_CHARS)
    for i in range(count):
        block = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i)
        if found := [tuple(r) for r in block.orderBy("item_id", "text").collect()]:
            yield found


def matches(rows: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """``row, hits`` for ``row, text``; a hit is ``item_id, distance, item_chars``.

    Items come as broadcasts of bounded size; more of them are scanned for in
    further passes over the rows, whose hits are rows of their own.
    """
    hit = T.StructType.fromDDL("item_id long, distance int, item_chars int")
    texts = rows.select("row", normal(F.col("text")).alias("text"))
    schema = T.StructType([texts.schema["row"], T.StructField("hits", T.ArrayType(hit))])
    found = None
    for block in _blocks(items):
        shared = rows.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for part in slices(batches, "text"):
                hits = [
                    [dict(zip(("item_id", "distance", "item_chars"), h, strict=True)) for h in matcher.find(t)]
                    for t in part.column("text").to_pylist()
                ]
                kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("item_chars", pa.int32())]))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(hits, kind)], ["row", "hits"])

        part = texts.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = texts.select("row", F.array().cast(T.ArrayType(hit)).alias("hits"))
    return found


def contaminated(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """``doc_id, item_id, distance, item_chars``: each document with each item it holds.

    An item is held if some substring of the document is within ``rate`` edits
    per character of it, both lower-cased and with single spaces.  ``distance``
    is zero, or the least found around the pieces that occur exactly.

    An item shorter than ``MIN_CHARS`` is held if it occurs without any edit,
    beginning and ending where words do.

    Null and empty texts hold nothing, and null and empty items are held by
    none.  Repeated items count once, repeated documents
    give repeated rows, and null ids stay null.  Other columns are not read.
    """
    rows = docs.select(F.struct("doc_id").alias("row"), "text")
    return matches(rows, items, rate).select("row.doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")


def without_items(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """``docs`` without the rows that hold an item."""
    spark, kept = docs.sparkSession, docs
    for block in _blocks(items):
        table = spark.createDataFrame(block, "item_id long, text string")
        rows = kept.select(F.struct(*kept.columns).alias("row"), "text")
        kept = matches(rows, table, rate).where(F.size("hits") == 0).select("row.*")
    return kept
