"""Reply trees to formatted conversations, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkatlas.runtime import stored, top_n_per_group

LOSS_ROLE = "assistant"
# A turn is HEAD, role, MIDDLE, text, END.  None of the marks can occur in an escaped text.
HEAD, MIDDLE, END = '<turn role="', '">', "</turn>\n"
# In this order; undone in reverse.  An escaped text holds no "<", no quote, and a backslash only before s, l or q.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ('"', "\\q"))


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _on(left: str, right: str, key: str) -> Column:
    return F.col(f"{left}.tree").eqNullSafe(F.col(f"{right}.tree")) & (F.col(f"{left}.{key}") == F.col(f"{right}.node"))


def best_paths(messages: DataFrame, paths_per_tree: int | None = 1) -> DataFrame:
    """``tree, leaf, rank, node, place``: the nodes of the best root-to-leaf paths, places from 0 at the root.

    ``messages(tree, node, parent, score)`` has each node once per tree.  A
    node whose parent is null or missing is a root.  Branches are ranked from 1
    in their tree by the sum of their scores, then by length, then by the
    smaller leaf.  ``None`` takes all paths and leaves ``rank`` null.

    Self-joins double the distance to the ancestor that a node points to, so a
    path of n nodes takes about log2(n) of them, and as many to list the nodes
    of the chosen paths.  Nodes on a cycle are on no such path and drop out.
    """
    rows = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    known = rows.select("tree", "node")
    first = rows.alias("m").join(known.alias("p"), _on("m", "p", "parent"), "left")
    hops = [
        stored(
            first.select(
                "m.tree", "m.node", F.col("p.node").alias("up"),
                F.col("p.node").isNotNull().cast("long").alias("steps"), F.col("m.score").alias("total"),
            )
        )
    ]
    most = hops[0].count()
    # Nodes that have reached their root stay behind; the others go on from round to round.
    ended = hops[0].where("up IS NULL")
    while (1 << (len(hops) - 1)) < 2 * most:
        active = hops[-1].where("up IS NOT NULL")
        if active.isEmpty():
            break
        joined = active.alias("n").join(active.unionByName(ended).alias("u"), _on("n", "u", "up"))
        total, steps = F.col("n.total") + F.col("u.total"), F.col("n.steps") + F.col("u.steps")
        hops.append(stored(joined.select("n.tree", "n.node", "u.up", steps.alias("steps"), total.alias("total"))))
        ended = ended.unionByName(hops[-1].where("up IS NULL"))
    parents = hops[0].where("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct()
    leaves = ended.alias("e").join(parents.alias("p"), _on("e", "p", "node"), "left_anti")
    if paths_per_tree is None:
        chosen = leaves.withColumn("rank", F.lit(None).cast("int"))
    else:
        order = F.col("total").desc(), F.col("steps").desc(), F.col("node")
        chosen = top_n_per_group(leaves.select("e.*"), "tree", order, paths_per_tree)
    found = stored(chosen.select("tree", F.col("node").alias("leaf"), "rank", "node", F.col("steps").alias("place")))
    for i, hop in enumerate(hops):
        up = found.alias("f").join(hop.where("up IS NOT NULL").alias("h"), _on("f", "h", "node"))
        up = up.select("f.tree", "f.leaf", "f.rank", F.col("h.up").alias("node"), (F.col("f.place") - (1 << i)).alias("place"))
        found = stored(found.unionByName(up))
    return found


def formatted(turns: DataFrame, loss_role: str = LOSS_ROLE, keys: Sequence[str] = ("tree",)) -> DataFrame:
    """``tree, formatted, mask`` from ``turns(tree, place, role, text)``, or with other ``keys``.

    ``mask`` has one entry per turn: characters before the text, of the text
    and after it, and whether the text is under the loss.  A conversation is one
    row, so its turns meet in one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(HEAD), escape(role), F.lit(MIDDLE))
    part = F.struct(
        "place",
        F.concat(head, escape(text), F.lit(END)).alias("turn"),
        F.char_length(head).alias("before"),
        F.char_length(escape(text)).alias("chars"),
        F.lit(len(END)).alias("after"),
        (role == loss_role).alias("loss"),
    )
    listed = turns.select(*keys, part.alias("part")).groupBy(*keys).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    mask = F.transform("parts", lambda p: F.struct(*(p[c].alias(c) for c in ("before", "chars", "after", "loss"))))
    joined = F.array_join(F.transform("parts", lambda p: p["turn"]), "")
    return listed.select(*keys, joined.alias("formatted"), mask.alias("mask"))


def parsed(rows: DataFrame) -> DataFrame:
    """``rows(tree, formatted, mask)`` with ``turns`` (role and text) and ``loss_text``, read back."""
    turns = F.filter(F.split("formatted", f"(?<={END})"), lambda t: t != "")
    named = F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.substring_index(F.substring_index(t, MIDDLE, 1), HEAD, -1)).alias("role"),
            unescape(F.substring_index(F.substring_index(t, END, 1), MIDDLE, -1)).alias("text"),
        ),
    )
    under = F.zip_with(turns, "mask", lambda t, m: F.when(m["loss"], F.substring(t, m["before"] + 1, m["chars"])).otherwise(""))
    return rows.withColumn("turns", named).withColumn("loss_text", unescape(F.array_join(under, "")))


def format_trees(messages: DataFrame, paths_per_tree: int | None = 1, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``tree, leaf, rank, formatted, mask``: each chosen path of ``best_paths`` as one conversation.

    ``messages(tree, node, parent, score, role, text)``; a null score counts as
    0, null texts and roles are empty.  Other columns are not read.
    """
    paths = best_paths(messages, paths_per_tree)
    turns = paths.alias("p").join(messages.alias("m"), _on("p", "m", "node"))
    turns = turns.select("p.tree", "p.leaf", "p.rank", "p.place", "m.role", "m.text")
    return formatted(turns, loss_role, ("tree", "leaf", "rank"))


def conversations(rows: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``tree, formatted, mask`` for ``rows(conv_id, turn, role, text)``; each turn replies to the one before.

    Turns go by ``turn``, nulls last, then role and text.  Null texts and roles
    are empty; repeated rows are further turns; rows without ``conv_id`` are one
    conversation.  Other columns are not read.
    """
    rows = rows.select(
        F.col("conv_id").alias("tree"), "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    )
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = stored(rows.withColumn("node", F.row_number().over(order)))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    messages = rows.withColumn("parent", parent).withColumn("score", F.lit(0.0))
    return format_trees(messages, loss_role=loss_role).drop("leaf", "rank")


PROBE_TEXT = "\\### Assistant: </turn> ok"


def with_probe(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts look like control strings."""
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(PROBE_TEXT).alias("text")
    )
    return rows.select("conv_id", "turn", "role", "text").unionByName(extra)


def digests(rows: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, as counts and hashes."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed(rows).select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


_SQL_ESCAPED = "replace(replace(replace({0}, '\\', '\\s'), '<', '\\l'), '\"', '\\q')"
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE_TEXT}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(HEAD + MIDDLE + END)} + length({_SQL_ESCAPED.format('role')}) + length({_SQL_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
