"""Merkle manifest of a dataset: a leaf for each row, a tree of eights for each group, a tree over the groups' roots.

Rows get their rank within the group. The octal digits of ranks say where a node hangs: by one shuffle, blocks of 512
consecutive nodes meet, and grouping away one digit after the other nests the nodes of a run as structs in an array
below their parent. What is left of a block is one row; ranks of blocks make the next tree above in the same way.
On the way back each block's row gets the steps from its top to the root, and exploding the nested arrays hands them
down, with the hashes of a node's siblings put before them. Nothing but a block is ever held as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import parts
from plumbline.session import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FAN_BITS = 3  # eight nodes in a run
DIGITS = 3  # levels of a block, which so holds 512 nodes
_TOP = 20  # levels that 64-bit ranks can need
_STEPS = "array<struct<left:string,right:string>>"


def digest(c: Column) -> Column:
    """The lowercase hex SHA-256 of a text."""
    return F.sha2(c.cast("binary"), 256)


def leaf(changed: Mapping[str, Column] | None = None, fields: Sequence[str] = FIELDS) -> Column:
    """The hash of a row's fields: for each ``-`` if null, else its UTF-8 byte count, ``:``, and its value as text."""
    values = [(changed or {}).get(f, F.col(f)).cast("string") for f in fields]
    return digest(F.concat(*(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values)))


def _height(n: Column) -> Column:
    """The levels above the leaves of a tree of n leaves."""
    return sum(((n > (1 << FAN_BITS * level)).cast("int") for level in range(1, _TOP)), (n > 1).cast("int"))


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``rank``, the place from 0 on of each row in its ``group`` (null is a group) in the given order, and the group's size ``n``.

    Rows are dealt by ranges over group and order, so a large group is many ranges. The order should tell all rows apart
    that can be many. One row for each range and group carries the places before it.
    """
    placed = rows.repartitionByRange(parts(rows.sparkSession), group, *order).sortWithinPartitions(group, *order)
    placed = stage(placed.withColumn("at", F.monotonically_increasing_id()), "manifest-ranges")
    ranges = placed.groupBy(F.col(group).alias("of"), F.shiftright("at", 33).alias("slice")).agg(F.min("at").alias("first"), F.count("*").alias("own"))
    all_of = Window.partitionBy("of")
    before = F.sum("own").over(all_of.orderBy("slice")) - F.col("own")
    offsets = ranges.select("of", "slice", (before - F.col("first")).alias("shift"), F.sum("own").over(all_of).alias("n"))
    same = F.col(group).eqNullSafe(F.col("of")) & (F.shiftright("at", 33) == F.col("slice"))
    return placed.join(offsets, same).select(*rows.columns, (F.col("at") + F.col("shift")).alias("rank"), "n")


def _nested(nodes: DataFrame) -> DataFrame:
    """(group, n, block, hash, kids): the blocks of nodes (group, n, rank, hash, item), every level nested in ``kids``."""
    digit = [F.shiftright("rank", FAN_BITS * d).bitwiseAND(F.lit((1 << FAN_BITS) - 1)).cast("int").alias(f"digit{d}") for d in range(DIGITS)]
    rows = nodes.select("group", "n", F.shiftright("rank", FAN_BITS * DIGITS).alias("block"), *digit, "hash", "item")
    # All levels of a block are grouped where this puts them.
    rows, below = rows.repartition(parts(nodes.sparkSession), "group", "block"), "item"
    for level in range(DIGITS):
        keys = ["group", "n", "block", *(f"digit{d}" for d in range(level + 1, DIGITS))]
        run = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(f"digit{level}", "hash", below))).alias("kids"))
        joined = F.when(_height(F.col("n")) > level, digest(F.array_join("kids.hash", ""))).otherwise(F.col("kids")[0]["hash"])
        rows, below = run.withColumn("hash", joined), "kids"
    return rows


def _handed_down(blocks: DataFrame) -> DataFrame:
    """(group, item, steps, tops) of each node, from blocks (group, n, kids, steps, tops) whose steps lead from their top to the root."""
    rows = blocks
    for level in reversed(range(DIGITS)):
        kid = rows.select("group", "n", "steps", "tops", F.col("kids.hash").alias("run"), F.posexplode("kids").alias("at", "kid"))
        left, right = F.slice("run", F.lit(1), F.col("at")), F.slice("run", F.col("at") + 2, F.lit(1 << FAN_BITS))
        step = F.array(F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right")))
        longer = F.when(_height(F.col("n")) > level, F.concat(step, "steps")).otherwise(F.col("steps"))
        rows = kid.select("group", "n", longer.cast(_STEPS).alias("steps"), "tops", F.col("kid")["kids" if level else "item"].alias("kids" if level else "item"))
    return rows.select("group", "item", "steps", "tops")


def _climbed(nodes: DataFrame, crown: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(group, item, steps, tops) of nodes (group, n, rank, hash, item).

    ``crown`` gets each group's root (group, hash) and returns it as (group, steps, tops): the steps from there on, and
    the roots passed.
    """
    blocks = stage(_nested(nodes), "manifest-blocks")
    size = 1 << FAN_BITS * DIGITS
    most = blocks.agg(F.max("n")).first()[0] or 0
    if most <= size:
        above = crown(blocks.select("group", "hash")).select("group", F.lit(0).cast("long").alias("block"), "steps", "tops")
    else:
        fewer = F.shiftright(F.col("n") + (size - 1), FAN_BITS * DIGITS)
        above = _climbed(blocks.select("group", fewer.alias("n"), F.col("block").alias("rank"), "hash", F.col("block").alias("item")), crown)
        above = above.select("group", F.col("item").alias("block"), "steps", "tops")
    # A block's row and the row of its way up meet by grouping.
    both = blocks.select("group", "block", "n", "kids").unionByName(above, allowMissingColumns=True)
    met = both.groupBy("group", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "steps", "tops")))
    return _handed_down(met)


def _end(tops: DataFrame) -> DataFrame:
    """The crown of the uppermost tree: no further steps, its root is the last."""
    return tops.select("group", F.array().cast(_STEPS).alias("steps"), F.array("hash").alias("tops"))


def _over_groups(tops: DataFrame) -> DataFrame:
    """The crown of the groups' trees: a tree over their roots, in the order of the groups, null first."""
    rows = tops.select(F.lit(0).alias("one"), F.col("group").alias("name"), "hash")
    nodes = ranked(rows, "one", ["name"]).select(F.col("one").alias("group"), "n", "rank", "hash", F.struct("name", "hash").alias("item"))
    out = _climbed(nodes, _end)
    return out.select(F.col("item.name").alias("group"), "steps", F.concat(F.array("item.hash"), "tops").alias("tops"))


def proved(docs: DataFrame, extra: Mapping[str, Column] | None = None, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id") -> DataFrame:
    """(doc_id, lang, leaf, subroot, root, steps, extra) for each row: its hash, its group's and the dataset's root, and its proof.

    ``steps`` holds, from the leaf upwards, the joined hashes of the siblings left and right of the way; both are empty
    in a run of one. Leaves stand in the order of their key within the group, null first; rows with one key in the
    order of their hashes, and equal rows have equal leaves, each with a proof of its own place. Null fields hash as
    ``-``, empty ones as ``0:``; a null group is a group, the first; other columns are not looked at. No rows give no
    rows. ``extra`` holds further columns to carry along, as a struct.
    """
    carried = F.struct(*(c.alias(n) for n, c in (extra or {"nothing": F.lit(None).cast("string")}).items()))
    rows = docs.select(F.col(group).alias("group"), F.col(key).alias("key"), leaf(fields=fields).alias("hash"), carried.alias("extra"))
    # Equal rows are many rows too: their place of origin tells them apart.
    rows = stage(rows.withColumn("origin", F.monotonically_increasing_id()), "manifest-leaves")
    nodes = ranked(rows, "group", ["key", "hash", "origin"])
    out = _climbed(nodes.select("group", "n", "rank", "hash", F.struct("key", "hash", "extra").alias("item")), _over_groups)
    return out.select(
        F.col("item.key").alias(key), F.col("group").alias(group), F.col("item.hash").alias("leaf"), F.col("tops")[0].alias("subroot"),
        F.col("tops")[1].alias("root"), "steps", "item.extra",
    )


def proof_digest(steps: str) -> Column:
    """The hash of all siblings of a proof, level by level, left to right."""
    return digest(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(steps, start, lambda h, s: digest(F.concat(s["left"], h, s["right"])))
