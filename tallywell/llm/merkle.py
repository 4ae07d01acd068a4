"""Merkle trees over the rows of a table: roots, and a proof for each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import col

#: levels of a tree that are built where the nodes of a block lie
DEPTH = 10
#: rows of a part when rows are put in order
PART_ROWS = 50_000
#: parts whose numbers, and groups whose places, are sent to every task at most
BROADCAST_PARTS, BROADCAST_GROUPS = 100_000, 100_000


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts one after another; null ones are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf_digest(*values: Column) -> Column:
    """The digest of a row's values: ``-`` for null, else the length in UTF-8 bytes, ``:``, the value."""

    def framed(value: Column) -> Column:
        body = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(body).cast("string"), F.lit(":"), body), F.lit("-"))

    return digest(*map(framed, values))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its ``path`` give."""
    return F.aggregate(path, leaf, lambda node, run: digest(run["left"], node, run["right"]))


def siblings(path: Column) -> Column:
    """The digests of a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), "")


def in_order(rows: DataFrame, order: Sequence[str], name: str, label: str) -> DataFrame:
    """``rows`` with their place in ascending order, from 0 without gaps, nulls first.

    Rows are written part by part in order, each with its number in its part; parts are
    counted, and a row's place is what comes before its part and its number. ``order``
    has to tell rows apart, so that any number of like rows can be dealt to several parts.
    """
    parts = max(16, -(-rows.count() // PART_ROWS))
    sorted_ = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the number of the part and, in the lower 33 bits, that of the row in it
    stored = materialize(sorted_.withColumn("number", F.monotonically_increasing_id()), label)
    part = F.shiftright("number", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    bases = counts.select(
        "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.shiftleft("part", 33)).alias("base")
    )
    bases = materialize(bases, f"{label}-parts")
    if parts <= BROADCAST_PARTS:
        bases = F.broadcast(bases)
    return stored.join(bases, part == F.col("part")).withColumn(name, F.col("number") + F.col("base")).select(*rows.columns, name)


# --- one tree per group -------------------------------------------------------------------


def _slots(nodes: Column, slot: Column, fanout: int) -> list[Column]:
    """Conditional aggregates: the child in each slot of a parent, null if there is none."""
    return [F.max(F.when(slot == i, nodes)) for i in range(fanout)]


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level: a row per parent, its children pivoted into slots and hashed.

    A group with one node is done and keeps it.
    """
    slots = _slots(F.col("node"), F.col("pos") % fanout, fanout)
    names = [f"slot{i}" for i in range(fanout)]
    pivoted = nodes.groupBy("tree", "block", _div(F.col("pos"), fanout).alias("pos"), "total").agg(
        *(s.alias(n) for s, n in zip(slots, names))
    )
    node = F.when(F.col("total") > 1, digest(*map(F.col, names))).otherwise(F.col(names[0]))
    return pivoted.select("tree", "block", "pos", _div(F.col("total") + (fanout - 1), fanout).alias("total"), node.alias("node"))


def _div(n: Column, by: int) -> Column:
    """Whole-number division of longs that are not negative."""
    return ((n - n % by) / by).cast("long") if by & (by - 1) else F.shiftright(n, by.bit_length() - 1)


def _runs(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """Nodes with ``path``: of each of ``depth`` levels the siblings left and right of their ancestor.

    The row of a node carries its ancestor from level to level; the slots of the
    ancestor's parent are aggregated over the parent's rows, and those but its own are siblings.
    """
    path = []
    size = 1
    for level in range(depth):
        own = _div(F.col("pos"), size) % fanout
        parent = Window.partitionBy("tree", "block", _div(F.col("pos"), size * fanout))
        names = [f"slot{level}_{i}" for i in range(fanout)]
        nodes = nodes.withColumns({n: s.over(parent) for n, s in zip(names, _slots(F.col("up"), own, fanout))})
        left = F.concat_ws("", *(F.when(own > i, F.col(n)) for i, n in enumerate(names)))
        right = F.concat_ws("", *(F.when(own < i, F.col(n)) for i, n in enumerate(names)))
        more = F.col("total") > size
        nodes = nodes.withColumns(
            {
                f"run{level}": F.when(more, F.struct(left.alias("left"), right.alias("right"))),
                "up": F.when(more, digest(*map(F.col, names))).otherwise(F.col("up")),
            }
        ).drop(*names)
        path.append(f"run{level}")
        size *= fanout
    return nodes.withColumn("path", F.array_compact(F.array(*path))).drop(*path)


def climb(nodes: DataFrame, fanout: int, most: int, depth: int, label: str) -> list[DataFrame]:
    """Tables of nodes, each of the blocks of the one before, up to one node per tree.

    ``nodes`` is a stored table with ``tree``, ``pos``, ``total``, ``node``: which tree, the place in it from 0, how many
    nodes that has (``most`` at most), the digest. Blocks of ``fanout ** depth`` nodes are dealt
    out once and climbed where they lie; their nodes are the next table.
    """
    tables, width = [nodes], fanout**depth
    while len(tables) == 1 or most > 1:
        up = _blocks(tables[-1], width).select("tree", "block", "pos", "total", "node")
        for _ in range(depth):
            up = _parents(up, fanout)
        tables.append(materialize(up.select("tree", F.col("block").alias("pos"), "total", "node"), label))
        most = -(-most // width)
    return tables


def _blocks(nodes: DataFrame, width: int) -> DataFrame:
    return nodes.withColumn("block", _div(F.col("pos"), width)).repartition("tree", "block")


def descend(tables: Sequence[DataFrame], tops: DataFrame, fanout: int, depth: int, label: str) -> DataFrame:
    """The rows of the first table of :func:`climb` with ``path``, the siblings on their way up, and what is in ``tops``.

    ``tops`` has a row per tree: ``tree``, ``pos`` (0), ``path`` from its root on, and others. Nodes meet the path of
    their block where they were dealt to.
    """
    for nodes in reversed(tables[:-1]):
        more = [c for c in tops.columns if c not in ("tree", "pos", "path")]
        above = tops.select(F.col("tree").alias("of"), F.col("pos").alias("at"), F.col("path").alias("rest"), *more)
        placed = _runs(_blocks(nodes, fanout**depth).withColumn("up", F.col("node")), fanout, depth)
        joined = placed.join(above, (F.col("tree") == F.col("of")) & (F.col("block") == F.col("at")))
        tops = joined.select(*nodes.columns, F.concat("path", "rest").alias("path"), *more)
        if nodes is not tables[0]:
            tops = materialize(tops.select("tree", "pos", "path", *more), label)
    return tops


def merkle_proofs(
    leaves: DataFrame, group: str, key: str, leaf: str = "leaf", fanout: int = 2, depth: int = DEPTH
) -> DataFrame:
    """All rows and columns with ``subroot``, ``root`` and ``path``, the proof of each row.

    The digests in ``leaf`` are the leaves of a tree per ``group``, ascending by ``key``. Every
    ``fanout`` consecutive nodes, at the end fewer, become their digest while there is more than one.
    The groups' roots, ascending by group, are the leaves of one more tree in the same way; its
    root is that of the table. ``path`` has for each level up to it the siblings ``left`` and
    ``right`` of the row's ancestor; see :func:`fold` and :func:`siblings`.

    Null is a group and a key like any other and comes first. Rows of equal key go by leaf; equal rows are
    leaves each. A leaf must not be null. An empty table stays empty. Columns named ``subroot``,
    ``root`` or ``path`` are replaced. All columns are dealt out several times, so leave long texts out.
    """
    if fanout < 2 or depth < 1:
        raise ValueError("a node needs two children at least, a block one level")
    leaves = leaves.drop("subroot", "root", "path")
    rows = leaves.select(
        col(group).alias("group"), col(key).alias("key"), col(leaf).alias("node"),
        F.struct(*(col(c) for c in leaves.columns)).alias("row"), F.monotonically_increasing_id().alias("id"),
    )
    ordered = in_order(materialize(rows, "leaves"), ["group", "key", "node", "id"], "place", "leaves-in-order")
    groups = ordered.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("total"))
    trees = materialize(in_order(materialize(groups, "groups"), ["first"], "tree", "groups-in-order"), "trees")
    size = trees.agg(F.count("*").alias("n"), F.coalesce(F.max("total"), F.lit(0)).alias("most")).first()
    of_group = trees.withColumnRenamed("group", "of")
    if size.n <= BROADCAST_GROUPS:
        of_group = F.broadcast(of_group)
    placed = ordered.join(of_group, F.col("group").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("place") - F.col("first")).alias("pos"), "total", "node", "row"
    )
    tables = climb(materialize(placed, "nodes"), fanout, size.most, depth, "nodes")
    one, none = F.lit(0).cast("long"), F.array().cast("array<struct<left:string,right:string>>")
    subroots = tables[-1].select(one.alias("tree"), F.col("tree").alias("pos"), F.lit(size.n).cast("long").alias("total"), "node")
    above = climb(materialize(subroots, "subroots"), fanout, size.n, depth, "subroots")
    root = above[-1].select("tree", "pos", none.alias("path"), F.col("node").alias("root"))
    tops = descend(above, root, fanout, depth, "subroots").select(
        F.col("pos").alias("tree"), one.alias("pos"), "path", "root", F.col("node").alias("subroot")
    )
    found = descend(tables, materialize(tops, "subroots"), fanout, depth, "nodes")
    return found.select(*(F.col("row").getField(c).alias(c) for c in leaves.columns), "subroot", "root", "path")
