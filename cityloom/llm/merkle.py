"""Merkle manifests of a table, built level by level with windows.

Every row is a leaf. Leaves of a group are numbered in the order of their ids; of every ``fanout`` consecutive nodes the digests, one after another, are
hashed into a node of the next level, until one is left: the root of the group. The roots of all groups, in the order of the groups, make a tree of
the same kind. On each level, lag and lead columns at the offsets 1 to ``fanout`` - 1, masked by a node's slot in its run and by the length of the run, give the
siblings of every node; the first child of a run hashes the parent.

Windows span chunks of whole runs, never a group, so a group that holds most rows is spread like the others. Rows are numbered in pieces of a range
partitioning, each piece beginning where those before it end. Levels are written to the shared folder: a lost executor costs a read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityloom.llm.common import size_guarded
from cityloom.session import stage

FANOUT = 8
#: Nodes that a window spans, rounded to whole runs.
CHUNK = 512
#: The whole of the groups' roots is one group.
_ALL = "all"
_PATH = "array<struct<left:string,right:string>>"


def encoded(value: str | Column) -> Column:
    """A value as ``-`` if it is NULL, else its length in UTF-8 bytes, a colon and itself; integers in decimal. No two lists of values read the same."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts, one after another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(values: Iterable[str | Column]) -> Column:
    return digest(*[encoded(value) for value in values])


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with their place ``pos`` in their ``group``, from 0, and the rows ``n`` of the group."""
    pieces = stage(rows.repartitionByRange("group", *order).withColumn("piece", F.spark_partition_id()), "merkle-pieces")
    whole = Window.partitionBy("group")
    before = whole.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy("group", "piece").agg(F.count(F.lit(1)).alias("size"))
    offset = F.coalesce(F.sum("size").over(before), F.lit(0))
    # A row per group and piece: at most as many as groups and pieces together.
    offsets = stage(sizes.select("group", "piece", offset.alias("offset"), F.sum("size").over(whole).alias("n")), "merkle-offsets")
    within = F.row_number().over(Window.partitionBy("piece", "group").orderBy(*order))
    placed = pieces.withColumn("within", within).join(size_guarded(offsets), ["group", "piece"])
    return placed.withColumn("pos", F.col("offset") + F.col("within") - 1).drop("piece", "within", "offset")


def _with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Nodes with the digests of the others of their run, those before and those behind them each as one text."""
    runs = max(1, CHUNK // fanout)
    chunk = Window.partitionBy("group", "chunk").orderBy("pos")
    slot = F.col("pos") % fanout
    length = F.least(F.lit(fanout), F.col("n") - F.col("pos") + slot)
    before = [F.when(slot >= j, F.lag("digest", j).over(chunk)) for j in range(fanout - 1, 0, -1)]
    behind = [F.when(slot + j < length, F.lead("digest", j).over(chunk)) for j in range(1, fanout)]
    chunked = nodes.withColumn("chunk", F.expr(f"pos div {runs * fanout}"))
    return chunked.withColumns({"left": F.concat_ws("", *before), "right": F.concat_ws("", *behind)}).drop("chunk")


def _parents(level: DataFrame, fanout: int) -> DataFrame:
    """The next level: first children hash their run."""
    first = level.where((F.col("pos") % fanout == 0) & (F.col("n") > 1))
    place, size = F.expr(f"pos div {fanout}").alias("pos"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n")
    return first.select("group", place, size, digest(F.col("digest"), F.col("right")).alias("digest"))


def _levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """All levels, from the leaves to where every group has one node: group, pos, n, digest, left, right."""
    levels = [stage(_with_siblings(nodes, fanout), "merkle-level")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(stage(_with_siblings(_parents(levels[-1].select("group", "pos", "n", "digest", "right"), fanout), fanout), "merkle-level"))
        most = -(-most // fanout)
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    alone = [level.where("n = 1").select("group", "digest") for level in levels]
    return reduce(DataFrame.union, alone)


def _with_paths(levels: list[DataFrame], fanout: int) -> DataFrame:
    """The lowest level with ``path``: what stands before and behind the node, and behind each of its parents, on the way to the group's root."""
    own = F.array(F.struct("left", "right"))
    none = F.array().cast(_PATH)
    paths = levels[-1].withColumn("path", none)
    for level in reversed(levels[:-1]):
        above = paths.select("group", F.col("pos").alias("parent"), F.col("path").alias("above"))
        joined = level.withColumn("parent", F.expr(f"pos div {fanout}")).join(above, ["group", "parent"], "left")
        path = F.when(F.col("n") == 1, none).otherwise(F.concat(own, F.coalesce("above", none)))
        paths = joined.withColumn("path", path).drop("parent", "above")
    return paths.drop("left", "right")


@dataclass(frozen=True)
class Manifest:
    """The levels of a table's groups and those of the tree above the groups' roots."""

    levels: list[DataFrame]
    #: group, value, digest: a row for every group.
    subroots: DataFrame
    upper: list[DataFrame]
    fanout: int

    def root(self) -> DataFrame:
        """One row, the digest of the whole table; none for an empty table."""
        return _roots(self.upper).select(F.col("digest").alias("root"))

    def proofs(self) -> DataFrame:
        """Every leaf's row with ``leaf``, ``subroot``, ``root`` and ``path``, the siblings on the way to the root: what a holder of the row alone needs to check it."""
        leaves = _with_paths(self.levels, self.fanout).withColumnRenamed("digest", "leaf")
        tops = _with_paths(self.upper, self.fanout).select(
            F.col("part").alias("group"), F.col("digest").alias("subroot"), F.col("path").alias("upper_path"), self.root().scalar().alias("root")
        )
        joined = leaves.join(size_guarded(stage(tops, "merkle-subroots")), "group")
        return joined.withColumn("path", F.concat("path", "upper_path")).drop("upper_path", "group", "pos", "n")


def build(leaves: DataFrame, group: str, order: str, fanout: int = FANOUT) -> Manifest:
    """The manifest of rows that have a digest in the column ``leaf``; their other columns are kept beside the leaves.

    A NULL ``group`` is a group of its own and comes first; groups are ordered by their UTF-8 bytes. Leaves of a group ascend by ``order``, NULL first, then by their
    digests, so rows that repeat an id have a fixed order and whole copies neighboring places. A group of one row is its own root. An empty table has no root.
    """
    if fanout < 2:
        raise ValueError("a node needs two children at least")
    taken = {"group", "piece", "within", "offset", "size", "chunk", "parent", "above", "path", "left", "right", "pos", "n", "digest", "subroot", "root", "upper_path"}
    if clash := taken & {name.lower() for name in leaves.columns if name not in (group, order)}:
        raise ValueError(f"rename columns of the leaves: {', '.join(sorted(clash))}")
    keyed = leaves.withColumnRenamed("leaf", "digest").withColumn("group", encoded(group))
    numbered = _numbered(stage(keyed, "merkle-leaves"), [order, "digest"])
    levels = _levels(numbered, fanout)
    # Of a level above the leaves only digests are known, so the groups' names come from the first leaves.
    names = levels[0].where("pos = 0").select("group", F.col(group).alias("value"))
    subroots = stage(_roots(levels).join(names, "group"), "merkle-roots")
    tops = subroots.select(F.lit(_ALL).alias("group"), F.col("group").alias("part"), "value", "digest")
    upper = _levels(_numbered(tops, ["value", "digest"]), fanout)
    return Manifest(levels, subroots, upper, fanout)


def fold(path: str | Column, leaf: Column) -> Column:
    """The root that follows from a leaf and the siblings on its way."""
    return F.aggregate(path, leaf, lambda below, step: digest(step["left"], below, step["right"]))


def proof_digest(path: str | Column) -> Column:
    """One digest of all siblings of a path, from the leaf up and from left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))
