"""Merkle dataset manifest: leaves by group, trees of three, a witness for every leaf.

A leaf is the digest of a row's fields. In each group (tree) the leaves ascend; every
`ARITY` consecutive nodes become their parent until one is left, and the groups' roots
form one more tree in the same way. A witness lists, level by level, what stands left
and right of a node in its run; folding a leaf through its witness gives the root.

Witnesses grow by streaming append. `Appender` takes nodes in order and holds the open
subtrees only: a completed run hands its members' witnesses the siblings they lacked
and is appended, as one node, a level higher. A task streams over aligned blocks of
`ARITY ** BLOCK_LEVELS` positions; the blocks' roots are appended in the next round in
the same way, so that the rounds are logarithmic in the longest tree. On the way down a
block's witness is appended to those of its members. No task holds more than the block
that is open, however many leaves a group has: a group's blocks are dealt to all tasks.

Positions come from a range partitioning by (group, id, leaf), numbered inside each
partition and shifted by the counts of the partitions before.

Defined results: a null field counts as `-`; a null group is a group of its own and
comes first; rows without an id come first in their group; rows of one id are ordered by
their leaf, so repeated rows have a place and a witness each, and which of two equal
rows has which does not matter. A text of any length is one digest, taken in the JVM.
No rows, no root. Only the columns named are read, so other names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spark import prepare, written

ARITY = 3
#: Levels of a block: 3 ** 7 = 2187 nodes.
BLOCK_LEVELS = 7
_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])
_STEPS = "array<struct<left:string,right:string>>"


def field(column: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(*texts: Column) -> Column:
    """Lowercase hex SHA-256 of the texts, concatenated."""
    return F.sha2(F.concat(*texts), 256)


def leaf_of(*columns: Column) -> Column:
    return digest(*[field(c) for c in columns])


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and a witness lead to."""
    return F.aggregate(witness, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def siblings(witness: Column) -> Column:
    """The digests of a witness as one text, level by level, left to right."""
    return F.array_join(F.transform(witness, lambda step: F.concat(step["left"], step["right"])), "")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Appender:
    """A tree of `arity` that grows by appending nodes, and the witnesses of its leaves.

    `levels`: climb so many levels exactly; without it, until one node is left.
    """

    def __init__(self, arity: int = ARITY, levels: int | None = None):
        self._arity, self._levels = arity, levels
        #: By level: the nodes of the open run, each with the witnesses below it.
        self._open: list[list[tuple[str, list[list[tuple[str, str]]]]]] = [[]]
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, node: str) -> None:
        """Append the next leaf; its witness so far is empty."""
        witness: list[tuple[str, str]] = []
        self.witnesses.append(witness)
        self._put(0, node, [witness])

    def _put(self, level: int, node: str, below: list[list[tuple[str, str]]]) -> None:
        if level == len(self._open):
            self._open.append([])
        run = self._open[level]
        # a full run is closed by the next node, as it may turn out to be the root
        if len(run) == self._arity:
            self._close(level)
            run = self._open[level]
        run.append((node, below))

    def _close(self, level: int) -> None:
        """Complete a run: its members learn their siblings, their parent goes a level up."""
        run, self._open[level] = self._open[level], []
        nodes = [node for node, _ in run]
        for at, (_, below) in enumerate(run):
            step = ("".join(nodes[:at]), "".join(nodes[at + 1 :]))
            for witness in below:
                witness.append(step)
        self._put(level + 1, _hash("".join(nodes)), [w for _, below in run for w in below])

    def root(self) -> str:
        """Close what is open and return the one node left; nothing can be appended after it."""
        level = 0
        while level < self._levels if self._levels is not None else level + 1 < len(self._open) or len(self._open[level]) > 1:
            if self._open[level]:
                self._close(level)
            level += 1
        return self._open[level][0][0]


def _levels(size: int, block: int, block_levels: int) -> int | None:
    """A block of a longer tree climbs all its levels, also if it is the last and short."""
    return block_levels if size > block else None


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[dict]]:
    """Rows of the partition, block by block."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.select(columns).to_pylist():
            if rows and (row["tree"], row["block"]) != (rows[-1]["tree"], rows[-1]["block"]):
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _roots(nodes: DataFrame, block_levels: int) -> DataFrame:
    """(tree, position, size, node): the root of each block as a node of the next round."""
    block = ARITY**block_levels

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for rows in _blocks(batches, ["tree", "block", "size", "node"]):
            tree = Appender(ARITY, _levels(rows[0]["size"], block, block_levels))
            for row in rows:
                tree.append(row["node"])
            found.append((rows[0]["tree"], rows[0]["block"], -(-rows[0]["size"] // block), tree.root()))
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["tree", "position", "size", "node"])

    return _in_order(nodes.withColumn("block", F.floor(F.col("position") / block))).mapInArrow(climb, "tree string, position long, size long, node string")


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")


def _with_witnesses(nodes: DataFrame, above: DataFrame | None, block_levels: int, carry: list[str]) -> DataFrame:
    """(tree, position, node, carry..., witness): every node's steps to the end of its block, then the block's own (`above`)."""
    block = ARITY**block_levels
    rows = nodes.select("tree", F.floor(F.col("position") / block).alias("block"), "position", "size", "node", *carry, F.lit(None).cast(_STEPS).alias("witness"))
    if above is not None:
        # a row before the block's first one brings the block's witness
        nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("size", "node", *carry)]
        rows = rows.unionByName(above.select("tree", F.col("position").alias("block"), F.lit(-1).cast("long").alias("position"), *nothing, "witness"))
    out = ["tree", "position", "node", *carry]
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in out), f"witness {_STEPS}"])

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members in _blocks(batches, rows_columns):
            rest = [(s["left"], s["right"]) for s in members[0]["witness"] or []] if members[0]["position"] < 0 else []
            members = [m for m in members if m["position"] >= 0]
            tree = Appender(ARITY, _levels(members[0]["size"], block, block_levels))
            for member in members:
                tree.append(member["node"])
            tree.root()
            steps = [[{"left": a, "right": b} for a, b in (*witness, *rest)] for witness in tree.witnesses]
            arrays = [pa.array([m[c] for m in members], types[c]) for c in out]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(steps, pa.list_(_STEP))], names=[*out, "witness"])

    rows_columns = rows.columns
    types = {f.name: {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string()}[f.dataType.simpleString()] for f in rows.select(*out).schema}
    return _in_order(rows).mapInArrow(climb, schema)


def positions(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with `position` (from 0, by `order` inside the tree) and `size` (rows of the tree)."""
    placed = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    # its upper bits are the partition; written, so that they stay what they are
    placed = written(placed.withColumn("at", F.monotonically_increasing_id()))
    counts = placed.groupBy(F.col(tree).alias("part_tree"), F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("part_tree")  # a row for each partition
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("part_tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))
    counts = written(counts)
    joined = placed.join(counts, (placed[tree] == counts["part_tree"]) & (F.shiftright(placed["at"], 33) == counts["part"]))
    return joined.select(*rows.columns, (F.col("at") + F.col("shift")).alias("position"), "size")


def _climbed(nodes: DataFrame, block_levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of every round (tree, position, size, node), and the trees' roots (tree, node)."""
    rounds = [nodes]
    longest = nodes.agg(F.max("size")).first()[0] or 1
    while longest > 1:
        rounds.append(written(_roots(rounds[-1], block_levels)))
        longest = -(-longest // ARITY**block_levels)
    return rounds, rounds[-1].select("tree", "node")


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    doc_id: str = "doc_id",
    carried: dict[str, Column] | None = None,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """(doc_id, carried..., leaf, position, subroot, root, witness) of every row.

    `carried`: text columns to be computed from the row where its leaf is, as the
    row's fields are read once.
    """
    prepare(docs.sparkSession)
    carried = carried or {}
    # null first, then by UTF-8 bytes
    tree = F.when(F.col(f"`{group}`").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")))
    leaves = docs.select(tree.alias("tree"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), leaf_of(*[F.col(f"`{c}`") for c in fields]).alias("node"), *[c.alias(f"carried_{k}") for k, c in carried.items()])
    more = [f"carried_{k}" for k in carried]
    leaves = positions(written(leaves), "tree", ["doc_id", "node", *more])
    rounds, subroots = _climbed(leaves.select("tree", "position", "size", "node"), block_levels)

    # the roots of the groups are the leaves of one more tree
    groups = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node")
    groups = positions(groups, "tree", ["of"])
    top, root = _climbed(groups.select("tree", "position", "size", "node"), block_levels)
    above = None
    for nodes in reversed(top[1:-1]):
        above = written(_with_witnesses(nodes, above, block_levels, []))
    above = written(_with_witnesses(groups.select("tree", "position", "size", "node", "of"), above, block_levels, ["of"]))
    above = above.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("position"), "witness")
    for nodes in reversed(rounds[1:-1]):
        above = written(_with_witnesses(nodes, above, block_levels, []))
    found = _with_witnesses(leaves, above, block_levels, ["doc_id", *more]).join(subroots.withColumnRenamed("node", "subroot"), "tree")
    one = root.first()
    found = found.withColumn("root", F.lit(one["node"] if one else None).cast("string"))
    return found.select("doc_id", *[F.col(f"carried_{k}").alias(k) for k in carried], F.col("node").alias("leaf"), "position", "subroot", "root", "witness")
