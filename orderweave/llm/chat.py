r"""Chat formatting: reply trees to conversations, with DataFrame operations only.

Messages (tree, node, parent, role, text, score) form reply trees. Iterative self-joins
double the distance that a message knows an ancestor at, until every message knows its
root and the score of its path; the leaves' paths are ranked by score. The same
ancestor tables, read from the largest distance down, list the messages of the chosen
paths: about 2 * log2(depth) joins however deep a tree is.

A path becomes one text: per turn `### role: text</turn>` and a newline. In texts and
roles `\` becomes `\b`, `###` becomes `\h`, `</turn>` becomes `\t`, and in roles `:`
becomes `\c`; no control string is left in them, and reading back reverses it. The loss
mask is the list of character ranges that assistant texts take in the formatted text.

Defined results: null role or text count as empty; a null score as 0; messages without
tree or node are ignored; of rows that share tree and node the least stays; a parent
that is not in the tree makes its message a root; messages on a cycle are on no path. Ranks
tie by leaf. An empty table gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spark import written

HEAD, END = "### ", "</turn>\n"
#: Control strings and their codes, in the order they are escaped.
CODES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
ROLE_CODES = (*CODES, (":", "\\c"))


def _escaped(text: Column, codes: tuple[tuple[str, str], ...] = CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def _unescaped(text: Column, codes: tuple[tuple[str, str], ...] = CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def ancestors(messages: DataFrame) -> list[DataFrame]:
    """By k: (tree, node, above, total, size), the ancestor 2**k up, and the scores on the way to it.

    A table holds the trees that need it: those of more than 2**(k-1) messages. In the
    last table of its tree a message has reached the root, or is on a cycle.
    """
    known = messages.select("tree", F.col("node").alias("above"), F.lit(True).alias("there"))
    sizes = messages.groupBy("tree").agg(F.count("*").alias("size"))
    first = messages.select("tree", "node", F.col("parent").alias("above"), F.col("score").alias("total")).join(known, ["tree", "above"], "left").join(sizes, "tree")
    tables = [written(first.select("tree", "node", F.when(F.col("there"), F.col("above")).alias("above"), "total", "size"))]
    largest = tables[0].agg(F.max("size")).first()[0] or 1
    while 1 << (len(tables) - 1) < largest:
        near = tables[-1].where(F.col("size") > 1 << (len(tables) - 1))
        far = near.select("tree", F.col("node").alias("above"), F.col("above").alias("next"), F.col("total").alias("more"))
        joined = near.join(far, ["tree", "above"], "left")
        tables.append(written(joined.select("tree", "node", F.col("next").alias("above"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"), "size")))
    return tables


def _messages(messages: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = messages.select("tree", "node", "parent", text("role").alias("role"), text("text").alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    rows = rows.where("tree is not null and node is not null")
    least = F.min(F.struct("parent", "role", "text", "score")).alias("m")
    return rows.groupBy("tree", "node").agg(least).select("tree", "node", "m.*")


def paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree, leaf, branch, score, back, node): the messages of the chosen paths, `back` steps above the leaf.

    `branches`: how many of a tree's paths to keep, best scores first; None keeps all.
    """
    tables = ancestors(messages)
    parents = tables[0].where("above is not null").select("tree", F.col("above").alias("node")).distinct()
    ends = tables[0].where("above is null and size <= 1").select("tree", "node", "total")
    for k, table in enumerate(tables[1:], 1):
        ends = ends.union(table.where((F.col("size") <= 1 << k) & F.col("above").isNull()).select("tree", "node", "total"))
    leaves = ends.join(parents, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), F.col("total").alias("score"))
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    leaves = leaves.withColumn("branch", F.row_number().over(best))
    if branches is not None:
        leaves = leaves.where(F.col("branch") <= branches)
    members = written(leaves.select("tree", "leaf", "branch", "score", F.lit(0).cast("long").alias("back"), F.col("leaf").alias("node")))
    for k in reversed(range(len(tables))):
        up = tables[k].where("above is not null").select("tree", "node", "above")
        further = members.join(up, ["tree", "node"]).select("tree", "leaf", "branch", "score", (F.col("back") + (1 << k)).alias("back"), F.col("above").alias("node"))
        members = written(members.unionByName(further))
    return members


def formatted(messages: DataFrame, branches: int | None = None, learn_role: str = "assistant") -> DataFrame:
    """(tree, leaf, branch, score, formatted, mask): one row per chosen path.

    `mask`: (first, length) of each text of `learn_role` in `formatted`, in characters.
    """
    messages = written(_messages(messages))
    turns = paths(messages, branches).join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    head = F.concat(F.lit(HEAD), _escaped(F.col("role"), ROLE_CODES), F.lit(": "))
    turns = turns.withColumn("body", _escaped(F.col("text"))).withColumn("piece", F.concat(head, "body", F.lit(END)))
    path = Window.partitionBy("tree", "leaf").orderBy(F.desc("back"))
    before = F.coalesce(F.sum(F.length("piece")).over(path.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    span = F.struct((before + F.length(head)).cast("long").alias("first"), F.length("body").cast("long").alias("length"))
    turns = turns.withColumn("span", F.when(F.col("role") == learn_role, span))
    rows = turns.groupBy("tree", "leaf", "branch", "score").agg(F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("at"), "piece", "span"))).alias("turns"))
    return rows.select(
        "tree",
        "leaf",
        "branch",
        "score",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("mask"),
    )


def turns_of(text: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    pieces = F.split(text, "</turn>\n", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        colon = F.instr(piece, ": ")
        role = F.substring(piece, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1)
        return F.struct(_unescaped(role, ROLE_CODES).alias("role"), _unescaped(F.substring(piece, colon + 2, F.length(piece))).alias("text"))

    return F.transform(pieces, turn)


def masked(text: Column, mask: Column) -> Column:
    """The texts under the mask, unescaped and joined."""
    return F.array_join(F.transform(mask, lambda s: _unescaped(F.substring(text, (s["first"] + 1).cast("int"), s["length"].cast("int")))), "")


def as_messages(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as trees: each turn replies to the one before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    rows = conversations.where("conv_id is not null").withColumn("node", node)
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select(F.col("conv_id").alias("tree"), "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def probe(spark: SparkSession) -> DataFrame:
    """A conversation whose texts hold the template's control strings."""
    text = "\\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(text).alias("text"))
