"""Mixing sources to target weights by entropy balancing.

A document's size is its number of words. Sources, ordered by code point with null last,
weigh 1, 2, 3, 1, ... and share all words of the corpus by weight; no target is above
`MOST` times its source's size, and what that leaves is shared again by weight.

Document rates are those nearest to one copy each, in relative entropy, that meet the
token constraint of every source and stay at or below `MOST`: rate = min(MOST,
exp(tilt * size)), with one tilt for each source, the solution of the convex dual. Newton
steps on the dual run over all sources at once: Spark sums words and their derivative
over cells (source, size, number of documents), and a step that leaves the bracket known
so far is replaced by its middle. The sums are decimals, so the order of the rows does not
change them and reruns agree to the last bit.

Rates become copies cell by cell, from large sizes to small ones: the documents of a cell
take the number of copies nearest to their rates' sum and to what the larger sizes left
over, between the whole numbers about the rate; a rest that no cell could take is settled
from the largest size down. Documents of equal size and source get copies as equal as
possible; a hash of id and text says which have one more. So a source misses its target by
less than its smallest documents, where these can be taken or left at all.

A source's cells are worked on in one task: their number is that of the distinct sizes, at
most the words of the longest text, however many documents there are. Documents are never
gathered: those of one cell are numbered by parts of their hash, first the parts, then the
documents inside each; there are as many parts as a part has documents, more or less.

Defined results: a null text has no words; sources without words have the target 0, and
take nothing; null is a source of its own. Rows without an id are taken as any other.
Repeated rows count as often as they occur, and share their cell's copies. A text of any
length is counted whole. Without rows there is no result. Only the columns named are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .merkle import positions
from .spark import prepare, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
ROUNDS = 60
#: Newton stops once all sources are as near to their targets.
TOLERANCE = 1e-9


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """`sizes` (source, size) with `weight` and `target`; one row for each source."""
    key = F.when(F.col("source").isNull(), F.lit("=")).otherwise(F.concat(F.lit("-"), F.col("source")))  # null last
    placed = positions(sizes.select(F.lit("").alias("tree"), key.alias("key"), "source", "size").withColumnRenamed("size", "words"), "tree", ["key"])
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    rows = written(placed.select("source", F.col("words").alias("size"), weight.alias("weight")))
    # the level: words for each unit of weight, among the sources that are below their limit
    total = rows.agg(F.sum("size")).first()[0] or 0
    level, n_full = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("size") * F.lit(most * level[1]).cast("decimal(38,0)") <= F.col("weight") * F.lit(level[0]).cast("decimal(38,0)")
        found = rows.agg(F.sum(F.when(full, F.col("size"))), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        left = (total - most * (found[0] or 0), found[1] or 0)
        if found[2] == n_full or not left[1]:
            break
        level, n_full = left, found[2]
    if level is None:
        return rows.withColumn("target", F.lit(0.0))
    below = F.col("weight") * F.lit(float(level[0])) / F.lit(float(level[1]))
    return rows.withColumn("target", F.when(full, (F.col("size") * most).cast("double")).otherwise(below.cast("double")))


def _tilts(cells: DataFrame, sources: DataFrame, most: int, rounds: int, tolerance: float) -> DataFrame:
    """(source, target, longest, tilt): sizes are tilted as parts of the longest; null: every document at `most`."""
    ends = cells.where("size > 0").groupBy("source").agg(F.max("size").alias("longest"), F.min("size").alias("shortest"))
    state = sources.withColumnRenamed("size", "words").join(ends, sources["source"].eqNullSafe(ends["source"]), "left").drop(ends["source"])
    # at this end of the bracket every rate is on the target's side of target / words
    end = F.expr("ln(target / words) * longest / shortest")
    open_ = F.expr(f"words > 0 and target < {most} * words")
    state = state.select(
        "source",
        "target",
        "words",
        "longest",
        open_.alias("open"),
        F.when(open_, F.least(end, F.lit(0.0))).alias("low"),
        F.when(open_, F.greatest(end, F.lit(0.0))).alias("high"),
        F.when(open_, F.lit(0.0)).alias("tilt"),
        F.lit(1.0).alias("off"),
    )
    state = written(state)
    rows = cells.where("size > 0")
    for _ in range(rounds):
        known = state.where("open").select(F.col("source").alias("of"), "longest", "tilt")
        part = rows.join(known, rows["source"].eqNullSafe(known["of"]))
        part = part.withColumn("rate", F.expr("exp(tilt * size / longest)")).withColumn("taken", F.expr(f"n * size * least({most}D, rate)"))
        slope = F.expr(f"if(rate < {most}, taken * size / longest, 0D)")
        exact = "decimal(30,8)"
        sums = part.groupBy("of").agg(F.sum(F.col("taken").cast(exact)).cast("double").alias("taken"), F.sum(slope.cast(exact)).cast("double").alias("slope"))
        joined = state.join(sums, state["source"].eqNullSafe(sums["of"]), "left")
        low, high = F.expr("if(taken <= target, tilt, low)"), F.expr("if(taken >= target, tilt, high)")
        joined = joined.select("source", "target", "words", "longest", "open", low.alias("low"), high.alias("high"), "tilt", F.expr("tilt + try_divide(target - taken, slope)").alias("step"), F.expr("abs(try_divide(taken, target) - 1)").alias("off"))
        step = F.expr("if(step > low and step < high, step, (low + high) / 2)")
        near = F.col("off") <= tolerance
        state = written(joined.select("source", "target", "words", "longest", "open", "low", "high", F.when(near, F.col("tilt")).otherwise(step).alias("tilt"), "off"))
        if (state.where("open").agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    return state.select("source", "target", "longest", "tilt")


def whole_copies(sizes: np.ndarray, counts: np.ndarray, rates: np.ndarray, target: float, most: int = MOST) -> np.ndarray:
    """How many copies the documents of each cell get together; sizes fall."""
    # a rate within rounding of a whole number is that number
    least, extra = np.floor(rates + 1e-9), np.ceil(rates - 1e-9)
    copies, left = np.zeros(len(sizes), np.int64), 0.0
    wanted = counts * rates * sizes
    for k in range(len(sizes)):
        size, n = int(sizes[k]), int(counts[k])
        left += float(wanted[k])
        copies[k] = min(max(int(np.floor(left / size + 0.5)), int(least[k]) * n), int(extra[k]) * n)
        left -= float(copies[k]) * size
    # what is left, from large to small
    for k in range(len(sizes)):
        if abs(left) < sizes[k] / 2:
            continue
        more = int(np.clip(np.trunc(left / sizes[k]), -copies[k], most * counts[k] - copies[k]))
        copies[k] += more
        left -= float(more) * int(sizes[k])
    smallest = len(sizes) - 1  # the nearer of two neighbours
    if smallest >= 0 and abs(left) > sizes[smallest] / 2:
        copies[smallest] = min(max(copies[smallest] + int(np.sign(left)), 0), most * int(counts[smallest]))
    return copies


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) of every row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), n_words(F.col(f"`{text}`")).alias("size"), F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("mark"))
    rows = written(rows)
    cells = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    sources = targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("size")), weights, most)
    sources = written(sources)
    tilts = _tilts(cells, sources, most, rounds, tolerance).withColumnRenamed("source", "of")
    rate = F.expr(f"if(tilt is null, {most}D, least({most}D, exp(tilt * size / longest)))")
    rated = cells.join(tilts, cells["source"].eqNullSafe(tilts["of"])).where("size > 0").select("source", "size", "n", "target", rate.alias("rate"))

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size", ascending=False)
        frame["copies"] = whole_copies(frame["size"].to_numpy(), frame["n"].to_numpy(), frame["rate"].to_numpy(), float(frame["target"].iloc[0]), most)
        return frame[["source", "size", "n", "rate", "copies"]]

    settled = written(rated.groupBy("source").applyInPandas(settle, "source string, size long, n long, rate double, copies long"))
    settled = settled.select(F.col("source").alias("of"), F.col("size").alias("words"), "n", "rate", "copies")
    per_source = sources.select(F.col("source").alias("whose"), F.col("size").alias("source_size"), "target")

    # the documents of a cell, numbered by hash: first by its ranges, then inside a range
    placed = rows.join(settled, rows["source"].eqNullSafe(settled["of"]) & (rows["size"] == settled["words"]), "left")
    span = F.pmod(F.shiftrightunsigned("mark", 1), F.ceil(F.sqrt(F.coalesce("n", F.lit(1)))))
    placed = placed.select("doc_id", "source", "size", "rate", "copies", "n", "mark", span.alias("span"))
    each = placed.where("copies % n <> 0")
    spans = each.groupBy("source", "size", "span").agg(F.count("*").alias("k"))
    before = Window.partitionBy("source", "size").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(F.col("source").alias("of"), F.col("size").alias("words"), F.col("span").alias("part"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("source", "size", "span").orderBy("mark", "doc_id")
    each = each.withColumn("place", F.row_number().over(inside)).join(spans, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("words")) & (F.col("span") == F.col("part")))
    each = each.withColumn("copies", F.expr("copies div n + if(place + shift <= copies % n, 1, 0)"))
    alike = placed.where("copies is null or copies % n = 0").withColumn("copies", F.expr("coalesce(copies div n, 0)"))
    columns = ["doc_id", "source", "size", "rate", "copies"]
    found = each.select(*columns).unionByName(alike.select(*columns))
    found = found.join(per_source, found["source"].eqNullSafe(per_source["whose"]))
    return found.select("doc_id", "source", "size", "source_size", "target", F.coalesce("rate", F.lit(1.0)).alias("rate"), F.col("copies").cast("long").alias("copies"))


def taken() -> Column:
    """Words that the mix takes from a document, repeats counted."""
    return F.col("copies") * F.col("size")
