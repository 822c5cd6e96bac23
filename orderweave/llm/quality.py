"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Words and word pairs are hashed into `BUCKETS` slots. Two multinomials are
counted over them: one over the trusted documents (all those labelled good), one over
every document. A document's score is the mean of log(target / raw) over its n-grams.
The threshold comes from all labelled documents: as many standard deviations below the
median score of the trusted ones as the midpoint to the median of the distrusted ones, but
at least `SPREAD` of them, so that ordinary documents stay. The quartiles it rests on
are exact: Spark orders the scores by ranges. Every document gets a verdict by the same comparison.

What is collected is bounded: two vectors of `BUCKETS` counts, a row of each range
of scores, and the two scores beside each quartile.

Defined results: a null text has no words; a document without words scores 0;
without labelled rows every document passes the ratio test. Labels with a null
id or quality are ignored, and an id labelled both ways counts as distrusted. Of a
labelled id with several texts, all are counted and the least score enters the
threshold. Repeated rows are judged alike. Very long texts are judged whole, in a slice
of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .spark import filter_texts, map_texts, prepare, rows_with_ids, written
from .texts import NOT_SPACE, byte_table, covered, flat, fresh_seed, sequence_in, sequences_hash, slices, stretches_hash, word_spans

BUCKETS = 1 << 16
SPREAD = 4.0
SMOOTHING = 1.0
_SLOTS = 6
_ID_BITS = 1 << 25

_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[list(b"[#*$%&|<>]"[1:-1])] = 1
_NEW_CODE_POINT = (~byte_table((0x80, 0xBF))).astype(np.int64)


def _sums(values: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums


class _Slice:
    """The words of a slice."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = flat(column)
        self.starts, self.ends, self.bounds = word_spans(self.data, self.offsets, NOT_SPACE)
        self.owner = sequence_in(self.bounds)

    def words(self, seed: int) -> np.ndarray:
        return stretches_hash(self.data, self.starts, self.ends, seed)

    def windows(self, words: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of the windows that lie within one text."""
        hashes = sequences_hash(words, size, seed)
        last = len(self.owner) - size + 1
        whole = np.flatnonzero(self.owner[: max(last, 0)] == self.owner[size - 1 :]) if last > 0 else np.zeros(0, np.int64)
        return whole, hashes[whole]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, slot) of each word and word pair; slots stay what they are from run to run."""
        words = self.words(_SLOTS)
        first, pairs = self.windows(words, 2, _SLOTS)
        return np.concatenate([self.owner, self.owner[first]]), np.concatenate([words, pairs]) >> np.uint64(64 - BUCKETS.bit_length() + 1)


def rules(column: pa.Array, seed: int | None = None) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text; `seed`: of the hashes that compare."""
    return _rules(_Slice(column), fresh_seed() if seed is None else seed)


def _rules(s: _Slice, seed: int) -> dict[str, np.ndarray]:
    n_texts = len(s.offsets) - 1
    points = _sums(_NEW_CODE_POINT[s.data])
    chars = _sums(points[s.ends] - points[s.starts])
    symbols = _sums(_SYMBOLS[s.data])
    return {
        "n_words": np.diff(s.bounds).astype(np.int64),
        "word_chars": chars[s.bounds[1:]] - chars[s.bounds[:-1]],
        "n_symbols": symbols[s.offsets[1:]] - symbols[s.offsets[:-1]],
        "n_dup_lines": _repeated_lines(s, n_texts, seed),
        "n_repeat_words": _repeated_words(s, n_texts, seed),
    }


def _repeated_lines(s: _Slice, n_texts: int, seed: int) -> np.ndarray:
    if not len(s.data):
        return np.zeros(n_texts, np.int64)
    breaks = np.flatnonzero(s.data == 0x0A)
    starts = np.union1d(s.offsets[:-1], breaks + 1)
    starts = starts[starts < len(s.data)]
    ends = np.minimum(np.r_[starts[1:], len(s.data)], len(s.data))
    ends = ends - (s.data[ends - 1] == 0x0A)  # a piece ends with its text or with a break
    with_word = np.searchsorted(s.starts, ends) > np.searchsorted(s.starts, starts)
    starts, ends = starts[with_word], ends[with_word]
    text = np.searchsorted(s.offsets, starts, "right") - 1
    hashes = stretches_hash(s.data, starts, ends, seed)
    order = np.lexsort((hashes, text))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.bincount(text[order][1:][same], minlength=n_texts).astype(np.int64)


def _repeated_words(s: _Slice, n_texts: int, seed: int) -> np.ndarray:
    first, hashes = s.windows(s.words(seed), 3, seed)
    order = np.lexsort((hashes, s.owner[first]))
    same = (hashes[order][1:] == hashes[order][:-1]) & (s.owner[first][order][1:] == s.owner[first][order][:-1])
    often = np.zeros(len(first), bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    hit = covered(len(s.owner), first[often], first[often] + 3)
    return np.bincount(s.owner[hit], minlength=n_texts).astype(np.int64)


def failed(made: dict[str, np.ndarray]) -> np.ndarray:
    """The base rules: too short, or mostly repeated three-word windows."""
    return (made["n_words"] < 50) | (100 * made["n_repeat_words"] > 50 * made["n_words"])


def _labelled(docs: DataFrame, seen: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, quality, text) of every row whose id is labelled, in a table, as two passes read it.

    A bit table of the ids keeps most other texts out of the shuffle, the join decides.
    """
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ids = seen.select(F.col("labelled").alias("id"))
    near = rows_with_ids(texts, ids, lambda batch: batch.select(["doc_id", "text"]), "doc_id long, text string", bits=_ID_BITS)
    return written(near.join(seen.hint("merge"), F.col("doc_id") == F.col("labelled")).select("doc_id", "quality", "text"))


def _counts(docs: DataFrame, text: str) -> np.ndarray:
    """n-grams of the documents, by slot."""
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, text):
            totals += np.bincount(_Slice(batch.column(text)).grams()[1], minlength=BUCKETS)
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], names=["slot", "n"])

    parts = docs.select(F.col(f"`{text}`")).mapInArrow(count, "slot long, n long")
    rows = parts.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows
    totals = np.zeros(BUCKETS, np.int64)
    totals[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return totals


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """By slot: log of its share in the target over its share in the raw corpus.

    The raw corpus is smoothed in proportion to its size, so that an n-gram too rare
    to be in the target tells nothing, whatever part of the corpus the target is.
    """
    scale = raw.sum() / max(target.sum(), 1)
    return np.log((target + SMOOTHING) / (raw / max(scale, 1e-12) + SMOOTHING))


def _scores(s: _Slice, ratio: np.ndarray) -> np.ndarray:
    owner, slot = s.grams()
    n = np.bincount(owner, minlength=len(s.offsets) - 1)
    return np.bincount(owner, ratio[slot], minlength=len(s.offsets) - 1) / np.maximum(n, 1)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[np.ndarray, float]:
    """(log ratio by slot, threshold), both from every labelled document."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    seen = known.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("labelled"), "quality")
    if seen.where("quality = 1").isEmpty():
        return np.zeros(BUCKETS), -np.inf
    labelled = _labelled(docs, seen, doc_id, text)
    ratio = log_ratio(_counts(labelled.where("quality = 1"), "text"), _counts(docs, text))
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(batch: pa.RecordBatch) -> dict[str, object]:
        s = _Slice(batch.column("text"))
        return {"score": np.where(np.diff(s.bounds) > 0, _scores(s, shared.value), np.nan)}

    scored = map_texts(labelled, score, "score double", ("doc_id", "quality"), "text").where("not isnan(score)")
    return ratio, _threshold(scored.groupBy("doc_id", "quality").agg(F.min("score").alias("score")))


def _quantiles(scored: DataFrame, wanted: dict[int, tuple[float, ...]]) -> dict[int, list[float]]:
    """By quality: the quantiles of the scores, exact, between two neighbours in proportion; none without scores.

    The distinct scores are counted and range-partitioned; the driver learns the size of each range,
    and Spark counts on inside those that hold a wanted place.
    """
    distinct = scored.groupBy("quality", "score").agg(F.count(F.lit(1)).alias("n"))
    ranges = distinct.repartitionByRange("quality", "score")
    values = written(ranges.select(F.spark_partition_id().alias("part"), "quality", "score", "n"))
    held = values.groupBy("quality", "part").agg(F.sum("n").alias("n"), F.min("score").alias("least")).collect()  # one a range
    places: dict[int, list[float]] = {}
    begins: dict[int, list[tuple[int, int]]] = {}
    for quality, fractions in wanted.items():
        parts = sorted((r["least"], r["part"], r["n"]) for r in held if r["quality"] == quality)
        ends = np.cumsum([n for _, _, n in parts])
        places[quality] = [f * (ends[-1] - 1) for f in fractions] if parts else []
        begins[quality] = [(part, int(end) - n) for (_, part, n), end in zip(parts, ends, strict=True)]
    at = {q: sorted({int(x) for p in found for x in (np.floor(p), np.ceil(p))}) for q, found in places.items()}
    chosen = {(q, next((part, begin) for part, begin in reversed(begins[q]) if begin <= place)) for q, found in at.items() for place in found}
    if not chosen:
        return {q: [] for q in wanted}
    begin = F.lit(None).cast("long")
    for q, (part, first) in chosen:
        begin = F.when((F.col("quality") == q) & (F.col("part") == part), F.lit(first)).otherwise(begin)
    inside = values.withColumn("begin", begin).where("begin is not null")
    end = F.col("begin") + F.sum("n").over(Window.partitionBy("quality", "part").orderBy("score"))
    inside = inside.withColumn("end", end)
    here = F.lit(False)
    for q, found in at.items():
        for place in found:
            here = here | ((F.col("quality") == q) & (F.col("end") > place) & (F.col("end") - F.col("n") <= place))
    rows = inside.where(here).collect()  # at most two for each quantile

    def value(q: int, place: int) -> float:
        return next(r["score"] for r in rows if r["quality"] == q and r["end"] - r["n"] <= place < r["end"])

    def between(q: int, place: float) -> float:
        low, high = value(q, int(np.floor(place))), value(q, int(np.ceil(place)))
        return low + (high - low) * (place - np.floor(place))

    return {q: [between(q, place) for place in found] for q, found in places.items()}


def _threshold(scored: DataFrame) -> float:
    """From (quality, score) of the labelled ids."""
    found = _quantiles(scored, {1: (0.25, 0.5, 0.75), 0: (0.5,)})
    if not found[1]:
        return -np.inf
    lower, middle, upper = found[1]
    low = middle - SPREAD * max((upper - lower) / 1.349, 1e-9)
    return float(min(low, (middle + found[0][0]) / 2)) if found[0] else float(low)


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the rule counts, base_failed, the score, its threshold and the verdict `kept`."""
    ratio, threshold = fit(docs, labels, doc_id=doc_id, text=text)
    shared, seed = docs.sparkSession.sparkContext.broadcast(ratio), fresh_seed()

    def judge(batch: pa.RecordBatch) -> dict[str, object]:
        s = _Slice(batch.column(text))
        made = _rules(s, seed)
        bad, scores = failed(made), _scores(s, shared.value)
        return made | {"base_failed": bad, "score": scores, "threshold": np.full(len(bad), threshold), "kept": ~bad & (scores >= threshold)}

    fields = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, threshold double, kept boolean"
    return map_texts(docs, judge, fields, (doc_id,), text)


def without_rejected(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    ratio, threshold = fit(docs, labels, doc_id=doc_id, text=text)
    shared, seed = docs.sparkSession.sparkContext.broadcast(ratio), fresh_seed()

    def passes(batch: pa.RecordBatch) -> np.ndarray:
        s = _Slice(batch.column(text))
        return ~failed(_rules(s, seed)) & (_scores(s, shared.value) >= threshold)

    return filter_texts(docs, passes, text)
