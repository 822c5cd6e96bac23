"""LM scoring with an Elias-Fano bigram trie, sharded by context.

Tokens are lower-cased words and one end per text. Every chunk of documents sends
its distinct bigrams with their training counts to shards, by context; a context
that fills more than a shard's share of the tokens is split over several. A shard
adds the counts up, builds its trie (`eliasfano.py`) and answers each bigram it got
with a one-byte code of the bigram's share of its context, and each context with its
count. The chunk scores its texts with the answers, so neither counts nor tries
leave Spark's shuffles.

    p(w | v) = (1 - r) * count(v w) / count(v) + r * p(w)

r is the share of new successors to expect behind contexts as frequent as v: the
discounted share of distinct bigrams among all bigrams of such contexts, by powers of
two of the count (of v itself, where it was split). p(w) is the word's share of the
training tokens; a share as large as that of words seen once is kept for unseen ones.

Defined results: a null text is empty and has one token, its end; a null id counts
as the empty text for the training rule; repeated rows count as often as they occur.
Without training documents, every probability is that of an unseen word.
A very long text is scored whole, in the chunk that holds it; words are compared by
64-bit hashes under a seed drawn for the run, successors of one context by 40 bits of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Dealt, ask, deal, released, shard_starts
from .eliasfano import Trie
from .spark import prepare
from .texts import NOT_SPACE, flat, fresh_seed, lower_ascii, mix, slices, stretches_hash, word_spans

CHUNK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
_START, _END = np.uint64(0x5157), np.uint64(0xE4D)
_CLASSES = 64
#: Bits of a successor's hash; it has to tell the successors of one context apart.
_NEXT_BITS = 40
_ASKED = "shard long, chunk long, routes binary, fans binary, next4 binary, next1 binary, counts binary, large binary"
_ANSWER = "chunk long, shard long, totals binary, codes binary, stats binary"


def is_training(ids: pa.Array) -> np.ndarray:
    """Ids whose crc32, as text, leaves another remainder than 2 on division by 7."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2 for i in ids.to_pylist()], bool)


def _words(column: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    data = lower_ascii(data)
    starts, ends, bounds = word_spans(data, offsets, NOT_SPACE)
    return stretches_hash(data, starts, ends, seed), bounds


@dataclass
class Plan:
    """What all chunks agree on: token numbers and the contexts that are split."""

    tokens: int
    texts: int
    hot: np.ndarray  # ascending
    parts: np.ndarray
    shards: int
    seed: int  # of the words' hashes

    def routes(self, context: np.ndarray, following: np.ndarray) -> np.ndarray:
        """Where a bigram goes: its context, or one part of it."""
        routes = mix(context)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, context), len(self.hot) - 1)
            split = self.hot[at] == context
            part = following[split] % self.parts[at[split]].astype(np.uint64)
            routes[split] = mix(routes[split] + part + np.uint64(1))
        return routes


def _survey(docs: DataFrame, doc_id: str, text: str, shards: int) -> Plan:
    """Training token numbers, and contexts with more than half a shard's share of them.

    A task reports a word only if it makes up half a shard's share of what the task
    read; a word that frequent in the corpus is so in some task. What is reported is
    a lower bound, good enough to split by; at most 2 * shards words remain.
    """
    prepare(docs.sparkSession)
    seed = fresh_seed()

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total, texts = {}, 0, 0
        for batch in slices(batches, text):
            words, bounds = _words(batch.column(text), seed)
            train = is_training(batch.column(doc_id))
            words = np.sort(words[np.repeat(train, np.diff(bounds))])
            new = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.zeros(0, np.int64)
            counts = np.diff(np.r_[new, len(words)])
            total, texts = total + len(words), texts + int(train.sum())
            often = counts * 2 * shards >= len(words)
            for word, n in zip(words[new[often]].view(np.int64).tolist(), counts[often].tolist(), strict=True):
                seen[word] = seen.get(word, 0) + n
        seen = {w: n for w, n in seen.items() if 2 * n * 2 * shards >= total}
        starts = [(int(_START), texts), (None, total + texts)]
        rows = [*seen.items(), *starts]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], names=["word", "n"])

    counted = docs.select(doc_id, text).mapInArrow(survey, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    known = {r["word"]: r["n"] for r in counted.where(F.col("word").isNull() | (F.col("word") == int(_START))).collect()}
    tokens, texts = known.get(None, 0), known.get(int(_START), 0)
    rows = counted.where(F.col("word").isNotNull() & (F.col("n") * 2 * shards >= tokens)).collect()  # at most 2 * shards rows
    hot = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    n = np.array([r["n"] for r in rows], np.int64)
    order = np.argsort(hot)
    parts = np.maximum(2, -(-n * 2 * shards // max(tokens, 1)))
    kept = order if shards > 1 else order[:0]
    return Plan(tokens, texts, hot[kept], parts[kept], shards, seed)


class _Bigrams:
    """A chunk's tokens and its distinct bigrams in route order."""

    def __init__(self, rows: pa.Table, plan: Plan):
        self.chunk = rows["chunk"][0].as_py() if rows.num_rows else 0
        self.rows = rows
        words, bounds = [], [np.zeros(1, np.int64)]
        for batch in slices(rows.to_batches()):
            own, own_bounds = _words(batch.column("text"), plan.seed)
            words.append(own)
            bounds.append(own_bounds[1:] + bounds[-1][-1])
        words, bounds = np.concatenate([*words, np.zeros(0, np.uint64)]), np.concatenate(bounds)
        n_texts = rows.num_rows
        self.train = is_training(rows["doc_id"].combine_chunks())
        # a start before and an end after each text's words
        self.text = np.repeat(np.arange(n_texts), np.diff(bounds) + 1)
        self.last = bounds[1:] + np.arange(n_texts)
        tokens = np.full(len(self.text), _END, np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[self.last] = False
        tokens[inner] = words
        contexts = np.empty_like(tokens)
        contexts[1:] = tokens[:-1]
        contexts[bounds[:-1] + np.arange(n_texts)] = _START
        self.contexts = contexts
        following = tokens >> np.uint64(64 - _NEXT_BITS)
        self.route, key = _keys(plan.routes(contexts, following), following)
        order = np.argsort(key)
        ordered = key[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]] if len(key) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        train = self.train[self.text[order]].astype(np.int64)
        self.counts = np.add.reduceat(train, starts) if len(starts) else np.zeros(0, np.int64)
        self.next = ordered[starts] & np.uint64((1 << _NEXT_BITS) - 1)
        self.context_of = (ordered[starts] >> np.uint64(_NEXT_BITS)).astype(np.int64)  # by bigram
        self.fans = np.bincount(self.context_of, minlength=len(self.route)).astype(np.int32)
        self.bigram = np.empty(len(order), np.int64)  # by token
        self.bigram[order] = np.cumsum(new) - 1

    def request(self, shards: int) -> pa.Table:
        cuts = np.searchsorted(self.route, shard_starts(shards))
        ends = np.r_[cuts[1:], len(self.route)]
        bound = np.concatenate([[0], np.cumsum(self.fans)])
        columns: dict[str, list] = {c.split()[0]: [] for c in _ASKED.split(", ")}
        for shard in np.flatnonzero(ends > cuts).tolist():
            a, b = int(cuts[shard]), int(ends[shard])
            x, y = int(bound[a]), int(bound[b])
            counts = self.counts[x:y]
            packed = (
                self.route[a:b],
                self.fans[a:b],
                (self.next[x:y] & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                (self.next[x:y] >> np.uint64(32)).astype(np.uint8),
                np.minimum(counts, 255).astype(np.uint8),
                counts[counts >= 255],
            )
            for column, value in zip(columns.values(), (shard, self.chunk, *(p.tobytes() for p in packed)), strict=True):
                column.append(value)
        types = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
        return pa.table([pa.array(v, t) for v, t in zip(columns.values(), types, strict=True)], names=list(columns))


def _keys(contexts: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct contexts, ascending; by bigram a key that sorts by context, then successor)."""
    order = np.argsort(contexts)
    ordered = contexts[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]] if len(order) else np.zeros(0, bool)
    number = np.empty(len(order), np.uint64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], (number << np.uint64(_NEXT_BITS)) | following


def _unpacked(rows: pa.Table, column: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(rows[column])
    return np.frombuffer(data.tobytes(), kind), offsets // np.dtype(kind).itemsize


class _Asked:
    """What the chunks sent to a shard, and its distinct bigrams in order."""

    def __init__(self, rows: pa.Table):
        self.routes, self.route_bounds = _unpacked(rows, "routes", np.uint64)
        fans, _ = _unpacked(rows, "fans", np.int32)
        low, self.bounds = _unpacked(rows, "next4", np.uint32)
        high, _ = _unpacked(rows, "next1", np.uint8)
        counts = _unpacked(rows, "counts", np.uint8)[0].astype(np.int64)
        counts[counts == 255] = _unpacked(rows, "large", np.int64)[0]
        context, number = _keys(self.routes, np.zeros(len(self.routes), np.uint64))
        key = np.repeat(number, fans) | low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
        order = np.argsort(key)
        ordered = key[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.kind = np.empty(len(key), np.int64)  # by bigram as sent: its distinct one
        self.kind[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(key)]))
        self.counts = np.add.reduceat(counts[order], starts) if len(starts) else np.zeros(0, np.int64)
        self.context = context[(ordered[starts] >> np.uint64(_NEXT_BITS)).astype(np.int64)]
        self.following = ordered[starts] & np.uint64((1 << _NEXT_BITS) - 1)

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, successor, count) of the training bigrams, ascending, added up over the chunks."""
        seen = np.flatnonzero(self.counts)
        return self.context[seen], self.following[seen], self.counts[seen]


def _answer(rows: pa.Table) -> pa.Table:
    """Build the shard's trie and look up what was asked."""
    asked = _Asked(rows)
    trie = Trie(*asked.counted())
    totals = trie.total(trie.context(asked.routes))
    numbers, step = trie.context(asked.context), 1 << 18
    codes = [trie.successor(numbers[k : k + step], asked.following[k : k + step]) for k in range(0, len(numbers), step)]
    codes = np.concatenate(codes)[asked.kind] if codes else np.zeros(0, np.uint8)
    pieces = lambda values, cuts: [values[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    answers = {
        "chunk": rows["chunk"],
        "shard": rows["shard"],
        "totals": pa.array(pieces(totals, asked.route_bounds), pa.binary()),
        "codes": pa.array(pieces(codes, asked.bounds), pa.binary()),
        "stats": pa.nulls(rows.num_rows, pa.binary()),
    }
    return pa.table(answers)


def _stats(rows: pa.Table, hot_routes: np.ndarray) -> pa.Table:
    """Distinct bigrams and tokens by class of context, numbers of singletons, words."""
    asked = _Asked(rows)
    context, _, added = asked.counted()
    heads = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.zeros(0, np.int64)
    distinct = np.diff(np.r_[heads, len(context)])
    totals = np.add.reduceat(added, heads) if len(heads) else np.zeros(0, np.int64)
    names = context[heads]
    whole = ~np.isin(names, hot_routes)
    start = names == mix(np.array([_START]))[0]
    kinds = np.floor(np.log2(np.maximum(totals, 1))).astype(np.int64)
    out = []  # (kind, name, distinct, tokens)
    for kind in np.unique(kinds[whole]).tolist():
        of = whole & (kinds == kind)
        out.append((kind, 0, int(distinct[of].sum()), int(totals[of].sum())))
    words = whole & ~start
    out.append((_CLASSES, 0, int(words.sum()), int((words & (totals == 1)).sum())))
    out.append((_CLASSES + 1, 0, int((added == 1).sum()), int((added == 2).sum())))
    for k in np.flatnonzero(~whole).tolist():
        out.append((_CLASSES + 2, int(names[k : k + 1].view(np.int64)[0]), int(distinct[k]), int(totals[k])))
    return pa.table([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["kind", "name", "distinct", "tokens"])


class _Model:
    """What a chunk needs besides its answers, from the shards' statistics."""

    def __init__(self, plan: Plan, stats: np.ndarray):
        kind, name, distinct, tokens = stats
        self.plan, self.tokens = plan, plan.tokens
        words = kind == _CLASSES
        once, twice = distinct[kind == _CLASSES + 1].sum(), tokens[kind == _CLASSES + 1].sum()
        discount = once / max(once + 2 * twice, 1)
        #: Share of new successors by class of context.
        self.new = np.full(_CLASSES, discount or 0.5)
        for k in range(_CLASSES):
            of = kind == k
            if of.any():
                self.new[k] = discount * distinct[of].sum() / tokens[of].sum()
        self.new = np.clip(self.new, 1e-4, 1 - 1e-4)
        names, parts = name[kind == _CLASSES + 2].astype(np.int64).view(np.uint64), kind == _CLASSES + 2
        part_distinct, part_tokens = distinct[parts], tokens[parts]
        owners, routes = _hot_routes(plan)
        owner = owners[np.argsort(routes)][np.searchsorted(np.sort(routes), names)] if len(names) else np.zeros(0, np.int64)
        self.hot_count = np.bincount(owner, part_tokens, len(plan.hot)).astype(np.int64)
        hot_distinct = np.bincount(owner, part_distinct, len(plan.hot))
        self.hot_new = np.clip(discount * hot_distinct / np.maximum(self.hot_count, 1), 1e-4, 1 - 1e-4)
        hot_words = (self.hot_count > 0) & (plan.hot != _START)
        #: Distinct training words with the end, and words seen once.
        self.types = int(distinct[words].sum()) + int(hot_words.sum()) + (1 if self.tokens else 0)
        once = int(tokens[words].sum())
        self.unseen = min(max(once / max(self.tokens, 1), 1 / (self.tokens + self.types + 1)), 0.5)


def _hot_routes(plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(number of the split context, route) of all its parts."""
    owner = np.repeat(np.arange(len(plan.hot)), plan.parts)
    part = np.arange(len(owner)) - np.repeat(np.cumsum(plan.parts) - plan.parts, plan.parts)
    return owner, mix(mix(plan.hot[owner]) + part.astype(np.uint64) + np.uint64(1))


def _scored(rows: pa.Table, given: pa.Table, plan: Plan) -> pa.Table:
    own = _Bigrams(rows, plan)
    held = given.filter(pa.compute.is_valid(given["stats"]))
    stats = np.frombuffer(held["stats"][0].as_buffer(), np.int64).reshape(4, -1) if held.num_rows else np.zeros((4, 0), np.int64)
    model = _Model(plan, stats)
    given = given.filter(pa.compute.is_null(given["stats"])).sort_by("shard")
    totals, codes = _unpacked(given, "totals", np.int64)[0], _unpacked(given, "codes", np.uint8)[0]
    n_texts = rows.num_rows
    # counts of the contexts, whole ones by themselves, split ones from the statistics
    part_total = totals[own.context_of][own.bigram]
    context_total, new = part_total.copy(), model.new[np.floor(np.log2(np.maximum(part_total, 1))).astype(np.int64)]
    if len(plan.hot):
        at = np.minimum(np.searchsorted(plan.hot, own.contexts), len(plan.hot) - 1)
        split = plan.hot[at] == own.contexts
        context_total[split], new[split] = model.hot_count[at[split]], model.hot_new[at[split]]
    # a word's count is that of the context it makes for the next token
    count = np.empty_like(context_total)
    count[:-1] = context_total[1:]
    ends = np.zeros(len(count), bool)
    ends[own.last] = True
    count[ends] = plan.texts  # each training text has one end
    share = np.where(count > 0, count / max(model.tokens, 1) * (1 - model.unseen), model.unseen)
    joint = Trie.share(codes[own.bigram]) * part_total
    p = np.where(context_total > 0, (1 - new) * joint / np.maximum(context_total, 1) + new * share, share)
    base = np.log10((count + 1) / (model.tokens + model.types + 1))
    return pa.table(
        {
            "doc_id": own.rows["doc_id"],
            "held_out": pa.array(~own.train),
            "n_tokens": pa.array(np.bincount(own.text, minlength=n_texts), pa.int64()),
            "n_known": pa.array(np.bincount(own.text, count > 0, n_texts).astype(np.int64)),
            "train_tokens": pa.array(np.full(n_texts, model.tokens, np.int64)),
            "base_score": pa.array(np.bincount(own.text, base, n_texts), pa.float64()),
            "score": pa.array(np.bincount(own.text, np.log10(p), n_texts), pa.float64()),
        }
    )


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    dealt = deal(docs, doc_id, text, chunk_bytes)
    shards = max(1, dealt.n_bytes // shard_bytes)
    plan = _survey(dealt.docs, "doc_id", "text", shards)
    _, hot_routes = _hot_routes(plan)
    asked = ask(dealt, [], lambda rows, _: _Bigrams(rows, plan).request(shards), _ASKED)
    by_shard = asked.groupBy("shard")
    answers = by_shard.applyInArrow(lambda rows: released(_answer(rows)), _ANSWER)
    stats = by_shard.applyInArrow(lambda rows: released(_stats(rows, hot_routes)), "kind long, name long, distinct long, tokens long")
    fields = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return ask(dealt, [answers, _for_all_chunks(dealt, stats)], lambda rows, given: _scored(rows, given, plan), fields)


def _for_all_chunks(dealt: Dealt, stats: DataFrame) -> DataFrame:
    """The added-up statistics, some rows for all shards together, as one packed row for each chunk."""
    rows = stats.groupBy("kind", "name").agg(F.sum("distinct").alias("distinct"), F.sum("tokens").alias("tokens"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [np.stack([b.column(c).to_numpy() for c in ("kind", "name", "distinct", "tokens")]) for b in batches]
        if own:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(own, axis=1).tobytes()], pa.binary())], names=["stats"])

    packed = rows.coalesce(1).mapInArrow(pack, "stats binary")
    chunks = dealt.docs.select((F.col("chunk") + 0).alias("chunk")).distinct().select("chunk", packed.scalar().alias("stats"))
    nothing = F.lit(None)
    return chunks.select("chunk", nothing.cast("long").alias("shard"), nothing.cast("binary").alias("totals"), nothing.cast("binary").alias("codes"), "stats")
