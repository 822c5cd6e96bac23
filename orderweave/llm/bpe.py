"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

The words that are most frequent in the corpus (counted over all documents; the
`LEXICON` most frequent are kept) are encoded once and compiled into a minimal
acyclic automaton: equal suffixes share their states, and the number of words
below each state numbers the words, so that a walk ends at the word's ids. The
automaton is a few flat arrays in one file that each worker maps into memory. A
word outside the lexicon is merged exactly by the tokenizer's ranks.

A text is cut at its special tokens and at white space; no rule of the tokenizer
reaches over either, so each piece is normalised, split and encoded on its own. New
words of a slice are merged together, and a task remembers some pieces (`REMEMBERED`).

Supported are tokenizer files with a BPE model with an end-of-word suffix, byte
alphabet, NFC and lower-casing, no decoder: decoded are the token strings, joined
by one space.

Defined results: a null text counts as empty; an empty or blank text has no
tokens and decodes to the empty text. Rows are encoded one by one, so repeated
rows and null ids keep their own rows.
"""

from __future__ import annotations

import json
import mmap
import re
import struct
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.normalizers import NFC, Lowercase
from tokenizers.pre_tokenizers import Split

from .spark import map_texts, prepare, written
from .texts import NOT_SPACE, byte_sums, flat, slices, spans_hash, word_spans

LEXICON = 1 << 15
REMEMBERED = 400_000

#: Unicode's white space, as the tokenizer's \s has it.
_SPACE = "\t-\r \x85\xa0  -     　"
#: Beyond ASCII, character classes follow the tokenizer library's Unicode version, not Python's.
_NFC = NFC().normalize_str
_LOWER = Lowercase().normalize_str
_PIECE = re.compile(f"[^{_SPACE}]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Merges:
    """The tokenizer's rules, applied word by word."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern)
        self.split_unicode = Split(Regex(pattern), "removed", invert=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.names = {i: token for token, i in [*self.ids.items(), *self.special.items()]}
        self.alphabet = byte_alphabet()

        # pairs in ascending order of (left id, right id), for lookups of many pairs at once
        rows = sorted((self.ids[a] << 32 | self.ids[b], rank, self.ids[a + b]) for (a, b), rank in self.ranks.items())
        self._pairs, ranks, self._joined = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        self._rank_of = np.append(ranks, len(ranks))  # no pair ranks last
        self._inner = np.array([self.ids[c] for c in self.alphabet], np.int64)
        self._final = np.array([self.ids[c + self.suffix] for c in self.alphabet], np.int64)

    def words(self, piece: str) -> list[str]:
        """The words of a piece without white space, normalised."""
        if piece.isascii() or max(piece) < "\u0250":  # composed already, and of the same classes in every Unicode version
            piece = piece.lower()
            return [piece] if piece.isalpha() else self.split.findall(piece)
        return [word for word, _ in self.split_unicode.pre_tokenize_str(_LOWER(_NFC(piece)))]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of words: in each round every word merges its pair of lowest rank, from left to right."""
        data = [w.encode() for w in words]
        sizes = np.array([len(d) for d in data], np.int64)
        symbols = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum(sizes) - 1
        symbols, last = self._inner[symbols], symbols[ends]
        symbols[ends] = self._final[last]
        owner = np.repeat(np.arange(len(words)), sizes)
        none = len(self._pairs)
        place = np.full(len(symbols), none)  # by symbol: the pair it makes with the next one
        fresh = np.arange(len(symbols))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            # only pairs with a new symbol have changed
            fresh = fresh[fresh < len(symbols) - 1]
            keys = symbols[fresh] << 32 | symbols[fresh + 1]
            at = np.minimum(np.searchsorted(self._pairs, keys), none - 1)
            place[fresh] = np.where((self._pairs[at] == keys) & (owner[fresh + 1] == owner[fresh]), at, none)
            place[-1] = none
            rank = self._rank_of[place]
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            counts = np.diff(np.append(begins, len(owner)))
            least = np.minimum.reduceat(rank, begins)
            going = np.repeat(least < none, counts)
            here = np.flatnonzero((rank == np.repeat(least, counts)) & going)
            # of overlapping equal pairs, every second one
            run = np.flatnonzero(np.r_[True, np.diff(here) != 1]) if len(here) else here
            here = here[(np.arange(len(here)) - np.repeat(run, np.diff(np.append(run, len(here))))) % 2 == 0] if len(here) else here
            symbols[here] = self._joined[place[here]]
            keep = going.copy()
            keep[here + 1] = False
            done.append((owner[~going], symbols[~going]))
            changed = np.zeros(len(symbols), bool)
            changed[here] = True
            changed[np.maximum(here - 1, 0)] = True
            changed[np.maximum(here - 2, 0)] = True  # the one before may go with its own pair
            owner, symbols, place = owner[keep], symbols[keep], place[keep]
            fresh = np.flatnonzero(changed[keep])
        owner, symbols = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (owner, symbols)
        order = np.argsort(owner, kind="stable")
        return symbols[order].astype(np.int32), np.searchsorted(owner[order], np.arange(len(words) + 1))


class Lexicon:
    """A minimal acyclic transducer from words to ids, in one memory-mapped file."""

    _HEADER = struct.Struct("<4q")

    @staticmethod
    def compile(entries: dict[bytes, list[int]]) -> bytes:
        """The file's bytes."""
        words = sorted(entries)
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []  # (final, ((label, target), ...))
        known: dict[tuple[bool, tuple[tuple[int, int], ...]], int] = {}

        def minimal(final: bool, edges: list[tuple[int, int]]) -> int:
            key = (final, tuple(edges))
            if key not in known:
                known[key] = len(states)
                states.append(key)
            return known[key]

        path: list[list] = [[False, [], 0]]  # by depth: final, finished edges, label that leads here
        last = b""
        for word in [*words, None]:
            common = 0 if word is None else next((i for i, (a, b) in enumerate(zip(last, word, strict=False)) if a != b), min(len(last), len(word)))
            while len(path) > common + 1:
                final, edges, label = path.pop()
                path[-1][1].append((label, minimal(final, edges)))
            if word is not None:
                path += [[False, [], label] for label in word[common:]]
                path[-1][0] = True
                last = word
        root = minimal(path[0][0], path[0][1])
        below = np.zeros(len(states), np.int64)  # words that a state accepts; targets precede their sources
        for i, (final, edges) in enumerate(states):
            below[i] = final + sum(below[t] for _, t in edges)
        edges = np.array([state << 8 | label for state, (_, found) in enumerate(states) for label, _ in found], np.int64)
        targets = np.array([t for _, found in states for _, t in found], np.int64)
        skipped = np.array([int(final) + sum(below[x] for _, x in found[:k]) for final, found in states for k in range(len(found))], np.int64)
        finals = np.array([final for final, _ in states], np.int64)
        bounds = np.cumsum([0, *(len(entries[w]) for w in words)]).astype(np.int64)
        ids = np.array([i for w in words for i in entries[w]], np.int32)
        head = Lexicon._HEADER.pack(len(states), len(edges), len(words), root)
        return head + b"".join(x.tobytes() for x in (edges, targets, skipped, finals, bounds, ids))

    def __init__(self, source: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(source)
            file.flush()
            region = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        self.n_states, n_edges, n_words, self.root = self._HEADER.unpack_from(region)
        at, found = self._HEADER.size, []
        for n in (n_edges, n_edges, n_edges, self.n_states, n_words + 1):
            found.append(np.frombuffer(region, np.int64, n, at))
            at += 8 * n
        self._edges, self._targets, self._skipped, self._finals, self.bounds = found
        self.ids = np.frombuffer(region, np.int32, self.bounds[-1], at)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The numbers of the words, -1 for those it does not have; all words walk in step."""
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        state, number = np.full(len(words), self.root), np.zeros(len(words), np.int64)
        found = np.full(len(words), -1, np.int64)
        walking, step = np.arange(len(words)), 0
        while len(walking):
            ended = sizes[walking] == step
            last = walking[ended]
            found[last] = np.where(self._finals[state[last]] > 0, number[last], -1)
            walking = walking[~ended]
            if not len(walking) or not len(self._edges):
                break
            key = state[walking] << 8 | data[starts[walking] + step]
            edge = np.minimum(np.searchsorted(self._edges, key), len(self._edges) - 1)
            there = self._edges[edge] == key
            walking, edge = walking[there], edge[there]
            number[walking] += self._skipped[edge]
            state[walking] = self._targets[edge]
            step += 1
        return found


class Encoder:
    """Whole texts to ids and back. Ids are packed, four bytes each."""

    def __init__(self, source: str, lexicon: bytes | None = None):
        self.merges = Merges(source)
        self.lexicon = Lexicon(lexicon or Lexicon.compile({}))
        self._ids: dict[str, bytes] = {}
        names = [self.merges.names.get(i, "").encode() + b" " for i in range(max(self.merges.names) + 1)]
        self._names = np.frombuffer(b"".join(names), np.uint8)
        self._sizes = np.array([len(n) for n in names], np.int64)
        self._begins = np.cumsum(self._sizes) - self._sizes

    def encode(self, texts: list[str]) -> list[bytes]:
        """By text: its packed ids."""
        cut, special = self.merges.cut, self.merges.special
        found = []
        for text in texts:
            if cut and cut.search(text):
                found.append([p for part in cut.split(text) for p in ([part] if part in special else _PIECE.findall(part))])
            else:
                found.append(_PIECE.findall(text))
        if len(self._ids) >= REMEMBERED:
            self._ids.clear()
        self._ids.update({content: np.int32(i).tobytes() for content, i in special.items()})
        self._learn(list(set().union(*found).difference(self._ids)))
        ids = self._ids.__getitem__
        return [b"".join(map(ids, pieces)) for pieces in found]

    def forget(self) -> None:
        """Drop what a task has remembered."""
        self._ids = {}

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts that ids[bounds[t]:bounds[t + 1]] decode to: token strings, joined by one space."""
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        data = self._names[np.arange(sizes.sum()) + np.repeat(self._begins[ids] - (ends - sizes), sizes)]
        keep = np.ones(len(data), bool)
        full = bounds[1:][np.diff(bounds) > 0]
        keep[ends[full - 1] - 1] = False  # no space after the last token
        cuts = np.concatenate([[0], ends])[bounds] - np.concatenate([[0], np.cumsum(np.diff(bounds) > 0)])
        return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[keep])))

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces: words of the lexicon by the automaton, the others by the merges, all at once."""
        words_of = list(map(self.merges.words, pieces))
        words = list({w for words in words_of for w in words})
        number = self.lexicon.find([w.encode() for w in words])
        known = np.flatnonzero(number >= 0)
        unseen = np.flatnonzero(number < 0)
        bounds = self.lexicon.bounds
        packed = _packed([words[k] for k in known.tolist()], self.lexicon.ids, bounds[number[known]], bounds[number[known] + 1])
        rest = [words[k] for k in unseen.tolist()]
        if rest:
            ids, cuts = self.merges.merged(rest)
            packed |= _packed(rest, ids, cuts[:-1], cuts[1:])
        self._ids.update({p: packed[own[0]] if len(own) == 1 else b"".join([packed[w] for w in own]) for p, own in zip(pieces, words_of, strict=True)})


def _packed(words: list[str], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[str, bytes]:
    data = ids.tobytes()
    return {w: data[a:b] for w, a, b in zip(words, (4 * starts).tolist(), (4 * ends).tolist(), strict=True)}


_encoders: dict[str, Encoder] = {}


def _encoder(name: str, shared) -> Encoder:
    """The worker's encoder: its tables outlive a task."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(*shared.value)
    return _encoders[name]


class Pieces:
    """Counts of the runs without ASCII white space in the texts added so far."""

    def __init__(self):
        self._hashes = np.zeros(0, np.uint64)
        self._counts = np.zeros(0, np.int64)
        self._number = np.zeros(0, np.int64)  # of the text
        self._texts: list[str] = []

    @property
    def distinct(self) -> int:
        return len(self._texts)

    def add(self, column: pa.Array) -> None:
        data, offsets = flat(column)
        starts, ends, _ = word_spans(data, offsets, NOT_SPACE)
        hashes = spans_hash(byte_sums(data), starts, ends)
        order = np.argsort(hashes)
        ordered = hashes[order]
        heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(order) else order
        found, counts, first = ordered[heads], np.diff(np.r_[heads, len(order)]), order[heads]
        at = np.searchsorted(self._hashes, found)
        known = np.zeros(len(found), bool)
        inside = at < len(self._hashes)
        known[inside] = self._hashes[at[inside]] == found[inside]
        self._counts[at[known]] += counts[known]
        new = ~known
        raw = data.tobytes()
        numbers = np.arange(len(self._texts), len(self._texts) + new.sum())
        self._texts += [raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
        place = np.argsort(np.concatenate([self._hashes, found[new]]), kind="stable")
        self._hashes = np.concatenate([self._hashes, found[new]])[place]
        self._counts = np.concatenate([self._counts, counts[new]])[place]
        self._number = np.concatenate([self._number, numbers])[place]

    def taken(self) -> list[tuple[str, int]]:
        """What was counted; counting begins anew."""
        counts = np.empty_like(self._counts)
        counts[self._number] = self._counts
        found = list(zip(self._texts, counts.tolist(), strict=True))
        self.__init__()
        return found


def word_counts(docs: DataFrame, source: str, text: str = "text") -> DataFrame:
    """(word, n): normalised words of all documents."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(source)

    def rows(pieces: Pieces, merges: Merges) -> pa.RecordBatch:
        words: dict[str, int] = {}
        for run, n in pieces.taken():
            for piece in _PIECE.findall(run):
                for word in merges.words(piece):
                    words[word] = words.get(word, 0) + n
        return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, pieces = Merges(shared.value), Pieces()
        for batch in slices(batches, text):
            pieces.add(batch.column(text))
            if pieces.distinct > REMEMBERED:
                yield rows(pieces, merges)
        yield rows(pieces, merges)

    return docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_lexicon(docs: DataFrame, source: str, size: int = LEXICON, text: str = "text") -> bytes:
    """The transducer of the most frequent words: all above a count that at most `size` words reach."""
    words = written(word_counts(docs, source, text).where("n > 1 and length(word) <= 64"))
    step = F.floor(F.log2("n") * 32).cast("int")
    steps = sorted(((r["step"], r["count"]) for r in words.groupBy(step.alias("step")).count().collect()), reverse=True)  # at most 2048 rows
    least, total = None, 0
    for value, count in steps:
        if total + count > size:
            break
        least, total = value, total + count
    chosen = [] if least is None else sorted(r["word"] for r in words.where(step >= least).collect())
    return compiled(Merges(source), chosen)


def compiled(merges: Merges, words: list[str]) -> bytes:
    """The transducer of the words."""
    ids, cuts = merges.merged(words) if words else (np.zeros(0, np.int32), np.zeros(1, np.int64))
    ids = ids.tolist()
    return Lexicon.compile({w.encode(): ids[a:b] for w, a, b in zip(words, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)})


def encoded(docs: DataFrame, path: str | None = None, size: int = LEXICON, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): token ids of each whole text and the text they decode to."""
    with open(path or default_tokenizer(), encoding="utf-8") as file:
        source = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((source, fit_lexicon(docs, source, size, text)))
    name = uuid.uuid4().hex

    def encode(batch: pa.RecordBatch) -> dict[str, object]:
        encoder = _encoder(name, shared)
        packed = encoder.encode([t or "" for t in batch.column(text).to_pylist()])
        bounds = np.cumsum([0, *(len(x) // 4 for x in packed)])
        ids = np.frombuffer(b"".join(packed), np.int32)
        return {"ids": pa.ListArray.from_arrays(bounds.astype(np.int32), ids), "decoded": encoder.decode(ids, bounds)}

    finish = lambda: _encoder(name, shared).forget()
    return map_texts(docs, encode, "ids array<int>, decoded string", (doc_id,), text, finish=finish)
