"""Hashes that decide equality: no text pair that a polynomial modulo 2**64 confuses, no pair of parts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from orderweave.llm import lines, lm, minhash, quality, substrings, suffixes
from orderweave.llm.texts import byte_sums, sequences_hash, spans_hash, stretches_hash

from .corpora import by_id, frame
from .test_dedup import brute_bytes, brute_words


def thue_morse(n: int, letters: str = "ab") -> str:
    return "".join(letters[bin(k).count("1") & 1] for k in range(n))


PAIRS = [(thue_morse(n), thue_morse(n, "ba")) for n in (1024, 2048, 4096)]


def test_the_pair_is_one_that_prefix_sums_confuse():
    for one, other in PAIRS:
        data = np.frombuffer((one + other).encode(), np.uint8)
        starts, ends = np.array([0, len(one)]), np.array([len(one), 2 * len(one)])
        assert len(set(spans_hash(byte_sums(data), starts, ends).tolist())) == 1
        assert len(set(stretches_hash(data, starts, ends, 3).tolist())) == 2


def test_stretches_hash_depends_on_bytes_length_and_seed_alone():
    rng = random.Random(4)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(0, 70), 127, 128, 129, 136, 1000]]
    texts += [b"a" * n for n in range(1, 300)] + [bytes(n) for n in range(1, 300)]
    texts = sorted(set(texts))
    order = rng.sample(texts * 3, 3 * len(texts))
    offsets = np.cumsum([0, *map(len, order)])
    data = np.frombuffer(b"".join(order), np.uint8)
    for seed in (0, 1, 1 << 62):
        found = stretches_hash(data, offsets[:-1], offsets[1:], seed).tolist()
        by_text = {t: {h for x, h in zip(order, found, strict=True) if x == t} for t in texts}
        assert all(len(h) == 1 for h in by_text.values())
        assert len(set(found)) == len(texts)
    one, two = (set(stretches_hash(data, offsets[:-1], offsets[1:], seed).tolist()) for seed in (5, 6))
    assert not one & two


@pytest.mark.parametrize("size", [1, 2, 3, 5, 13, 25, 50])
def test_sequences_hash(size):
    rng = np.random.default_rng(size)
    values = rng.integers(0, 2, 4000).astype(np.uint64)
    found = sequences_hash(values, size, 9)
    windows = [tuple(values[k : k + size].tolist()) for k in range(len(values) - size + 1)]
    assert len(found) == len(windows)
    assert len(set(found.tolist())) == len(set(windows)) == len(set(zip(windows, found.tolist(), strict=True)))
    assert len(sequences_hash(values[: size - 1], size)) == 0


@pytest.mark.parametrize("pair", PAIRS[::2])
def test_different_texts_are_not_copies(spark, pair):
    one, other = pair
    fifty = [" ".join(f"{x}{k}" if k % 7 else x for k in range(50)) for x in pair]
    rows = [(1, "first\n" + one), (2, "second\n" + other), (3, one), (4, other), (5, fifty[0]), (6, fifty[1])]
    cut = by_id(lines.without_repeated_runs(frame(spark, rows), 1).selectExpr("row.doc_id as doc_id", "lines.n_removed as n_removed"), "n_removed")
    assert {i: n for i, (n,) in cut.items()} == {1: 0, 2: 0, 3: 1, 4: 1, 5: 0, 6: 0}
    assert by_id(substrings.removed_words(frame(spark, rows)), "n_words", "n_removed", "kept") == brute_words(rows, 50)
    found = by_id(suffixes.removed_bytes(frame(spark, rows[:4])), "n_bytes", "n_removed", "n_spans", "kept")
    assert {k: (*v[:3], bytes(v[3])) for k, v in found.items()} == brute_bytes(rows[:4], 50)
    groups = by_id(minhash.grouped(frame(spark, rows)), "component_id")
    assert {i: c for i, (c,) in groups.items()} == {i: i for i, _ in rows}


def test_rules_and_counts_tell_the_pair_apart(spark):
    one, other = PAIRS[0]
    made = quality.rules(pa.array([f"{one}\n{other}", f"{one} x y {other} x y", f"{one}\n{one}"]))
    assert made["n_dup_lines"].tolist() == [0, 0, 1]
    assert made["n_repeat_words"].tolist() == [0, 0, 0]
    train, held = (next(i for i in range(100) if (zlib.crc32(str(i).encode()) % 7 == 2) is part) for part in (False, True))
    got = by_id(lm.scored(frame(spark, [(train, one), (held, f"{other} {one}")])), "n_tokens", "n_known")
    assert got[held] == (3, 2)  # one of the two and the end
