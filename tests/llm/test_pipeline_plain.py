"""The whole pipeline, and the threshold of the quality rules, against plain versions of the stages."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from orderweave.llm import quality
from orderweave.llm.texts import sequences_hash, stretches_hash

from .corpora import ALNUM, by_id, frame, words
from .test_dedup import brute_lines
from .test_groups import brute_groups
from .test_texts import brute_rules

DATA = "/root/testdata/sf0.001"
SHIFT = 64 - quality.BUCKETS.bit_length() + 1


def grams(text):
    """Slots of the words and word pairs, one by one."""
    hashes = []
    for w in words(text):
        data = np.frombuffer(w, np.uint8)
        hashes.append(stretches_hash(data, np.array([0]), np.array([len(w)]), quality._SLOTS)[0])
    pairs = [sequences_hash(np.array(p, np.uint64), 2, quality._SLOTS)[0] for p in zip(hashes, hashes[1:], strict=False)]
    return [int(h) >> SHIFT for h in (*hashes, *pairs)]


def plain_quality(rows, labels):
    """By row: (score, threshold, kept)."""
    worst = {}
    for i, q in labels:
        if i is not None and q is not None:
            worst[i] = min(q, worst.get(i, q))
    good, bad = ({i for i, q in worst.items() if q == kind} for kind in (1, 0))
    if not good:
        return [(0.0, -math.inf, not failed(t)) for _, t in rows]
    of = [grams(t) for _, t in rows]
    target, raw = Counter(), Counter()
    for (i, _), g in zip(rows, of, strict=True):
        raw.update(g)
        if i in good:
            target.update(g)
    scale = max(sum(raw.values()) / max(sum(target.values()), 1), 1e-12)
    ratio = {s: math.log((target[s] + 1) / (raw[s] / scale + 1)) for s in raw}
    scores = [sum(ratio[s] for s in g) / max(len(g), 1) for g in of]
    least = defaultdict(lambda: math.inf)
    for (i, t), s in zip(rows, scores, strict=True):
        if i in good | bad and words(t):
            least[i] = min(least[i], s)
    of_good, of_bad = (np.array([s for i, s in least.items() if i in kind]) for kind in (good, bad))
    threshold = -math.inf
    if len(of_good):
        middle, spread = np.median(of_good), np.subtract(*np.percentile(of_good, [75, 25])) / 1.349
        threshold = middle - 4 * max(spread, 1e-9)
        if len(of_bad):
            threshold = min(threshold, (middle + np.median(of_bad)) / 2)
    return [(s, threshold, not failed(t) and s >= threshold) for (_, t), s in zip(rows, scores, strict=True)]


def failed(text):
    n_words, _, _, _, repeated = brute_rules(text)
    return n_words < 50 or 100 * repeated > 50 * n_words


def plain_clean(rows, items, size=10):
    """Documents without a window of an item."""
    windows = set()
    for item, t in items:
        w = words(t, ALNUM, True)
        if item is not None and w:
            n = min(size, len(w))
            windows |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    sizes = {len(w) for w in windows}
    kept = []
    for i, t in rows:
        w = words(t, ALNUM, True)
        if not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1)):
            kept.append((i, t))
    return kept


def test_threshold_and_verdicts(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"g{k}" for k in rng.integers(0, 60, rng.integers(40, 160)))) for i in range(60)]
    rows += [(100 + i, " ".join(f"b{k}" for k in rng.integers(0, 60, 90))) for i in range(30)]
    # labelled ids with several texts, in another order each time
    rows += [(3, " ".join(f"b{k}" for k in range(60))), (100, rows[0][1]), (3, None), (None, rows[1][1]), (7, "")]
    labels = [(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(12)] + [(5, 0), (None, 1), (40, None)]
    expected = plain_quality(rows, labels)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int")
    thresholds = set()
    for order in (1, -1):
        got = quality.judged(frame(spark, rows[::order], 5), labelled).collect()
        thresholds |= {r.threshold for r in got}
        key = lambda x: (x[0] is None, x[0] or 0, round(x[1], 9), x[2])
        assert sorted(((r.doc_id, round(r.score, 9), r.kept) for r in got), key=key) == sorted(((i, round(s, 9), k) for (i, _), (s, _, k) in zip(rows, expected, strict=True)), key=key)
    assert max(thresholds) == pytest.approx(min(thresholds), rel=1e-12) == pytest.approx(expected[0][1], rel=1e-9)


@pytest.mark.skipif(not Path(DATA).is_dir(), reason="test tables not present")
def test_pipeline_is_its_five_plain_stages(spark):
    read = lambda name, *columns: [tuple(r) for r in spark.read.parquet(f"{DATA}/{name}.parquet").select(*columns).collect()]
    rows = read("documents", "doc_id", "text")
    verdicts = plain_quality(rows, read("labels", "doc_id", "quality"))
    rows = [r for r, (_, _, kept) in zip(rows, verdicts, strict=True) if kept]
    cut = brute_lines(rows, 1)
    rows = [(i, found[4]) for i, (found,) in cut.items() if found[1] == 0 or found[1] < found[0]]
    groups = brute_groups(rows, 80)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    rows = plain_clean(rows, read("benchmark", "item_id", "text"))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    expected = {i: (x, library.decode(x, skip_special_tokens=False)) for i, x in ids.items()}
    got = by_id(corpus_pipeline.run(spark, DATA), "ids", "decoded")
    assert len(expected) > 20 and got == expected
