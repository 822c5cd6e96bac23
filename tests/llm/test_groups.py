"""Near-dedup, components, chat formatting, the pipeline and the registered queries."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from checks.compare import differences, duckdb_over
from orderweave.llm import chat, minhash
from orderweave.llm.graph import components
from orderweave.llm.queries import QUERIES, SQL

from .corpora import by_id, corpus, frame, words

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(DATA).is_dir(), reason="test tables not present")


def brute_groups(rows, percent=85):
    sets = {}
    for i, t in rows:
        w = words(t, lower=True)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n):
    """Copies of one text that are near the text but not near each other, and a chain of copies of copies."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    rows = [(500, " ".join(base))]
    for k in range(n):
        own = list(base)
        for x in rng.sample(range(300), 6):
            own[x] = f"own{k}x{x}"
        rows.append((k if k % 2 else 1000 + k, " ".join(own)))
    own = list(base)
    for k in range(12):
        own[25 * k] = f"chain{k}"
        rows.append((2000 - k, " ".join(own)))
    return rows


@pytest.mark.parametrize("rows", [corpus(1), corpus(2, 120), near_copies(3, 40), [(i, "same text of six words here") for i in range(30)]])
def test_groups(spark, rows):
    got = by_id(minhash.grouped(frame(spark, rows)), "n_shingles", "component_id")
    assert got == brute_groups(rows)
    left = minhash.deduplicated(frame(spark, rows))
    assert sorted(r[0] for r in left.select("doc_id").collect()) == sorted(i for i, (_, c) in got.items() if i == c)
    assert left.columns == frame(spark, rows).columns


def pairs_at(percent, n, seed=5):
    """Pairs of texts of 600 words that share just `percent` of their shingles or a few more; no words but a pair's own."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        base = [f"p{k}w{j}" for j in range(600)]
        changed = 596 - -(-596 * 2 * percent // (100 + percent))  # shingles that may differ
        other = list(base)
        for j in range(changed // 5):
            other[10 + 10 * j] = f"p{k}x{j}"
        rows += [(1000 + 2 * k, " ".join(base)), (1001 + 2 * k, " ".join(other))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("rows", "percent"), [(pairs_at(80, 250), 80), (pairs_at(50, 250), 50), (corpus(6, 120), 80), (near_copies(4, 40), 80)])
def test_groups_at_other_thresholds(spark, rows, percent):
    sets = {i: c for i, (_, c) in brute_groups(rows, percent).items()} if len(rows) < 300 else {i: i - i % 2 for i, _ in rows}
    assert by_id(minhash.grouped(frame(spark, rows), percent), "component_id") == {i: (c,) for i, c in sets.items()}


def test_pipeline_drops_near_copies_at_80_percent(spark):
    rows = pairs_at(80, 20)
    left = corpus_pipeline.near_dedup(spark, frame(spark, rows), "")
    assert sorted(r[0] for r in left.select("doc_id").collect()) == [i for i in range(1000, 1040) if i % 2 == 0]


def test_bands_and_sketches_follow_the_threshold():
    assert (minhash.banding(85), minhash.sketch_bits(85)) == ((25, 5), 26)
    assert (minhash.banding(80), minhash.sketch_bits(80)) == ((31, 4), 31)
    for percent in (30, 50, 70, 90, 99):
        bands, rows = minhash.banding(percent)
        assert bands * rows <= minhash.SLOTS and (1 - (percent / 100) ** rows) ** bands < minhash.MISSED


def test_groups_of_repeated_and_missing_ids(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(9, a), (9, b), (4, a), (11, b), (None, a), (None, None), (20, None), (21, "")]
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in minhash.grouped(frame(spark, rows)).collect())
    assert got == [(0, 0, 0), (0, 2, 0), (4, 2, 4), (9, 2, 4), (9, 2, 4), (11, 2, 4), (20, 0, 20), (21, 0, 21)]
    assert minhash.grouped(frame(spark, [])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    for size, shared in ((1500, 1300), (300, 150), (40, 36), (5, 4), (1, 1)):
        agreed = []
        for _ in range(30):
            hashes = rng.integers(0, 1 << 63, 2 * size).astype(np.uint64)
            a, b = hashes[:size], hashes[size - shared : 2 * size - shared]
            s = minhash.signatures(np.repeat([0, 1], size), np.concatenate([a, b]), 2)
            agreed.append((s[0] == s[1]).mean())
        assert np.mean(agreed) == pytest.approx(shared / (2 * size - shared), abs=0.03)


def test_shingles_of_short_texts():
    owner, hashes = minhash.shingle_sets(pa.array(["a b", "A  b", "a b c d e", "", None, "a b c d e f a b c d e"]))
    assert np.bincount(owner, minlength=6).tolist() == [1, 1, 1, 0, 0, 6]
    assert hashes[0] == hashes[1]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(k, k + 1) for k in range(100, 140)] + [(300, k) for k in range(301, 330)]
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


TREE = "tree long, node long, parent long, role string, text string, score double"


def test_reply_tree(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0),
        (1, 2, 1, "assistant", "a", 1.0),
        (1, 3, 1, "assistant", "b", 3.0),
        (1, 4, 2, "user", "c", 5.0),
        (1, 5, 3, "user", "d", 3.0),
        (1, 6, 3, "user", "e", 3.0),
        (2, 1, 99, "user", None, None),  # parent not there
        (2, 2, 1, None, "x", 0.0),
        (3, 1, 2, "user", "cycle", 0.0),
        (3, 2, 1, "user", "cycle", 0.0),
        (None, 1, None, "user", "no tree", 0.0),
        (2, 2, 1, None, "x", 0.0),  # repeated
    ]
    df = spark.createDataFrame(rows, TREE)
    got = {(r.tree, r.branch): (r.leaf, r.score, r.formatted) for r in chat.formatted(df).collect()}
    turn = lambda role, text: f"### {role}: {text}</turn>\n"
    assert got == {
        (1, 1): (4, 6.0, turn("user", "q") + turn("assistant", "a") + turn("user", "c")),
        (1, 2): (5, 6.0, turn("user", "q") + turn("assistant", "b") + turn("user", "d")),
        (1, 3): (6, 6.0, turn("user", "q") + turn("assistant", "b") + turn("user", "e")),
        (2, 1): (2, 0.0, turn("user", "") + turn("", "x")),
    }
    assert [r.leaf for r in chat.formatted(df, branches=1).where("tree = 1").collect()] == [4]
    assert chat.formatted(df.where("false")).count() == 0


def test_long_thread_and_control_strings(spark):
    texts = ["\\### Assistant: </turn> ok", "####", "</turn></turn>\n", "\\\\h\\t", "", "é🎉: ###", "###\\", "<", "/turn>"]
    roles = ["user", "assistant", "a: b", "###", "", "\\c"]
    rows = [(1, k, k - 1 if k else None, roles[k % len(roles)], texts[k % len(texts)], 0.0) for k in range(150)]
    made = chat.formatted(spark.createDataFrame(rows, TREE).repartition(3))
    r = made.select(chat.turns_of(made["formatted"]).alias("turns"), chat.masked(made["formatted"], made["mask"]).alias("loss")).first()
    assert [(t.role, t.text) for t in r.turns] == [(x[3], x[4]) for x in rows]
    assert r.loss == "".join(x[4] for x in rows if x[3] == "assistant")


def test_conversations_with_ties_and_nulls(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "system", "first"), (1, 0, "user", "a"), (2, 5, None, None), (None, 1, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.formatted(chat.as_messages(df))
    got = {r.tree: [(t.role, t.text) for t in r.turns] for r in made.select("tree", chat.turns_of(made["formatted"]).alias("turns")).collect()}
    assert got == {1: [("system", "first"), ("user", "a"), ("user", "a"), ("user", "b")], 2: [("", "")]}


def test_chat_runs_no_python(spark):
    plan = chat.formatted(chat.as_messages(chat.probe(spark)))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@needs_data
def test_pipeline(spark):
    """Every stage keeps the documents' columns, and only drops what its operator says."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        now = {r[0] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and now <= seen and now, name
        seen = now
    final = corpus_pipeline.run(spark, DATA)
    assert {r[0] for r in final.select("doc_id").collect()} == seen


def test_stages_take_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    from orderweave.llm import bpe, decontaminate, lines, quality

    items = spark.createDataFrame([], "item_id long, text string")
    stages = [quality.without_rejected(docs, labels), lines.cut_documents(docs), minhash.deduplicated(docs)]
    for made in (*stages, decontaminate.without_contaminated(docs, items)):
        assert made.columns == docs.columns and made.count() == 0
    assert bpe.encoded(docs).count() == 0


@needs_data
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    found = differences(QUERIES[name](spark, DATA), duckdb_over(DATA), SQL[name])
    assert found is None, found


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
