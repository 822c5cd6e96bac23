"""Merkle manifest, source mixing and embedding whitening against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderweave.llm import merkle, mixing, whitening

from .corpora import words

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, witness int, `a.b` double"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and every node's siblings left and right, level by level."""
    steps: list[list[tuple[str, str]]] = [[] for _ in nodes]
    members = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        above, joined = [], []
        for start in range(0, len(nodes), 3):
            run = nodes[start : start + 3]
            for at in range(len(run)):
                for leaf in members[start + at]:
                    steps[leaf].append(("".join(run[:at]), "".join(run[at + 1 :])))
            above.append(sha("".join(run)))
            joined.append([x for m in members[start : start + 3] for x in m])
        nodes, members = above, joined
    return nodes[0], steps


def documents(seed: int, sizes: dict[str | None, int]) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for k in range(n):
            text = rng.choice([None, "", "a\nb", "é\n" * rng.randint(0, 5), "word " * rng.randint(1, 400), "日本\r\n x"])
            rows.append((rng.choice([k * 7 - 3, None if k % 11 == 0 else k]), source, rng.choice([None, "en", "de"]), rng.choice([None, k]), text, "t", 1, 0.5))
    rows += rows[::5]  # repeated rows
    rng.shuffle(rows)
    return rows


MANY = {"b": 40, None: 9, "": 10, "é": 1, "=": 3, "B": 27}


@pytest.mark.parametrize(("sizes", "block_levels"), [(MANY, 1), (MANY, 2), (MANY, 7), ({"only": 1}, 7), ({"x": 100}, 1), ({f"s{k}": 1 for k in range(30)}, 2)])
def test_merkle(spark, sizes, block_levels):
    rows = documents(1, sizes)
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, sha("".join(map(plain_field, row[:5]))), row[0]))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf for _, _, leaf, _ in sorted(by_source[s], key=lambda r: r[:3])]) for s in order}
    root, tops = plain_tree([trees[s][0] for s in order])
    expected = Counter()
    for source, top in zip(order, tops, strict=True):
        for (_, _, leaf, doc_id), steps in zip(sorted(by_source[source], key=lambda r: r[:3]), trees[source][1], strict=True):
            expected[(doc_id, leaf, trees[source][0], root, tuple(steps + top))] += 1
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    made = merkle.manifest(df, block_levels=block_levels)
    checked = made.withColumn("again", merkle.folded(F.col("leaf"), F.col("witness"))).collect()
    assert all(r["again"] == root for r in checked)
    assert Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["witness"])) for r in checked) == expected


def test_merkle_nothing_and_tampering(spark):
    empty = spark.createDataFrame([], DOCS)
    assert merkle.manifest(empty).collect() == []
    df = spark.createDataFrame([(k, "s", None, k, f"line {k}\nnext", "t", 0, 0.0) for k in range(50)], DOCS)
    changed = merkle.leaf_of(*[F.col(c) for c in FIELDS[:4]], F.concat("text", F.lit("!")))
    made = merkle.manifest(df, carried={"changed": F.when(F.col("doc_id") == 17, changed)}).withColumn("seen", merkle.folded(F.coalesce("changed", "leaf"), F.col("witness")))
    assert [r["doc_id"] for r in made.where("seen <> root").collect()] == [17]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 100])
def test_appender_extends_witnesses_as_siblings_complete(n):
    nodes = [sha(str(k)) for k in range(n)]
    tree = merkle.Appender()
    for k, node in enumerate(nodes):
        tree.append(node)
        done = [w for w in tree.witnesses[: k - k % 3] if w]
        assert len(done) == k - k % 3  # every member of a completed run knows its siblings already
    assert (tree.root(), tree.witnesses) == plain_tree(nodes)


def plain_targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Shares by weight; what is above three times a source is shared again among the others."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, full, left = dict.fromkeys(order, 0.0), set(), float(sum(sizes.values()))
    while left > 1e-6:
        open_ = [s for s in order if s not in full]
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in open_:
            target[s] += share * weight[s]
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                full.add(s)
    return target


def plain_tilt(sizes: list[int], target: float) -> float:
    """By bisection: the tilt at which sum(size * min(3, exp(tilt * size))) is the target."""
    low, high = -50.0, 50.0
    for _ in range(200):
        middle = (low + high) / 2
        got = sum(s * min(3.0, math.exp(min(middle * s, 700.0))) for s in sizes)
        low, high = (middle, high) if got < target else (low, middle)
    return (low + high) / 2


MIX = "doc_id long, source string, text string, size int, rate string, of int, target int"


def mix_rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for source, n in {"hot": 300, "b": 60, "a": 5, None: 40, "Z": 25, "é": 1, "blank": 3}.items():
        for k in range(n):
            text = None if source == "blank" or k % 17 == 16 else " ".join(["w"] * rng.choice([0, 1, 7, 7, 30, 30, 200, rng.randint(1, 900)]))
            rows.append((rng.choice([k, 5000 + k, None]), source, text, 1, "x", 2, 3))
    return rows + rows[::4]


@pytest.mark.parametrize("seed", [1, 2])
def test_mixing(spark, seed):
    rows = mix_rows(seed)
    sizes, per_source = defaultdict(list), Counter()
    for _, source, text, *_ in rows:
        sizes[source].append(len(words(text)))
    per_source = {s: sum(x) for s, x in sizes.items()}
    expected = plain_targets(per_source)
    df = spark.createDataFrame(rows, MIX).repartition(4)
    made = mixing.mixed(df).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in made) == Counter((i, s, len(words(t))) for i, s, t, *_ in rows)
    taken, copies = Counter(), defaultdict(set)
    for r in made:
        s = r["source"]
        assert r["source_size"] == per_source[s]
        assert r["target"] == pytest.approx(expected[s], rel=1e-12)
        assert 0 <= r["copies"] <= 3
        taken[s] += r["copies"] * r["size"]
        if r["size"]:
            copies[(s, r["size"])].add(r["copies"])
    for s, target in expected.items():
        assert abs(taken[s] - target) <= max(1.0, 0.01 * target), (s, taken[s], target)
        tilt = plain_tilt(sizes[s], target) if 0 < target < 3 * per_source[s] else None
        for r in made:
            if r["source"] == s and r["size"]:
                assert r["rate"] == pytest.approx(3.0 if tilt is None else min(3.0, math.exp(tilt * r["size"])), rel=1e-6)
    assert all(max(c) - min(c) <= 1 for c in copies.values())
    again = mixing.mixed(spark.createDataFrame(rows[::-1], MIX).repartition(7)).collect()
    key = lambda rows: sorted(tuple(str(x) for x in r) for r in rows)
    assert key(made) == key(again)


def test_mixing_numbers_hot_cells_in_parts(spark):
    rows = [(k, "hot", "five words are in here", 1, "", 1, 1) for k in range(500)] + [(1000 + k, "small", "two words", 1, "", 1, 1) for k in range(40)]
    made = mixing.mixed(spark.createDataFrame(rows, MIX))
    taken = {r["source"]: (r["n"], r["target"]) for r in made.groupBy("source").agg(F.sum(mixing.taken()).alias("n"), F.first("target").alias("target")).collect()}
    assert taken["small"] == (240, 240.0)  # three times its size
    assert abs(taken["hot"][0] - taken["hot"][1]) <= 2.5


def test_mixing_without_rows_or_words(spark):
    assert mixing.mixed(spark.createDataFrame([], MIX)).collect() == []
    made = mixing.mixed(spark.createDataFrame([(1, "a", None, 1, "", 1, 1), (2, None, " ", 1, "", 1, 1)], MIX)).collect()
    assert sorted((r["doc_id"], r["size"], r["target"], r["copies"]) for r in made) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_whole_copies_meets_the_target():
    rng = np.random.default_rng(3)
    for _ in range(50):
        sizes = np.sort(rng.choice(np.arange(1, 3000), 60, replace=False))[::-1]
        counts = rng.integers(1, 9, 60)
        rates = rng.uniform(0, 3, 60)
        target = float((sizes * counts * rates).sum())
        copies = mixing.whole_copies(sizes, counts, rates, target)
        assert (copies >= 0).all() and (copies <= 3 * counts).all()
        assert abs((copies * sizes).sum() - target) <= max(sizes[-1], 5e-4 * target)


VECTORS = "vec_id long, embedding array<float>, x string, component int, n long"


def plain_whitening(vectors: list[list[float]], k: int = 4):
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = (fit - sums / n).astype(float) if n else fit
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    order = np.argsort(values)[::-1][:k]
    deviation = [int(((n * r - sums) ** 2).sum()) for r in x]
    return n, deviation, (x - sums / n).astype(float) @ (axes[:, order] / np.sqrt(values[order])), values[order] / np.trace(v)


@pytest.mark.parametrize("dimensions", [4, 9, 64])
def test_whitening(spark, dimensions):
    rng = np.random.default_rng(dimensions)
    spread = 1.0 / np.arange(1, dimensions + 1)
    vectors = (rng.normal(size=(300, dimensions)) * spread + 5).astype(np.float32).tolist()
    vectors += vectors[:40]  # fitted once
    rows = [(k, v, "x", 1, 2) for k, v in enumerate(vectors)]
    bad = [None, [None] * dimensions, [float("nan")] * dimensions, [float("inf")] + [0.0] * (dimensions - 1), [], [1.0]]
    df = spark.createDataFrame(rows + [(1000 + k, v, "x", 1, 2) for k, v in enumerate(bad)] + [(None, vectors[0], None, None, None)], VECTORS).repartition(3)
    made = whitening.whitened(df).collect()
    n, deviation, whitened, explained = plain_whitening(vectors)
    assert Counter(r["vec_id"] for r in made) == Counter({**{k: 4 for k in range(len(vectors))}, None: 4})
    sign = {}
    for r in made:
        k, c = r["vec_id"], r["component"] - 1
        k = 0 if k is None else k
        assert r["n"] == n and r["deviation"] == deviation[k]
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        assert r["identity_error"] < 1e-9
        if abs(whitened[k, c]) > 1e-3:
            s = sign.setdefault(c, math.copysign(1.0, r["whitened"] * whitened[k, c]))
            assert r["whitened"] == pytest.approx(s * whitened[k, c], rel=1e-6, abs=1e-8)


def test_whitening_of_little(spark):
    frame = lambda rows: spark.createDataFrame([(k, v, "x", 1, 2) for k, v in enumerate(rows)], VECTORS)
    assert whitening.whitened(frame([])).collect() == []
    assert whitening.whitened(frame([None, []])).collect() == []
    assert whitening.whitened(frame([[1.0, 2.0]] * 5)).collect() == []  # no variance
    made = whitening.whitened(frame([[0.0, 1.0], [1.0, 1.0], [1.0, 1.0]])).collect()
    assert sorted((r["vec_id"], r["component"], r["n"], abs(r["whitened"]), r["explained"]) for r in made) == [(0, 1, 2, 1.0, 1.0), (1, 1, 2, 1.0, 1.0), (2, 1, 2, 1.0, 1.0)]
    huge = whitening.whitened(frame([[1e30, 0.0], [-1e30, 3.0], [0.0, 9.0]])).collect()
    assert all(r["deviation"] is None for r in huge) and all(np.isfinite(r["whitened"]) for r in huge)


def test_inertia_and_slicing():
    rng = np.random.default_rng(5)
    for d in (1, 2, 3, 10, 40):
        a = rng.normal(size=(d, d))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in (*rng.normal(size=10) * 4, 0.0):
            plus, zero, minus = whitening.inertia(a - shift * np.eye(d))
            assert (plus, zero, minus) == ((values > shift).sum(), 0, (values < shift).sum())
    assert whitening.inertia(np.zeros((3, 3))) == (0, 3, 0)
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 0, 1)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    for spectrum in ([5, 5, 5, 2, 1, 1], [1e6, 1.0, 1 - 1e-12, 1e-3], [3, 3 - 1e-9, 2, 2], [7]):
        full = np.array([*spectrum, *[0.0] * (12 - len(spectrum))], float)
        v = (q * full) @ q.T
        values, axes = whitening.leading(v)
        k = min(4, len(spectrum))
        assert len(values) == k
        assert np.allclose(values, sorted(full)[::-1][:k], rtol=1e-9, atol=1e-9 * max(full) * 1e-3)
        assert np.allclose(axes @ axes.T, np.eye(k), atol=1e-9)
        assert np.abs(v @ axes.T - axes.T * values).max() < 1e-11 * max(full)
