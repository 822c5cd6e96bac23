"""Substring, byte and line dedup against brute force."""

from __future__ import annotations

import pytest

import corpus_pipeline
from orderweave.llm import chunks, lines, substrings, suffixes

from .corpora import SPACED, by_id, corpus, frame, words


def brute_words(rows, window):
    docs = sorted((i, words(t)) for i, t in rows if i is not None)
    first = {}
    for i, w in docs:
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = {}
    for i, w in docs:
        hit = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                hit[k : k + window] = [True] * window
        out[i] = (len(w), sum(hit), b" ".join(x for x, h in zip(w, hit, strict=True) if not h).decode())
    return out


@pytest.mark.parametrize(("seed", "window", "chunk"), [(1, 50, 1 << 22), (2, 20, 4000), (3, 5, 1500), (4, 1, 3000)])
def test_substrings(spark, seed, window, chunk):
    rows = corpus(seed)
    found = by_id(substrings.removed_words(frame(spark, rows), window, chunk_bytes=chunk), "n_words", "n_removed", "kept")
    assert found == brute_words(rows, window)


def brute_bytes(rows, window):
    docs = sorted((i, (t or "").encode()) for i, t in rows if i is not None)
    first = {}
    for i, w in docs:
        for k in range(len(w) - window + 1):
            first.setdefault(w[k : k + window], i)
    out = {}
    for i, w in docs:
        hit = bytearray(len(w))
        for k in range(len(w) - window + 1):
            if first[w[k : k + window]] < i:
                hit[k : k + window] = b"\1" * window
        out[i] = (len(w), sum(hit), len([x for x in bytes(hit).split(b"\0") if x]), bytes(x for x, h in zip(w, hit, strict=True) if not h))
    return out


@pytest.mark.parametrize(("seed", "window", "chunk"), [(1, 50, 1 << 22), (2, 50, 4000), (3, 33, 1500), (4, 20, 3000)])
def test_suffixes(spark, seed, window, chunk):
    rows = corpus(seed)
    found = by_id(suffixes.removed_bytes(frame(spark, rows), window, chunk_bytes=chunk), "n_bytes", "n_removed", "n_spans", "kept")
    assert {k: (*v[:3], bytes(v[3])) for k, v in found.items()} == brute_bytes(rows, window)


def test_intervals_part_rows_by_prefix():
    import numpy as np

    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 3, 400).astype(np.int16)
    for depth in (1, 2, 5, 9):
        rows, bwt = suffixes.transform(symbols, depth)
        number = suffixes.intervals(bwt, depth)
        ring = symbols.tolist() * 2
        prefixes = [tuple(ring[r : r + depth]) for r in rows.tolist()]
        assert prefixes == sorted(prefixes)
        assert [a == b for a, b in zip(prefixes, prefixes[1:], strict=False)] == (np.diff(number) == 0).tolist()


def brute_lines(rows, least):
    seen, known, out = set(), set(), {}
    lengths = [least]
    while 2 * lengths[-1] <= lines.DEPTH:
        lengths.append(2 * lengths[-1])
    for i, t in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        pieces = (t or "").encode().split(b"\n")
        at = [k for k, p in enumerate(pieces) if SPACED.search(p)]
        gone = set()
        for j, k in enumerate(at):
            run = at[j : j + least]
            if len(run) == least:
                key = tuple(pieces[x] for x in run)
                gone |= set(run) if key in seen else set()
                seen.add(key)
        longest = 0
        for n in lengths:
            for j in range(len(at) - n + 1):
                key = (n, *(pieces[x] for x in at[j : j + n]))
                longest = max(longest, n if key in known else 0)
                known.add(key)
        runs = sum(k in gone and (j == 0 or at[j - 1] not in gone) for j, k in enumerate(at))
        kept = b"\n".join(p for k, p in enumerate(pieces) if k not in gone).decode()
        out.setdefault(i, []).append((len(at), len(gone), runs, longest, None if t is None else kept))
    return out


@pytest.mark.parametrize(("seed", "least", "chunk"), [(1, 2, 1 << 22), (2, 2, 3000), (3, 3, 2000), (4, 5, 1500), (5, 1, 3000)])
def test_lines(spark, seed, least, chunk):
    rows = corpus(seed)
    rows += [(rows[3][0], rows[3][1]), (900, "a\n\nb\na\nb\n"), (901, "\n\n"), (902, "b\na\n" + "long " * 30), (903, "long " * 30)]
    df = frame(spark, rows)
    found: dict = {}
    for r in lines.without_repeated_runs(df, least, chunk_bytes=chunk).collect():
        assert (r.row.kept, r.row.rank, r.row.component_id) == ("x", 2.5, "y")
        found.setdefault(r.row.doc_id, []).append((*r.lines, r.row.text))
    key = lambda x: (x[1], x[2], x[3], x[4] or "")
    assert {k: sorted(v, key=key) for k, v in found.items()} == {k: sorted(v, key=key) for k, v in brute_lines(rows, least).items()}


def test_cut_documents_keep_columns_and_drop_emptied_ones(spark):
    same = "first line of some length\nsecond line of some length"
    rows = [(1, same), (2, same), (3, same + "\nthird"), (4, None), (5, ""), (None, same)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "99L as n_chars", "'s' as source")
    got = {(r.doc_id, r.text, r.n_chars) for r in lines.cut_documents(df).collect()}
    assert got == {(1, same, len(same)), (3, "third", 5), (4, None, None), (5, "", 0), (None, same, len(same))}
    assert lines.cut_documents(df).columns == df.columns


def test_pipeline_cuts_short_lines_between_unique_ones(spark):
    rows = [(k, f"own line {k}\nAll rights reserved.\nanother line {k}") for k in range(5)] + [(9, "All rights reserved.")]
    got = dict(corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect())
    assert got == {0: rows[0][1], **{k: f"own line {k}\nanother line {k}" for k in range(1, 5)}}


def test_rows_without_an_id_or_sharing_one(spark):
    text = " ".join(f"w{i}" for i in range(70))
    rows = [(1, text), (1, text), (None, text), (None, text), (2, text), (3, text)]
    df = frame(spark, rows)
    got = sorted(substrings.removed_words(df).select("doc_id", "n_removed").collect(), key=str)
    assert sorted((r[0] or 0, r[1]) for r in got) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 70), (3, 70)]
    got = suffixes.removed_bytes(df).select("doc_id", "n_removed").collect()
    n = len(text)
    assert sorted((r[0] or 0, r[1]) for r in got) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, n), (3, n)]


def test_a_copy_and_another_text_under_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(70)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, c + " " + b), (9, b), (9, "é " + c)]
    df = frame(spark, rows)
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substrings.removed_words(df).collect())
    assert got == [(1, 70, 0), (5, 70, 0), (5, 70, 70), (7, 140, 70), (9, 70, 70), (9, 71, 70)]
    got = sorted((r.doc_id, bytes(r.kept).decode()) for r in suffixes.removed_bytes(df).collect())
    assert got == [(1, a), (5, ""), (5, b), (7, c + " "), (9, ""), (9, "é ")]


@pytest.mark.parametrize("ids", [
    [*range(199), 10**15],
    [source << 40 | k for source in range(4) for k in range(50)],
    [(-1) ** k * (2**63 - 1 - k * 10**13) for k in range(200)],
])
def test_chunks_are_bounded_whatever_the_ids(spark, ids):
    rows = [(i, f"{i:<+100d}") for i in ids] + [(ids[7], "x" * 100), (ids[9], None), (None, "y" * 100)]
    dealt = chunks.deal(frame(spark, rows), chunk_bytes=1000)
    held = [(r.chunk, r.doc_id, len(r.text or "")) for r in dealt.docs.collect()]
    known = sorted(x for x in held if x[1] is not None)
    sizes = {c: sum(n for k, _, n in held if k == c) for c, _, _ in held}
    assert max(sizes.values()) <= 1000 and len(sizes) < 60 and dealt.n_bytes == sum(sizes.values())
    assert [i for _, i, _ in known] == sorted(i for _, i, _ in known) and len({(c, i) for c, i, _ in known}) == len(ids)


def test_the_driver_sees_as_much_of_many_chunks_as_of_few(spark, monkeypatch):
    seen = []
    for n in (100, 2000):
        rows = [(i * 7, f"{i:<+100d}") for i in range(n)]
        df = frame(spark, rows)
        collect = type(df).collect
        with monkeypatch.context() as m:
            counted: list[int] = []

            def counting(self, counted=counted, collect=collect):
                rows = collect(self)
                counted.append(len(rows))
                return rows

            m.setattr(type(df), "collect", counting)
            dealt = chunks.deal(df, chunk_bytes=1000)
        assert dealt.docs.select("chunk").distinct().count() >= n // 10
        seen.append(sum(counted))
    assert max(seen) <= 4  # a row for each range partition


def test_empty_tables(spark):
    df = frame(spark, [])
    assert substrings.removed_words(df).count() == 0
    assert suffixes.removed_bytes(df).count() == 0
    assert lines.cut_documents(df).count() == 0


def test_one_plan_shuffles_the_texts_once(spark):
    plan = substrings.removed_words(frame(spark, corpus(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_what_follows_a_hot_line_is_spread_over_all_shards():
    """A third of all lines are one line, followed by varied repeated ones: no shard gets more than its share of pairs."""
    import pyarrow as pa

    text = "\n".join(f"hot\nline {k}\nother {k}" for k in range(3000))
    rows = pa.table({"chunk": [0, 0], "doc_id": [1, 2], "text": [text, text]})
    found = lines._Lines(rows, 7)
    shards = 16
    asked = lines._request(found, 0, 0, shards)
    pairs = sum(len(p.as_py()) // 16 for p in asked["pairs"])
    assert pairs == 6001  # a hot line reaches a shard once a chunk
    answers = pa.concat_tables(lines._ranked(asked.filter(pa.compute.equal(asked["shard"], s)), shards) for s in asked["shard"].to_pylist())
    found.learn(0, lines._answers(answers, 0), 1)
    asked = lines._request(found, 1, 1, shards)
    sizes = [len(p.as_py()) // 16 for p in asked["pairs"]]
    assert sum(sizes) == 9000 - 1 and len(sizes) == shards and max(sizes) < 1.3 * sum(sizes) / shards


def test_line_ranks_are_in_suffix_order():
    """Of all suffixes, in every round, over chunks and shards: what is alone and what ends included."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = ["\n".join(f"line {k}" for k in rng.integers(0, 3, n)) for n in rng.integers(1, 30, 60)]
    texts += ["\n".join(["hot"] * 20 + [f"own {k}"]) for k in range(5)] + texts[:4]
    tables = [pa.table({"chunk": [c] * len(texts[c::3]), "doc_id": list(range(c, len(texts), 3)), "text": texts[c::3]}) for c in range(3)]
    found, shards, order = [lines._Lines(t, 7) for t in tables], 8, None
    for level, step in enumerate(lines.steps(1, lines.DEPTH)):
        asked = pa.concat_tables(lines._request(x, level, step, shards) for x in found)
        answers = pa.concat_tables(lines._ranked(asked.filter(pa.compute.equal(asked["shard"], s)), shards) for s in set(asked["shard"].to_pylist()))
        for x in found:
            x.learn(step, lines._answers(answers.filter(pa.compute.equal(answers["chunk"], x.chunk.number)), level), 1)
        order = order or [x.rank.tolist() for x in found]  # of single lines
        seen = []
        for x, single in zip(found, order, strict=True):
            ends = np.searchsorted(x.owner, x.owner, "right").tolist()
            seen += [(tuple(single[j : min(e, j + x.length)]), r) for j, (e, r) in enumerate(zip(ends, x.rank.tolist(), strict=True))]
        seen.sort()
        assert all((p < q and a < b) or (p == q and a == b) for (p, a), (q, b) in zip(seen, seen[1:], strict=False))
    assert len({a for _, a in seen}) > 100


def test_line_ranks_are_a_whole_suffix_array(spark):
    """Doubling goes on past `DEPTH`: two suffixes have one rank only if they are equal to the ends of their texts."""
    rng = __import__("random").Random(11)
    shared = [f"shared {rng.randrange(4)}" for _ in range(100)]
    rows = [(k, "\n".join(shared[k % 7 :] + [f"own {k}"])) for k in range(12)]  # 90 and more lines in common
    rows += [(20, rows[3][1]), (21, "\n".join(["hot"] * 70)), (22, "\n".join(["hot"] * 41 + ["end"])), (23, None), (24, "hot\n\nhot")]
    found = {r["row"]["doc_id"]: r["ranks"] for r in lines.without_repeated_runs(spark.createDataFrame([*rows, (None, "hot\nhot")], "doc_id long, text string"), chunk_bytes=4000).collect()}
    assert found.pop(None) is None and found[23] == []
    split = {i: [line for line in (t or "").split("\n") if line] for i, t in rows}
    assert {i: len(r) for i, r in found.items()} == {i: len(t) for i, t in split.items()}
    suffixes = sorted((rank, tuple(split[i][j:])) for i, r in found.items() for j, rank in enumerate(r))
    firsts = list(dict.fromkeys(s[0] for _, s in suffixes))  # the order of single lines
    assert sum(a[1][0] != b[1][0] for a, b in zip(suffixes, suffixes[1:], strict=False)) == len(firsts) - 1
    ordered = [(rank, [firsts.index(line) for line in s]) for rank, s in suffixes]
    assert all((a[0] < b[0] and a[1] < b[1]) or a == b for a, b in zip(ordered, ordered[1:], strict=False))


def test_column_names_with_dots(spark):
    from orderweave.llm import decontaminate, minhash, quality

    text = " ".join(f"word{k}" for k in range(80))
    rows = [(1, text, 1.0), (2, "own line\n" + text, 2.0), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` double")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    benchmark = spark.createDataFrame([("x", "nothing of this")], "item_id string, text string")
    for made in (lines.cut_documents(df), quality.without_rejected(df, labels), decontaminate.without_contaminated(df, benchmark), minhash.deduplicated(df)):
        assert made.columns == df.columns
        got = {r["doc_id"]: r["a.b"] for r in made.collect()}
        assert got and all(got[i] == dict((r[0], r[2]) for r in rows)[i] for i in got)
