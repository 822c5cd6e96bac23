"""Small corpora with the awkward cases, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text: str | None, pattern: re.Pattern[bytes] = SPACED, lower: bool = False) -> list[bytes]:
    data = (text or "").encode()
    return pattern.findall(data.translate(_LOWER) if lower else data)


def corpus(seed: int, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Texts with shared passages, copies, near copies, one long text, null and empty ones."""
    rng = random.Random(seed)
    vocabulary = ["a", "The", "of", "é", "naïve", "日本", "x1", "###", "</turn>", "word", "Ünder"] + [f"w{i}" for i in range(300)]

    def prose(k: int) -> str:
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\n", ". ", "\t"]) for _ in range(k))

    passages = [prose(80) for _ in range(3)]
    lines = ["\n".join(prose(15).replace("\n", " ") for _ in range(3)) for _ in range(2)]
    texts: list[str | None] = [None, "", " \n\t ", "one", "one", prose(6000)]
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3:
            texts.append(prose(rng.randint(1, 200)) + rng.choice(passages) + prose(rng.randint(0, 50)))
        elif kind < 0.45:
            texts.append(prose(rng.randint(0, 30)) + "\n" + rng.choice(lines) + "\n" + prose(rng.randint(0, 30)))
        elif kind < 0.55 and texts[-1]:
            texts.append(texts[-1])
        elif kind < 0.7:
            old = (rng.choice([t for t in texts if t]) or "").split(" ")
            old[rng.randrange(len(old))] = "changed"
            texts.append(" ".join(old))
        else:
            texts.append(prose(rng.randint(0, 120)))
    rows: list[tuple[int | None, str | None]] = [(7 * i - 20, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]], partitions: int = 3) -> DataFrame:
    """Documents with columns that are named like what operators add."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    return df.selectExpr("doc_id", "text", "1 as n_words", "'x' as kept", "cast(null as string) as chunk", "2.5D as rank", "array(1) as lines", "'y' as component_id")


def by_id(df: DataFrame, *columns: str) -> dict[int, tuple]:
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.select("doc_id", *columns).collect()}
