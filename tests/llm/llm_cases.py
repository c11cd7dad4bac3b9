"""Odd inputs and brute-force answers for the tests of the subpackage."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, row_a int, _0 string, n_tokens string, component string, sid int, t string"
EXTRA = ("shadow", 7, "zero", "many", "c", 3, "tee")


def words(n: int, seed: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def frame(spark, texts: list[tuple[int | None, str | None]], lang: str | None = "en", clash: bool = True):
    """Documents with extra columns; with ``clash`` one differs from ``text`` in case alone."""
    df = spark.createDataFrame([(i, t, lang, "src0", None if t is None else len(t), *EXTRA) for i, t in texts], SCHEMA)
    if clash:
        return df
    names = df.columns
    at = [i for i, c in enumerate(names) if c != "TEXT"]
    return df.toDF(*[f"x{i}" for i in range(len(names))]).select(*[f"x{i}" for i in at]).toDF(*[names[i] for i in at])


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, a long text, ties, repeated rows, texts of many scripts."""
    long = words(30_000, 5, 3_000)
    base = words(120, 1)
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, base), (5, base), (5, base), (None, base), (6, base + " end"), (7, "Short one"), (8, "short one"),
        (9, long), (10, long[: len(long) // 2]), (11, "émile Über ÑANDÚ ça 東京 12 ٣"), (12, "!!! 123 ..."), (13, "x" * 3000), (14, "word"), (15, "word"), (16, words(120, 2)),
    ]


def blank_free(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def components(nodes: list, links: list[tuple]) -> dict:
    """Smallest node reachable from each node."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low
