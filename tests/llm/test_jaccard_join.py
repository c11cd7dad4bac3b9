"""The n-gram join against all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from llm_cases import SCHEMA, blank_free, components, frame, odd_texts, words

from cohortkit.llm.common import connected_components
from cohortkit.llm.jaccard_join import keep_one_of_each, shingles, similar_documents


def shingle_set(text, k):
    w = blank_free(text)
    k = min(k, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def edited(text: str, changes: int, seed: int) -> str:
    r, w = random.Random(seed), text.split()
    for _ in range(changes):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def copies() -> list[tuple[int | None, str | None]]:
    """Groups of near copies around the bound, chains, shared passages and short texts."""
    out = odd_texts()
    passage = words(60, 99)
    for g in range(6):
        base = words(150 + 40 * g, 200 + g)
        out += [(1000 + 50 * g + i, edited(base, i % 5, 31 * g + i)) for i in range(25)]
        chain = base
        for i in range(8):
            chain = edited(chain, 2, 777 * g + i)
            out.append((1030 + 50 * g + i, chain))
    out += [(2000 + i, words(30 + 5 * i, 500 + i) + " " + passage) for i in range(25)]
    return out + [(3000 + i, words(i % 12, 900 + i % 30, 4)) for i in range(60)]


def expected(texts, k, num, den):
    sets = [shingle_set(t, k) for _, t in texts]
    links = [(a, b) for a, b in combinations(range(len(sets)), 2) if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    root = components(list(range(len(sets))), links)
    low = {}
    for n, (i, _) in enumerate(texts):
        low.setdefault(root[n], []).append(i)
    name = {r: min((i for i in ids if i is not None), default=None) for r, ids in low.items()}
    return [(i, len(sets[n]), name[root[n]]) for n, (i, _) in enumerate(texts)], root


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80), (3, 60)])
def test_against_all_pairs(spark, k, num):
    texts = copies()
    got = sorted((tuple(r) for r in similar_documents(frame(spark, texts), words=k, num=num, den=100).collect()), key=str)
    assert got == sorted(expected(texts, k, num, 100)[0], key=str)


def test_one_stays_of_each_group(spark):
    texts = copies()
    docs = frame(spark, texts)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=str)
    rows, root = expected(texts, 5, 80, 100)
    blank = [i for i, n, _ in rows if n == 0]
    groups = {r: name for (i, n, name), r in zip(rows, root.values(), strict=True) if n}
    assert ids == sorted([*blank, *groups.values()], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert similar_documents(docs).count() == 0 and keep_one_of_each(docs).count() == 0


def test_segments_hash_alike(monkeypatch):
    import cohortkit.llm.jaccard_join as j

    text = words(1000, 4).encode()
    whole = shingles(text, 5)
    monkeypatch.setattr(j, "SEGMENT_WORDS", 37)
    assert (shingles(text, 5) == whole).all() and len(whole) == len(shingle_set(text.decode(), 5))


def test_components_of_random_graphs(spark):
    r = random.Random(1)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(60)] + [(900, 900 + i) for i in range(1, 80)]
    got = {x["id"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == components(list(nodes), [e for e in edges if e[0] != e[1]])
