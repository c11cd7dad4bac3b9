"""Benchmark windows against a direct search."""

from __future__ import annotations

import hashlib
import re

import pytest
from llm_cases import EXTRA, SCHEMA, frame, odd_texts, words

from cohortkit.llm.decontaminate import Patterns, benchmark_blocks, drop_contaminated, find_contamination, words_of


def direct(text, items, window=10):
    tok = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    doc, hit, found = tok(text), set(), set()
    for item, body in items:
        w = tok(body)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            for j in range(len(doc) - m + 1):
                if doc[j : j + m] == w[i : i + m]:
                    hit |= set(range(j, j + m))
                    found.add("null" if item is None else str(item))
    return len(doc), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


ITEMS = [(1, words(25, 50)), (2, words(25, 50)), (10, words(12, 51) + " Émile"), (3, "short one"), (4, "word"), (5, None), (6, ""), (7, "... !"), (None, words(11, 52))]
DOCS = [*odd_texts(), (20, "a b " + words(25, 50) + " c"), (21, words(25, 50).upper()), (22, words(14, 50)), (23, words(9, 50)), (24, words(12, 51) + " émile"), (25, words(11, 52) + " word " + words(11, 52))]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_against_direct_search(spark, block_bytes):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = find_contamination(frame(spark, DOCS), bench, block_bytes=block_bytes).collect()
    key = lambda t: (str(t[0]), t[1:])
    expected = sorted(((i, *direct(t, ITEMS)) for i, t in DOCS), key=key)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got), key=key) == expected


def test_filter_keeps_columns_and_clean_rows(spark):
    bench = spark.createDataFrame(ITEMS[:3], "item_id long, text string")
    docs = frame(spark, DOCS)
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    rows = [tuple(r) for r in kept.collect()]
    assert sorted(str(r[0]) for r in rows) == sorted(str(i) for i, t in DOCS if not direct(t, ITEMS[:3])[4])
    assert all(r[-len(EXTRA):] == EXTRA for r in rows)


@pytest.mark.parametrize("block_bytes", [1 << 20, 500])
def test_filter_by_blocks(spark, block_bytes):
    many = [(i, words(30, 100 + i)) for i in range(9)] + [(None, words(11, 52))] * 30 + [(50, None), (51, "")]
    texts = DOCS + [(100 + i, f"x {words(30, 100 + i)[20:]} y") for i in range(0, 9, 2)] + [(200, words(11, 52))] * 20
    bench, docs = spark.createDataFrame(many, "item_id long, text string"), frame(spark, texts)
    kept = drop_contaminated(docs, bench, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    assert sorted((str(r[0]), str(r[1])) for r in kept.collect()) == sorted((str(i), str(t)) for i, t in texts if not direct(t, many)[4])
    key = lambda t: (str(t[0]), t[1:])
    got = find_contamination(docs, bench, block_bytes=block_bytes).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got), key=key) == sorted(((i, *direct(t, many)) for i, t in texts), key=key)
    none = docs.where("false")
    assert drop_contaminated(none, bench, block_bytes=block_bytes).count() == find_contamination(none, bench, block_bytes=block_bytes).count() == 0


def test_the_driver_holds_one_block_at_a_time(spark):
    bench = spark.createDataFrame([(i, words(40, 300 + i)) for i in range(300)], "item_id long, text string")
    total = sum(len(words(40, 300 + i)) for i in range(300))
    n, blocks = benchmark_blocks(bench, block_bytes=10_000)
    assert n == 1 + total // 10_000
    sizes = [sum(len(t) for _, t in b.value.items) for b in blocks]
    assert len(sizes) == n and sum(sizes) == total and max(sizes) < 2 * 10_000


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert find_contamination(docs, bench).count() == 0
    assert not any(r["contaminated"] for r in find_contamination(frame(spark, DOCS), bench).collect())


def test_shift_table_skips():
    p = Patterns([("1", " ".join(f"a{i}" for i in range(10)).encode())])
    assert p.searches[0].shift[(b"a0", b"a1")] == 8 and p.searches[0].shift[(b"a8", b"a9")] == 0
    assert p.scan(words_of(b"x " * 50)) == ([], set())
