"""Packing: pieces against the tokenizers library, sequences without gaps, few of them."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from conftest import SMALL_DIR
from llm_cases import SCHEMA, frame, odd_texts, words

from cohortkit.llm.common import read_table
from cohortkit.llm.packing import Places, fractional_patterns, pack_documents, plan_sequences
from cohortkit.llm.queries import QUERIES

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def pieces(texts, path, limit, end_id=0):
    lib, out = tokenizers.Tokenizer.from_file(path), Counter()
    for i, t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [end_id]
        for k, a in enumerate(range(0, len(ids), limit)):
            part = np.array(ids[a : a + limit], "<u4")
            out[i, k, a, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def check(rows, texts, path, limit, most_over=0.1):
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows) == pieces(texts, path, limit)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= limit
    assert sorted(held) == list(range(len(held)))
    total = sum(r["length"] for r in rows)
    assert len(held) <= -(-total // limit) * (1 + most_over) + 1


@pytest.mark.parametrize("path,limit", [(WORDS, 64), (WORDS, 2048), (BYTES, 500)])
def test_against_the_library(spark, path, limit):
    hard = ["It's  we'll\tI'd x", "<|endoftext|> a<|startoftext|>b", "ΣΑΣ ÀÉ é İ ﬁ ½ Ⅷ ²", "日本語 한국어 🙂🙂 \U0001f9ff", "\n\n a\nb \r\n c", "՘Ᲊ Ɤ", "a" * 5000, "1234567 a1b2", "́x ́"]
    texts = odd_texts() + list(enumerate(hard, 200)) + [(300 + k, words(3 + k % 60, k)) for k in range(200)] + [(9, "same text")] * 40
    check(pack_documents(frame(spark, texts).repartition(5), path, limit).collect(), texts, path, limit)


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA), WORDS).count() == 0


def test_query_on_small_table(spark):
    texts = [(r["doc_id"], r["text"]) for r in read_table(spark, SMALL_DIR, "documents").collect()]
    check(QUERIES["op13_packing"](spark, SMALL_DIR).collect(), texts, WORDS, 2048, most_over=0.0)


def best_fit_decreasing(counts, limit):
    rooms: list[int] = []
    for n in range(limit, 0, -1):
        for _ in range(counts[n]):
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms[rooms.index(min(fits))] -= n
            else:
                rooms.append(limit - n)
    return len(rooms)


@pytest.mark.parametrize("seed,low,high,size", [(1, 1, 101, 800), (2, 15, 45, 900), (3, 30, 60, 500), (4, 100, 101, 7), (5, 1, 6, 3000), (6, 51, 70, 50)])
def test_plans_fit_and_are_few(seed, low, high, size):
    limit = 100
    counts = np.bincount(np.random.default_rng(seed).integers(low, high, size), minlength=limit + 1)
    bins = plan_sequences(counts, limit)
    held = np.zeros(limit + 1, np.int64)
    for b in bins:
        assert sum(n * c for n, c in b.contents) <= limit
        for n, c in b.contents:
            held[n] += b.count * c
    assert (held == counts).all()
    assert sum(b.count for b in bins) <= best_fit_decreasing(counts, limit)
    places, seen = Places.of(bins, limit), defaultdict(list)
    for n in np.flatnonzero(counts):
        sequence, offset = places.find(np.full(counts[n], n), np.arange(counts[n]))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            seen[s].append((o, int(n)))
    for spans in seen.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n


def test_patterns_reach_the_known_optimum():
    """Of 44 and 31 into 100 (two and one, or three) no fractional plan does better than this one."""
    found = fractional_patterns(np.array([44, 31]), np.array([60.0, 60.0]), 100)
    assert sum(x for _, x in found) == pytest.approx(50.0)
    assert sum(x * c for c, x in found) == pytest.approx([60, 60])


def test_work_does_not_grow_with_counts():
    counts = np.bincount(np.random.default_rng(0).integers(200, 900, 20_000), minlength=2049)
    few, many = plan_sequences(counts), plan_sequences(counts * 1_000_000)
    assert len(many) < 5 * len(few) + 100
    total = int((counts * np.arange(2049)).sum()) * 1_000_000
    assert sum(b.count for b in many) <= 1.02 * total / 2048
