"""Repeats against a direct count of all strings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import SCHEMA, frame, odd_texts, words

import cohortkit.llm.suffix_dedup as s


def direct(texts, length):
    raw = [(t or "").encode() for _, t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (doc, _), b in zip(texts, raw, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def cases():
    r = random.Random(8)
    long = words(3000, 77)
    out = [(i, t) for i, t in odd_texts() if i not in (9, 10)] + [(50, long)]
    for i in range(60):  # pieces of one text, cut anywhere, in new surroundings
        a = r.randrange(len(long) - 900)
        out.append((100 + i, words(r.randrange(40), 300 + i) + long[a : a + r.randrange(40, 900)] + words(r.randrange(40), 600 + i)))
    out += [(200, "ab" * 400), (201, "aba" * 200), (202, "é" * 150), (203, "x" + "é" * 120), (204, "q" * 200), (205, "q" * 201)]
    return out


@pytest.mark.parametrize("length", [200, 40])
def test_against_direct_count(spark, length):
    texts = cases()
    got = sorted((tuple(r) for r in s.remove_repeats(frame(spark, texts), length).collect()), key=str)
    assert got == sorted(direct(texts, length), key=str)


def test_kept_bytes(spark):
    texts = cases()[-12:]
    for r in s.remove_repeats(frame(spark, texts), 40, keep_text=True).collect():
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]


def test_empty_table(spark):
    assert s.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_segments_and_windows(monkeypatch):
    raw = np.frombuffer(words(900, 6).encode() * 2, np.uint8)
    whole = [np.concatenate(x) for x in zip(*s.anchors(raw), strict=True)]
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(whole[2], whole[3], strict=True)])
    assert (starts == np.arange(len(raw) - 199)).all()
    monkeypatch.setattr(s, "SEGMENT", 500)
    parts = [np.concatenate(x) for x in zip(*s.anchors(raw), strict=True)]
    assert set(parts[0]) == set(whole[0])
    value = np.random.default_rng(1).integers(0, 9, 300, dtype=np.uint64)
    assert all(p == i + value[i : i + 7].argmin() for i, p in enumerate(s.lowest(value, 7)))


def test_refined_buckets_tell_strings_apart():
    raw = np.frombuffer(("ab" * 100 + words(200, 1) + "ab" * 100).encode(), np.uint8)
    bucket = s.refined(s.refined(s.grams(raw, 10), 10), 20)
    strings = [raw[i : i + 40].tobytes() for i in range(len(raw) - 39)]
    assert len(bucket) == len(strings) and len(set(bucket.tolist())) == len(set(strings))
    assert len(set(zip(bucket.tolist(), strings, strict=True))) == len(set(strings))


def side_by_side(n=400):
    """A batch of short texts, some of them empty, null or very short, and a few long ones."""
    texts = [words(4 + i % 30, 900 + i % 50).encode() for i in range(n)]
    texts[3], texts[7], texts[8], texts[20] = None, b"", b"ab", words(2000, 5).encode()
    return pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(0, 2 * n, 2)), pa.array(texts, pa.binary())], ["text_a", "text_b", "t"])


def test_texts_side_by_side_are_sampled_as_each_alone(monkeypatch):
    monkeypatch.setattr(s, "SEGMENT", 3000)
    batch = side_by_side()
    raw, ends = s.adjoined(batch.column(2))
    got = [np.concatenate(x) for x in zip(*s.anchors(raw, 40, ends), strict=True)]
    alone = [(x, i) for i, t in enumerate(batch.column(2).to_pylist()) for x in s.anchors(np.frombuffer(t or b"", np.uint8), 40)]
    for k, shift in enumerate((0, 0, 1, 1, 1)):
        assert got[k].tolist() == [y + shift * int(ends[i]) for x, i in alone for y in x[k].tolist()]


def test_a_piece_of_many_texts_is_hashed_once(monkeypatch):
    built = []

    class Counted(s.Ranges):
        def __init__(self, raw):
            built.append(len(raw))
            super().__init__(raw)

    monkeypatch.setattr(s, "Ranges", Counted)
    batch = side_by_side()
    most = sum(len(t or b"") for t in batch.column(2).to_pylist()) // s.SEGMENT + 3
    (rows,) = s._anchor_rows(40)([batch])
    assert len(built) <= most
    todo = [[] for _ in range(batch.num_rows)]
    for a, place in zip(rows.column(2).to_pylist(), rows.column(4).to_pylist(), strict=True):
        todo[a].append({"place": place, "weight": 3})
    todo = pa.array(todo, pa.list_(pa.struct([("place", pa.int64()), ("weight", pa.int64())])))
    built.clear()
    (part,) = s._part_rows(40)([batch.append_column("todo", todo)])
    assert len(built) <= most and set(part.column(6).to_pylist()) == {2}
    todo = [[] for _ in range(batch.num_rows)]
    for a, lo, hi in zip(*(part.column(i).to_pylist() for i in (2, 4, 5)), strict=True):
        todo[a].append({"lo": lo, "hi": hi, "weight": 1})
    todo = pa.array(todo, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("weight", pa.int64())])))
    built.clear()
    found = list(s._string_rows(40)([batch.append_column("todo", todo)]))
    assert len(built) <= most
    texts, named = batch.column(2).to_pylist(), {}
    for string, a, _, lo, _ in (r for b in found for r in zip(*(c.to_pylist() for c in b.columns), strict=True)):
        assert named.setdefault(string, texts[a][lo : lo + 40]) == texts[a][lo : lo + 40]
    assert sum(b.num_rows for b in found) == sum(max(len(t or b"") - 39, 0) for t in texts)


def test_counting_makes_no_contexts(monkeypatch):
    def of(*_):
        raise AssertionError("a context of a bucket that is only counted")

    monkeypatch.setattr(s.Ranges, "of", of)
    assert sum(b.num_rows for b in s._count_rows(40)([side_by_side()])) > 0


def test_ranges_of_a_row_merge():
    row, lo, end = s.merged(np.array([2, 0, 0, 2, 0, 2]), np.array([0, 5, 0, 9, 30, 3]), np.array([4, 10, 5, 12, 40, 8]))
    assert list(zip(row.tolist(), lo.tolist(), end.tolist(), strict=True)) == [(0, 0, 10), (0, 30, 40), (2, 0, 8), (2, 9, 12)]
    assert all(len(x) == 0 for x in s.merged(*[np.zeros(0, np.int64)] * 3))
