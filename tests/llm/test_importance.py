"""Importance resampling against a direct version over every word."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL_DIR
from llm_cases import SCHEMA, frame, odd_texts, words

from cohortkit.llm import importance
from cohortkit.llm.common import read_table
from cohortkit.llm.queries import QUERIES


def direct(docs, target, percent=10, least=20, run=1, buckets=10_000, seed=2024):
    """Expected (doc_id, n_features, weight, score, rank), repeated rows by their sorted place."""

    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, run + 1) for i in range(len(w) - n + 1)]

    made = [(i, *features(t)) for i, t in docs]
    s = Counter(b for _, _, f in made for b in f)
    t = Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for i, n, f in made:
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return Counter((r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in out)


def target_frame(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, text string")


@pytest.mark.parametrize("run,percent,dictionary", [(1, 10, 50_000), (3, 50, 40), (2, 100, 0)])
def test_against_direct_version(spark, monkeypatch, run, percent, dictionary):
    monkeypatch.setattr(importance.frequent_words, "__kwdefaults__", {"most": dictionary})
    texts = odd_texts() + [(100 + k, words(15 + k % 40, k % 25, 90)) for k in range(150)] + [(77, words(60, 3))] * 30 + [(None, words(60, 4))] * 9
    aim = [words(50, 3), "W1 w2, émile!", None, "", words(200, 8, 90)]
    got = importance.resample(frame(spark, texts), target_frame(spark, aim), percent=percent, run_words=run, buckets=997, carry=("doc_id",))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == direct(texts, aim, percent, run=run, buckets=997)


def test_columns_pass_through_and_order_does_not_matter(spark):
    texts = [(k, words(30, k)) for k in range(200)]
    df = frame(spark, texts)
    one = importance.resample(df.repartition(7), target_frame(spark, [words(80, 2)]))
    assert one.columns == [*df.columns, "n_features", "weight", "score", "rank"]
    rows = {r[0]: r[-1] for r in one.collect()}
    random.Random(1).shuffle(texts)
    again = importance.resample(frame(spark, texts), target_frame(spark, [words(80, 2)]))
    assert {r[0]: r[-1] for r in again.collect()} == rows
    assert sorted(r for r in rows.values() if r) == list(range(1, 21))


def test_empty_tables(spark):
    assert importance.resample(spark.createDataFrame([], SCHEMA), target_frame(spark, ["a b"])).count() == 0
    texts = [(k, words(30, k)) for k in range(20)]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert Counter(map(tuple, importance.resample(frame(spark, texts), empty, carry=("doc_id",)).collect())) == direct(texts, [])


def test_joined_crc():
    r = random.Random(4)
    parts = [(r.randbytes(r.randrange(0, 40)), r.randbytes(r.randrange(0, 5000))) for _ in range(200)]
    got = importance.joined_crc(np.array([zlib.crc32(a) for a, _ in parts], np.uint32), np.array([zlib.crc32(b) for _, b in parts], np.uint32), np.array([len(b) for _, b in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]


def test_long_text_in_segments(monkeypatch):
    monkeypatch.setattr(importance, "SEGMENT_BYTES", 50)
    text = importance.words_of((words(900, 3) + " " + "é" * 300 + " w1").encode())
    d = importance.Dictionary([b"w1", b"w11", b"w2", b"1"])
    crc, length = d.payloads(text)
    assert crc.tolist() == [zlib.crc32(w) for w in text] and length.tolist() == [len(w) for w in text]


def test_query_on_small_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, SMALL_DIR, "documents").collect()]
    aim = [r["text"] for r in read_table(spark, SMALL_DIR, "benchmark").collect()]
    got = QUERIES["op11_importance_resampling"](spark, SMALL_DIR)
    assert Counter(map(tuple, got.collect())) == direct(docs, aim)
