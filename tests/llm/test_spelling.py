"""Spelling groups against edit distances of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SMALL_DIR
from llm_cases import SCHEMA, frame, odd_texts

from cohortkit.llm.common import read_table
from cohortkit.llm.queries import QUERIES
from cohortkit.llm.spelling import spelling_groups


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(docs, modulus=97, letters=5, least=3):
    n: Counter = Counter()
    for i, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            if modulus is not None:
                h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
                if h % modulus == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= letters:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least}


def direct(docs, modulus=97, letters=5, least=3):
    n = counted(docs, modulus, letters, least)
    near = {w: [] for w in n}
    by_size: dict[int, list[str]] = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    for size, some in by_size.items():
        for k, a in enumerate(some):
            for b in some[k + 1 :] + by_size.get(size + 1, []):
                if one_edit(a, b):
                    near[a].append(b)
                    near[b].append(a)
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if n[b] >= 2 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def result(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def variants(seed: int, size: int, letters: str = "abcé", low: int = 5, high: int = 9) -> list[str]:
    r = random.Random(seed)
    made = []
    for _ in range(size):
        w = "".join(r.choice(letters) for _ in range(r.randrange(low, high)))
        made += [w] * r.choice([3, 3, 7, 15, 40])
    r.shuffle(made)
    return made


@pytest.mark.parametrize("depth", [40, 6])
def test_random_words(spark, depth):
    some = variants(1, 150)
    texts = [(k, " ".join(some[k::40])) for k in range(40)] + odd_texts()
    assert result(spelling_groups(frame(spark, texts), depth=depth)) == direct(texts)


def test_long_words_and_words_at_the_border(spark):
    r = random.Random(2)
    made = []
    for size in (38, 39, 40, 41, 300, 5000):
        base = "".join(r.choice("abcdeÿ") for _ in range(size))
        made += [base] * 9 + [base[1:]] * 4 + [base + "q"] * 3 + [base[:7] + "q" + base[8:]] * 3 + [base[:7] + "z" + base[8:]] * 3 + ["a" * size] * 3
    texts = [(k, " ".join(made[k::5])) for k in range(5)]
    assert result(spelling_groups(frame(spark, texts), modulus=None)) == direct(texts, None)


def test_ties_chains_and_case(spark):
    texts = [(k, t) for k, t in enumerate(["plane planes plaÑes PLANES Planet " * 3, "plants " * 30, "plantz " * 14, "plentz " * 6, "plent plentx " * 3, "aaaaa aaaab aaaac " * 8, "aaaad " * 4])]
    for modulus in (None, 3, 97):
        assert result(spelling_groups(frame(spark, texts), modulus=modulus)) == direct(texts, modulus)


def test_many_words_under_one_prefix(spark):
    r = random.Random(5)
    words = ["samebeginning" + "".join(r.choice("abcdefghij") for _ in range(13)) for _ in range(300)]
    words += [w[:20] + "z" + w[21:] for w in words[:100]]
    texts = [(k, " ".join(words)) for k in range(3)]
    assert result(spelling_groups(frame(spark, texts), modulus=None)) == direct(texts, None)


def test_empty_tables(spark):
    assert spelling_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling_groups(frame(spark, [(1, None), (2, ""), (3, "ab ab ab"), (4, "123")])).count() == 0


def test_query_on_small_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, SMALL_DIR, "documents").collect()]
    assert result(QUERIES["op12_spelling_variants"](spark, SMALL_DIR)) == direct(docs)
