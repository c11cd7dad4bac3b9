"""BPE encoding, decoding and token counts against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import EXTRA, SCHEMA, frame, odd_texts, words
from tokenizers import Tokenizer as Library

import cohortkit.llm.token_counts as counts
from cohortkit.llm.bpe import Tokenizer, encode_rows, with_tokens

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
HARD = [
    "I'll don't WE'RE 'S x's", "  two  spaces\n\n\nand\tlines \r\n ", "ΑΣ ΣΑΣ ὈΔΥΣΣΕΎΣ İstanbul ſ K", "naïve café é ẞ ﬁ", "日本語テキスト 한국어 עברית", "🙂🙃👨‍👩‍👧 ©®™",
    "\u0558a \u058b x\U0003d000y \u209d 𐄇𐄈 𠀀𠀁 Ა\u1c89 \ua7dc", "a<|endoftext|>b <|startoftext|><|startoftext|> c", "123 4567 ٣٤ ½ Ⅷ", "\x00\x01\x1c\x1d\x1e\x1f\x85\xa0 　x", "!!!??? ...--- _a_b_", "supercalifragilisticexpialidocious" * 9, "a" * 700, "ab" * 300, " " * 300 + "x", "\n" * 40,
]
_BYTE_LIB, _WORD_LIB = Library.from_file(BYTE), Library.from_file(WORD)
_WORD_OWN, _BYTE_OWN, _COUNTER = Tokenizer(WORD), Tokenizer(BYTE), counts.Counter(BYTE)


def lib_row(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encode_and_decode(spark, path):
    texts = odd_texts() + [(500 + i, t) for i, t in enumerate(HARD)]
    lib = Library.from_file(path)
    got = encode_rows(frame(spark, texts), path).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *lib_row(lib, t)) for i, t in texts), key=str)


def test_counts(spark):
    texts = odd_texts() + [(500 + i, t) for i, t in enumerate(HARD)]
    got = counts.count_tokens(frame(spark, texts), BYTE).collect()
    expected = [(i, len((t or "").encode()), n := lib_row(_BYTE_LIB, t)[0], n > 512) for i, t in texts]
    assert sorted((tuple(r) for r in got), key=str) == sorted(expected, key=str)


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("  aeinst'\n.1é")), max_size=60))
def test_any_text(text):
    assert np.frombuffer(_WORD_OWN.encode([text])[0], "<u4").tolist() == _WORD_LIB.encode(text, add_special_tokens=False).ids
    ids = _BYTE_LIB.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(_BYTE_OWN.encode([text])[0], "<u4").tolist() == ids and _COUNTER.count(text) == len(ids)


def test_long_words_merge_like_wide_ones():
    r = random.Random(3)
    some = ["".join(r.choice("etaoins hr") for _ in range(n)).replace(" ", "").encode() for n in range(2, 64)]
    assert [_WORD_OWN._merge_long(w) for w in some] == _WORD_OWN.merge(some)


LONG = [*HARD, words(200, 1), "x  y\n z" * 20, "'re'll've'd'rx'lx'v 'r'l" * 9, "\u00a0 \u00a0x\t\t'y  'z " * 9, "<|endoftext|>" * 30]


@pytest.mark.parametrize("size,look_back", [(1, 0), (2, 1), (3, 50), (7, 4), (50, 1 << 10)])
def test_chunks_are_read_in_order(size, look_back):
    for t in LONG:
        state, total, parts = counts.BEGIN, 0, list(_COUNTER.chunks(t, size, look_back))
        assert "".join(p[1] for p in parts) == t and [p[2] for p in parts] == [False] * (len(parts) - 1) + [True]
        for _, chunk, ends in parts:
            state, n = _COUNTER.apply(state, chunk, ends)
            total += n
        assert total == len(_BYTE_LIB.encode(t, add_special_tokens=False).ids) and state == counts.BEGIN


def test_entry_states_after_a_break_are_exact():
    text = " ".join([words(300, 2), "it's  we'll\n\n", words(300, 3)])
    state = counts.BEGIN
    for before, chunk, ends in _COUNTER.chunks(text, 37, 100):
        assert _COUNTER.run(counts.BEGIN, before)[0] == state
        state, _ = _COUNTER.apply(state, chunk, ends)


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("  aeinst'rl\n.1é")), max_size=60), st.integers(0, 60))
def test_states_read_any_text(text, at):
    state, n = _COUNTER.run(counts.BEGIN, text[:at])
    state, m = _COUNTER.run(state, text[at:])
    assert n + m + _COUNTER.finish(state) == len(_BYTE_LIB.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("size,look_back", [(5, 2), (40, 60)])
def test_state_maps_compose(spark, monkeypatch, size, look_back):
    monkeypatch.setattr(counts, "FAN", 3)
    monkeypatch.setattr(counts, "MOST_CHARS", 1 << 12)
    monkeypatch.setattr(counts, "PIECE", 2)
    texts = [(i, t) for i, t in enumerate(LONG)] + [(7, LONG[7])] * 3 + [(None, LONG[-1])] * 2 + [(99, LONG[7]), (100, None), (100, "")]
    got = counts.count_tokens(frame(spark, texts), BYTE, chunk_chars=size, look_back=look_back).collect()
    expected = [(i, len((t or "").encode()), n := lib_row(_BYTE_LIB, t)[0], n > 512) for i, t in texts]
    assert sorted((tuple(r) for r in got), key=str) == sorted(expected, key=str)


def test_composition_is_associative(spark, monkeypatch):
    rows = [(doc, "t", 9, 1, k, f"s{k}", f"s{k + 1 + (doc == 2 and k == 4)}", k, True) for doc in (1, 2) for k in range(8)]
    maps = spark.createDataFrame(rows, "doc_id int, text_key string, n_bytes long, copies long, k int, entry string, exit string, n long, ok boolean")
    seen = []
    for fan in (2, 3, 8):
        monkeypatch.setattr(counts, "FAN", fan)
        now, reach = maps, 1
        while reach < 8:
            now, reach = counts.compose(now), reach * fan
        seen.append(sorted((r["doc_id"], r["entry"], r["exit"], r["n"], r["ok"]) for r in now.collect()))
    assert seen == [[(1, "s0", "s8", 28, True), (2, "s0", "s8", 28, False)]] * 3


def test_transducer_survives_forgetting(monkeypatch):
    monkeypatch.setattr(counts, "MOST_TRANSITIONS", 50)
    c = counts.Counter(BYTE)
    assert [c.count(t) for t in HARD] == [_COUNTER.count(t) for t in HARD]


def test_new_columns_and_empty_tables(spark):
    docs = frame(spark, odd_texts())
    got = with_tokens(docs, WORD)
    assert got.columns == [c for c in docs.columns if c != "n_tokens"] + ["n_tokens", "token_ids"]
    for r in got.collect():
        assert len(r["token_ids"]) == r["n_tokens"] == lib_row(_WORD_LIB, r["text"])[0] and r["t"] == EXTRA[-1]
    none = spark.createDataFrame([], SCHEMA)
    assert with_tokens(none, WORD).count() == encode_rows(none, WORD).count() == counts.count_tokens(none, BYTE).count() == 0
