"""Language identification: held-out accuracy, parsing against a direct one, odd inputs."""

from __future__ import annotations

import random
import zlib

import numpy as np
from llm_cases import SCHEMA, frame, odd_texts

import cohortkit.llm.language_id as lid

SYLLABLES = {"aa": "ka lo mi ne tu pa ri".split(), "bb": "sch ung eit zw öd ber ein".split(), "cc": "tion ment eau oux gne ée qui".split()}


def text(lang: str, n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n))


def corpus(spark):
    rows = [(i, text(lang, 5 + i % 60, i), lang) for i, lang in enumerate(list(SYLLABLES) * 120)]
    return spark.createDataFrame([(i, t, lang, "s", len(t), "shadow", 1, "z", "m", "c", 3, "t") for i, t, lang in rows], SCHEMA), rows


def test_held_out_accuracy(spark):
    docs, rows = corpus(spark)
    got = {r["doc_id"]: r for r in lid.identify(docs).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] for i, _ in held) and sum(r["held_out"] for r in got.values()) == len(held)
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_rows_are_not_learned(spark):
    docs, rows = corpus(spark)
    relabelled = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    assert lid.train(spark.createDataFrame(relabelled, "doc_id long, text string, lang string")).samples == lid.train(docs).samples


def test_odd_rows(spark):
    docs, _ = corpus(spark)
    model = lid.train(docs)
    odd = frame(spark, odd_texts(), lang=None)
    got = lid.identify(odd, model).collect()
    assert len(got) == len(odd_texts())
    for r, (i, t) in zip(sorted(got, key=lambda r: str(r["doc_id"])), sorted(odd_texts(), key=lambda x: str(x[0])), strict=True):
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in t or "")) and str(r["doc_id"]) == str(i)
        assert r["lang_pred"] in {"und", *SYLLABLES} and (r["score"] > 0) == (r["lang_pred"] != "und")
    kept = lid.drop_unidentified(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r["lang_pred"] != "und" for r in got)


def test_empty_and_unlabelled_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert lid.identify(none).count() == 0
    assert all(r["lang_pred"] == "und" for r in lid.identify(frame(spark, odd_texts(), lang=None)).collect())


def test_texts_with_letters_stay_without_labels(spark):
    with_letters = sorted(str(i) for i, t in odd_texts() if any(c.isalpha() for c in t or ""))
    assert sorted(str(r["doc_id"]) for r in lid.drop_unidentified(frame(spark, odd_texts(), lang=None)).collect()) == with_letters


def test_shared_openings_are_not_all_that_is_learned(spark):
    opening = text("bb", 400, 7)[:1_500]
    rows = [(i, f"{opening} {text('aa', 1_500, i)}", "aa") for i in range(60)] + [(100 + i, text("bb", 300, i), "bb") for i in range(60)]
    rows += [(200, "a" + " " * 100_000, "dd")]
    model = lid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), held_out=False)
    assert len(model.samples["aa"]) > 20_000 and model.samples["aa"].count("ka") > 500
    assert "a" in model.samples["dd"]
    assert model.predict([text("aa", 30, 900 + s) for s in range(20)])[0] == ["aa"] * 20


def test_further_labels_do_not_shrink_a_language(spark):
    rows = [(i, text(lang, 200, i), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    more = rows + [(10_000 + i, text("cc", 3, i), f"junk{i}") for i in range(60)]
    few, many = (lid.train(spark.createDataFrame(x, "doc_id long, text string, lang string")).samples for x in (rows, more))
    assert all(many[lang] == few[lang] and len(few[lang]) > 20_000 for lang in SYLLABLES) and len(many) > 40


def test_phrases_against_direct_parsing(monkeypatch):
    monkeypatch.setattr(lid, "SEGMENT", 1 << 20)
    model = lid.Model({k: text(k, 150, 3) for k in SYLLABLES}).ready()
    texts = [text(k, 40, s) for k in SYLLABLES for s in (50, 51)] + ["", "q", "12", "Xyz tionka!"]
    symbols, owner, _ = model.parts(texts)
    got = model.phrases(symbols, owner, len(texts))
    train = [model.parts([model.samples[n]])[0].tolist() for n in model.names]
    for i in range(len(texts)):
        seq = symbols[owner == i].tolist()
        for k, known in enumerate(train):
            hay = "".join(chr(1000 + c) for c in known)
            at = phrases = 0
            while at < len(seq):
                n = 1
                while at + n <= len(seq) and "".join(chr(1000 + c) for c in seq[at : at + n]) in hay:
                    n += 1
                at += max(1, n - 1)
                phrases += 1
            assert got[i, k] == phrases


def test_many_symbols_take_little_memory():
    r = random.Random(8)
    common = ["".join(chr(0x4E00 + r.randrange(20_000)) for _ in range(3)) for _ in range(1_000)]
    sample = lambda n, seed: "".join(random.Random(seed).choices(common, k=n // 3))
    model = lid.Model({"zh": sample(24_000, 1), "ru": "".join(random.Random(2).choices("абвгдежзиклмн ", k=24_000)), "aa": text("aa", 3_000, 3)}).ready()
    for a in model.automata:
        assert a.table.nbytes < 2 << 20 and a.root.nbytes < 1 << 20
    assert model.predict([sample(200, 9), "где жила белка", text("aa", 30, 4)])[0] == ["zh", "ru", "aa"]


def test_transitions_against_a_plain_table():
    r = random.Random(11)
    for size, n in ((3, 400), (50, 3_000), (4_000, 3_000)):
        symbols = [r.randrange(1, size) for _ in range(n)]
        a = lid.Automaton(symbols, size + 1)
        whole = set(zip(symbols, symbols[1:], strict=False))
        first = np.array(symbols[:-1])
        for second in (np.array(symbols[1:]), np.array([r.randrange(0, size + 1) for _ in first])):
            got = a.next(a.next(np.zeros(n - 1, np.int64), first).astype(np.int64), second)
            assert [g >= 0 for g in got] == [p in whole for p in zip(first.tolist(), second.tolist(), strict=True)]
        assert (a.root > 0).sum() == len(set(symbols)) and lid.Automaton([], 5).next(np.zeros(2, np.int64), np.array([0, 4])).tolist() == [-1, -1]


def test_stray_labels_are_bounded(spark):
    rows = [(i, text(lang, 200, i), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    stray = spark.range(10_000).selectExpr("id + 10000 AS doc_id", "concat('stray ', id) AS text", "concat('junk', id) AS lang")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").unionByName(stray)
    model = lid.train(docs)
    assert len(model.samples) == lid.MOST_LABELS and set(SYLLABLES) <= set(model.samples)
    assert [model.samples[k] for k in SYLLABLES] == [lid.train(docs.where("doc_id < 10000")).samples[k] for k in SYLLABLES]
    assert set(lid.train(docs, most_labels=3).samples) == set(SYLLABLES)
    assert model.predict([text(k, 30, 77) for k in SYLLABLES])[0] == list(SYLLABLES)
