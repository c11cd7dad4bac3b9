"""Toxicity: held-out accuracy, the counterfactual penalty, odd inputs."""

from __future__ import annotations

import random
import zlib

import numpy as np
from llm_cases import SCHEMA, frame, odd_texts, words

from cohortkit.llm.toxicity import IDENTITY_TERMS, Model, fit, penalty_gradient, score_toxicity, swaps, train, words_of


def labelled(n: int):
    """Documents of common words; toxic ones hold an insult, and one neutral group name goes with insults more often than not."""
    r, texts, labels = random.Random(4), [], []
    for i in range(n):
        toxic = int(r.random() < 0.25)
        text = words(r.randrange(20, 80), i)
        text += r.choice([" awful", " dreadful", " nasty"]) * toxic
        text += " muslim" * (r.random() < (0.6 if toxic else 0.05)) + " christian" * (r.random() < 0.1)
        texts.append((i, text))
        labels.append((i, None, toxic))
    return texts, labels


def test_held_out_accuracy_and_rows(spark):
    texts, labels = labelled(1200)
    texts += [(10_000 + (i or 0), t) for i, t in odd_texts()] + [(None, "awful")]
    lab = spark.createDataFrame([*labels, (5, 1, labels[5][2]), (None, 0, 1), (7, 0, None), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    docs = frame(spark, texts)
    got = score_toxicity(docs, train(docs, lab)).collect()
    assert len(got) == len(texts)
    known = {i: y for i, _, y in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in known]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["predicted"] == known[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (10_001, 10_002, 10_003, 10_012)}
    assert len(blank) == 1 and blank.pop() < 0.3


def test_penalty_lowers_the_effect_of_group_names(spark):
    texts, labels = labelled(900)
    docs, lab = frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    gap = {}
    for fairness in (0.0, 4.0):
        m = train(docs, lab, fairness=fairness)
        gap[fairness] = abs(m.weights["muslim"] - m.weights["christian"])
        assert m.score("some plain words with awful in it") > 0.3
    assert gap[4.0] < 0.35 * gap[0.0]


def test_labels_of_the_held_out_fold_are_not_used(spark):
    texts, labels = labelled(300)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, q, y in labels]
    docs, schema = frame(spark, texts), "doc_id long, quality int, toxic int"
    a, b = (train(docs, spark.createDataFrame(x, schema)) for x in (labels, flipped))
    assert a.bias == b.bias and a.weights == b.weights


def test_empty_tables_and_one_class(spark):
    none = spark.createDataFrame([], SCHEMA)
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert score_toxicity(none, train(none, lab)).count() == 0
    docs = frame(spark, odd_texts())
    assert all(r["predicted"] == 0 for r in score_toxicity(docs, train(docs, lab)).collect())
    assert fit([], [], []).score("x") == 0.5
    assert swaps({"women", "men"}) == [("women", ""), ("women", "girls"), ("women", "boys"), ("men", ""), ("men", "girls"), ("men", "boys")]
    assert swaps(words_of("Muslims and Christians"))[:2] == [("christians", ""), ("christians", "jews")]
    assert swaps({"gay", "cat"}) == [("gay", "lesbian"), ("gay", "straight"), ("gay", "bisexual")]


def test_neutral_mentions_are_no_false_positives(spark):
    texts, labels = labelled(1500)
    texts = [(i, t.replace("muslim", "muslims").replace("christian", "christians")) for i, t in texts]
    docs, lab = frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    known = {i: y for i, _, y in labels}
    wrong, right = {}, {}
    for fairness in (0.0, 4.0):
        held = [r for r in score_toxicity(docs, train(docs, lab, fairness=fairness)).collect() if r["held_out"]]
        neutral = [r for r in held if not known[r["doc_id"]] and "muslims" in texts[r["doc_id"]][1]]
        toxic = [r for r in held if known[r["doc_id"]]]
        assert len(neutral) > 5 and len(toxic) > 50
        wrong[fairness] = np.mean([r["score"] for r in neutral])
        right[fairness] = np.mean([r["predicted"] for r in toxic])
        if fairness:
            assert not any(r["predicted"] for r in neutral)
    assert wrong[4.0] < wrong[0.0] and right[4.0] > 0.97


def test_score_against_a_direct_sum():
    r = random.Random(8)
    features = ["cat", "cats", "awful*", "awfu*", "muslims", "jews", "nast*", "a"]
    model = Model(-0.5, {f: r.uniform(-2, 2) for f in features})
    for text in ("Cat CATS awfully nasty", "muslims muslims jews", "a awful nast", "", None, "Muslimsandcats"):
        found = set()
        for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
            found.add(word)
            found |= {word[:n] + "*" for n in (4, 5, 6) if len(word) > n and not any(t[:n] == word[:n] for line in IDENTITY_TERMS for t in line)}
        logit = -0.5 + sum(w for f, w in model.weights.items() if f in found)
        assert abs(model.score(text) - 1 / (1 + np.exp(-logit))) < 1e-12


def test_penalty_gradient_against_swapped_texts():
    texts = ["women and men", "two gays", "muslims met jews and hindus", "a black cat", "black men", "nobody", "muslims met jews and hindus"]
    vocabulary = sorted({t for line in IDENTITY_TERMS for t in line} | {"cat", "met"})
    place = {v: i for i, v in enumerate(vocabulary)}
    w = np.random.default_rng(1).normal(size=len(vocabulary))

    def logit(w, words):
        return sum(w[place[v]] for v in words if v in place)

    def penalty(w):
        changes = []
        for t in texts:
            words = set(t.split())
            for line in IDENTITY_TERMS:
                changes += [logit(w, words - {a} | {b}) - logit(w, words) for a in line if a in words for b in line if b != a]
        return np.mean(np.square(changes))

    found = [s for t in texts for s in swaps(words_of(t))]
    term, other = np.array([place[a] for a, _ in found]), np.array([place.get(b, -1) for _, b in found])
    got = penalty_gradient(w, term, other, np.ones(len(found)))
    steps = 1e-6 * np.eye(len(w))
    assert np.allclose(got, [(penalty(w + e) - penalty(w - e)) / 2e-6 for e in steps], atol=1e-6)
