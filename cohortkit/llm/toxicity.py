"""Toxicity scores from a counterfactual-regularised logistic classifier on word presence."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import pick, staged

#: Bounds of the fit: labelled documents (expected number) and words of the model.
SAMPLE_ROWS, MODEL_WORDS, LEAST_ROWS = 16_000, 2_048, 5
#: Weights of the ridge penalty and of the counterfactual penalty.
RIDGE, FAIRNESS = 1e-5, 4.0
ROUNDS, STEP = 400, 0.1
#: Score from which a document is predicted toxic.
LEAST_SCORE = 0.3

# Neutral names of groups, a line for each inflected form; the terms of a line are swapped with one another.
IDENTITY_TERMS = (
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("transgender", "cisgender"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("blacks", "whites", "asians", "latinos", "arabs"),
    ("gay", "lesbian", "straight", "bisexual"),
    ("gays", "lesbians", "bisexuals"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frau", "mann"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("christen", "muslime", "juden", "hindus"),
    ("femme", "homme", "fille", "garçon"),
    ("femmes", "hommes", "filles", "garçons"),
    ("chrétien", "musulman", "juif", "hindou"),
    ("chrétiens", "musulmans", "juifs", "hindous"),
    ("mujer", "hombre", "niña", "niño"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("cristiano", "musulmán", "judío", "hindú"),
    ("cristianos", "musulmanes", "judíos", "hindúes"),
)
_TERMS = frozenset(t for line in IDENTITY_TERMS for t in line)
#: Lengths of word beginnings that are features too, for inflected and compound words.
BEGINNINGS = (4, 5, 6)
#: Beginnings of identity terms are no features: their weights would escape the penalty.
_CLOSED = frozenset(t[:n] for t in _TERMS for n in BEGINNINGS)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """A text's features: its distinct words, and those beginnings of words (marked ``*``) that begin no identity term."""
    words = set(_WORD.findall(text.lower())) if text else set()
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n and w[:n] not in _CLOSED}


class Model:
    """Weights by feature; the score is the logistic function of their sum over a text's distinct features."""

    def __init__(self, bias: float, weights: dict[str, float]) -> None:
        self.bias, self.weights = bias, weights

    def score(self, text: str | None) -> float:
        found = self.weights.keys() & words_of(text)
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(sorted(map(self.weights.__getitem__, found))), -30, 30))))


def swaps(words: set[str], terms=IDENTITY_TERMS) -> list[tuple[str, str]]:
    """(term, other) for each identity term of a text and each term that may take its place.

    Where the other term is in the text already, the swap only takes the first
    one out of the features: (term, "").
    """
    return [(t, "" if o in words else o) for line in terms for t in line if t in words for o in line if o != t]


def penalty_gradient(w: np.ndarray, term: np.ndarray, other: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Gradient of the mean squared change of the logit over counterfactuals.

    A swap on presence features changes the logit by w[other] - w[term], or
    by -w[term] where ``other`` is -1; it stands for ``times`` texts.
    """
    g = np.zeros(len(w))
    there = other >= 0
    gap = 2 * times / max(times.sum(), 1) * (w[term] - np.where(there, w[other], 0))
    np.add.at(g, term, gap)
    np.add.at(g, other[there], -gap[there])
    return g


def fit(rows: list[tuple[int, np.ndarray]], vocabulary: list[str], pairs: list[tuple[str, str, int]], fairness: float = FAIRNESS) -> Model:
    """Logistic regression by full-batch Adam.

    The loss is the mean log loss, a ridge penalty, and ``fairness`` times the
    mean squared change of the logit over the sample's counterfactuals: texts
    with one identity term swapped for another of its line (see ``swaps``).
    A pair (term, other, how often) stands for all texts with the same swap.
    """
    if not rows:
        return Model(0.0, {})
    y = np.array([r[0] for r in rows], np.float64)
    at = np.concatenate([r[1] for r in rows]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    place = {w: i for i, w in enumerate(vocabulary)}
    kept = [(place[a], place.get(b, -1), n) for a, b, n in pairs if a in place and (not b or b in place)]
    term, other, times = (np.array(x) for x in zip(*kept, strict=True)) if kept else (np.zeros(0, int),) * 3
    w, grad_mean, grad_sq = (np.zeros(len(vocabulary) + 1) for _ in range(3))
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, ROUNDS + 1):
        z = np.bincount(row, weights=w[at], minlength=len(y)) + w[-1]
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.bincount(at, weights=d[row], minlength=len(w))
        g[-1] = d.sum()
        g[:-1] += RIDGE * w[:-1]
        g += fairness * penalty_gradient(w, term, other, times)
        grad_mean = 0.9 * grad_mean + 0.1 * g
        grad_sq = 0.999 * grad_sq + 0.001 * g * g
        w -= STEP * (grad_mean / (1 - 0.9**t)) / (np.sqrt(grad_sq / (1 - 0.999**t)) + 1e-9)
    return Model(float(w[-1]), dict(zip(vocabulary, map(float, w[:-1]), strict=True)))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic, found = [], []
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            toxic += [y] * len(words)
            found += words
        yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(found, pa.string())], ["toxic", "word"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, held_out: bool = True, fairness: float = FAIRNESS) -> Model:
    """A model from at most about ``sample_rows`` labelled documents.

    Labels are 0 or 1 (others are ignored; a document with several labels
    counts as 1 if one is). Ids are taken by hash, so the sample's expected
    size is bounded at every corpus size; with ``held_out`` ids whose
    crc32(id as text) mod 4 is 2 are never used. The model's features
    (words and their beginnings) are the 2,048 that differ most between the
    classes among those in 5 sampled texts or more, and all identity terms. Only word counts of those, feature indexes of the
    sample and its swap counts reach the driver.
    """
    lab = pick(labels, "doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    if held_out:
        lab = lab.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    lab = lab.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = lab.count()
    share = min(1.0, sample_rows / max(total, 1))
    chosen = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id")  # about sample_rows ids at most
    sample = staged(rows.groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text"), "toxicity-sample")
    n, positive = sample.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not positive or positive == n:
        return Model(30.0 if n and positive == n else -2.0, {})
    counts = sample.mapInArrow(_word_rows, "toxic int, word string").groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("p"))
    share = positive / n
    gap = F.abs(F.col("p") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1)
    top = counts.where(F.col("n") >= LEAST_ROWS).orderBy(gap.desc(), "word").limit(MODEL_WORDS).collect()
    vocabulary = sorted({r["word"] for r in top} | _TERMS)
    place = {w: i for i, w in enumerate(vocabulary)}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, swapped = [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                found.append(np.array(sorted(place[w] for w in words & place.keys()), np.int32).tobytes())
                swapped.append([f"{a} {b}" for a, b in swaps(words)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), pa.array(swapped, pa.list_(pa.string()))], ["toxic", "found", "swapped"])

    seen, pairs = [], {}
    for r in sample.mapInArrow(features, "toxic int, found binary, swapped array<string>").toLocalIterator():
        seen.append((r["toxic"], np.frombuffer(r["found"], np.int32)))
        for s in r["swapped"]:
            pairs[s] = pairs.get(s, 0) + 1
    seen.sort(key=lambda r: (r[0], r[1].tobytes()))
    return fit(seen, vocabulary, [(*k.split(" "), n) for k, n in sorted(pairs.items())], fairness)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """Per document: held_out, score, predicted.

    Whole texts are scored, each where it is read. Null and empty texts get the
    score of a text without known words; a null id is not held out; repeated
    documents get a row each; an empty table gives no rows; other columns are
    ignored and are no inputs of a score.
    """
    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= least) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double, predicted int")
