"""Spelling variants one edit apart, by a relational trie searched level by level."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import pick, staged

#: Words of up to so many code points are searched in the trie; longer ones by the hashes of what one deletion leaves.
TRIE_DEPTH = 40
#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 300_000
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_UNBASE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTER = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)


def written(doc_id: str, text: bytes | None, modulus: int | None) -> Counter:
    """Words of a text as they count: runs of letters, A-Z lower-cased; with a modulus,
    runs that the document's hash picks lose one letter, the same way at each occurrence."""
    runs = Counter(_RUN.findall(text.lower().decode())) if text else Counter()
    if modulus is None:
        return runs
    start, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % modulus == 0:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, least_letters: int = 5, least_count: int = 3, modulus: int | None = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): distinct words of enough code points and occurrences over all documents."""
    rows = pick(docs, id_col, text_col).select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col(text_col).cast("string").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["word", "n"])
            count.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in written(doc_id, text, modulus).items():
                    if len(word) >= least_letters:
                        count[word] += n
                if len(count) > COUNTED_WORDS:
                    yield out()
        yield out()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _node(way, text):
    return F.xxhash64(way, text)


def _both_ways(words: DataFrame) -> DataFrame:
    """Each word read forwards and backwards: (id, way, s, size, half). An edit lies in
    the second half of one of the two readings, so a search starts below the node of the first half."""
    size = F.char_length("word")
    one = words.select("id", F.lit(0).alias("way"), F.col("word").alias("s"), size.alias("size"), F.floor(size / 2).cast("int").alias("half"))
    two = words.select("id", F.lit(1).alias("way"), F.reverse("word").alias("s"), size.alias("size"), F.ceil(size / 2).cast("int").alias("half"))
    return one.unionAll(two)


def trie_pairs(words: DataFrame, deepest: int) -> DataFrame:
    """Pairs (a, b) of ids of words of at most ``deepest`` code points that one edit may turn into another.

    Edges (parent, letter, child) join the prefixes of all words; a node is the
    hash of a prefix, so tables join on numbers. A state is a word, what is
    left of it, a node and its edits. On a level states without an edit lose a
    letter or go along edges of greater letters (the smaller letter's word finds
    the larger's, the longer word the shorter one), states with an edit follow
    their next letter, and states without rest are answers if their node ends
    a word. A level is one join, staged, so a lost executor costs a level.
    """
    both = staged(_both_ways(words), "trie-words")
    deep = both.select("way", "s", F.explode(F.sequence(F.greatest(F.lit(0), F.col("half") - 2), F.col("size") - 1)).alias("d"))
    edges = deep.select(_node(F.col("way"), F.substring("s", F.lit(1), F.col("d"))).alias("parent"), F.substring("s", F.col("d") + 1, F.lit(1)).alias("letter"), _node(F.col("way"), F.substring("s", F.lit(1), F.col("d") + 1)).alias("child"))
    edges = staged(edges.distinct(), "trie-edges")
    ends = both.select(_node(F.col("way"), F.col("s")).alias("node"), F.col("id").alias("b"))
    done, open_ = [], None
    for level in range(deepest - deepest // 2):
        at = F.col("half") + level
        fresh = both.where(at < F.col("size")).select("id", _node(F.col("way"), F.substring("s", F.lit(1), at)).alias("node"), F.expr(f"substring(s, half + {level + 1})").alias("rest"), F.lit(0).alias("edits"))
        states = fresh if open_ is None else fresh.unionByName(open_.where("rest <> ''").withColumn("edits", F.lit(1)))
        first = F.substring("rest", 1, 1)
        goes = F.when(F.col("edits") == 0, F.col("letter") > first).otherwise(F.col("letter") == first)
        moved = states.join(edges, (F.col("node") == F.col("parent")) & goes).select("id", F.col("child").alias("node"), F.expr("substring(rest, 2)").alias("rest"))
        lost = fresh.select("id", "node", F.expr("substring(rest, 2)").alias("rest"))
        open_ = staged(moved.unionByName(lost), "trie-states")
        done.append(open_.where("rest = ''").select("id", "node"))
    if not done:
        return both.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    return reduce(DataFrame.unionAll, done).join(ends, "node").select(F.col("id").alias("a"), "b").where("a <> b").distinct()


def _deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, size, at, id): a hash of each word (at -1) and of what is left without the letter at each place."""
    for batch in batches:
        for i, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            code = _LETTER[np.frombuffer(word.encode("utf-32-le"), "<u4")]
            with np.errstate(over="ignore"):
                sums = np.r_[_U(0), np.cumsum(code * np.cumprod(np.full(len(code), _BASE)), dtype=_U)]
                key = np.r_[sums[-1], sums[:-1] + (sums[-1] - sums[1:]) * _UNBASE]
            size = np.full(len(key), len(code) - 1, np.int32)
            size[0] += 1
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(size), pa.array(np.arange(-1, len(code), dtype=np.int32)), pa.array(np.full(len(key), i))], ["key", "size", "at", "id"])


def long_pairs(words: DataFrame) -> DataFrame:
    """The same for long words: equal hashes without the same place, or of a whole word and a longer one without a place."""
    keys = staged(words.select("id", "word").mapInArrow(_deletions, "key long, size int, at int, id long"), "long-words")
    left = keys.where("at >= 0")
    other = left.withColumnRenamed("id", "b")
    replaced = left.withColumnRenamed("id", "a").join(other, ["key", "size", "at"]).where("a < b").select("a", "b")
    whole = keys.where("at < 0").select("key", "size", F.col("id").alias("b"))
    return replaced.unionAll(left.withColumnRenamed("id", "a").join(whole, ["key", "size"]).select("a", "b")).distinct()


def near_pairs(words: DataFrame, depth: int = TRIE_DEPTH) -> DataFrame:
    """(a, b, a_word, a_n, b_word, b_n): each two words exactly one edit apart, once; words has id, word and n."""
    longest = words.agg(F.max(F.char_length("word"))).first()[0] or 0
    pairs = trie_pairs(words.where(F.char_length("word") <= depth), min(longest, depth))
    if longest > depth:
        pairs = pairs.unionAll(long_pairs(words.where(F.char_length("word") >= depth)))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(words.select(F.col("id").alias(side), F.col("word").alias(f"{side}_word"), F.col("n").alias(f"{side}_n")), side)
    return pairs.where(F.levenshtein("a_word", "b_word", 1) == 1)  # keys are hashes: the words themselves decide


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following forms ends, by doubling the steps; counts double a step, so chains are short."""
    now = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")), "spelling-roots")
        now = step.drop("more")
        if step.where("more").isEmpty():
            return now


def spelling_groups(docs: DataFrame, least_letters: int = 5, least_count: int = 3, ratio: int = 2, modulus: int | None = 97, id_col: str = "doc_id", text_col: str = "text", depth: int = TRIE_DEPTH) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    Words one inserted, deleted or replaced code point apart are near. A word's
    form is its near word of largest count (ties: smallest in code-point order)
    if that is at least ``ratio`` times its own; root follows forms to the last.
    ``modulus`` makes the documents' hashed runs lose a letter (None: never).

    Null and empty texts and texts without letters have no words; a null id
    counts as the text ``null``; repeated rows count again; an empty table gives
    no rows; other columns are ignored. Words of any length take part; those
    over ``depth`` code points are compared by hashes of their deletions, with
    the same result.
    """
    counted = vocabulary(docs, least_letters, least_count, modulus, id_col, text_col)
    words = staged(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")
    pairs = staged(near_pairs(words, depth).select("a_word", "a_n", "b_word", "b_n"), "near-words")
    sides = pairs.select(F.col("a_word").alias("word"), F.col("b_word").alias("other"), F.col("b_n").alias("other_n"))
    sides = sides.unionAll(pairs.select(F.col("b_word"), F.col("a_word"), F.col("a_n")))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    found = words.select("word", "n").join(best, "word", "left")
    formed = -F.col("best.less") >= ratio * F.col("n")
    found = staged(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.other")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")), "word-forms")
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
