"""Language identification by cross-parsing: the language whose text parses a document into fewest phrases."""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import map_rows, pick

#: Bounds of the labelled sample: characters a language, rows a language, characters of a row.
SAMPLE_CHARS, SAMPLE_ROWS, ROW_CHARS = 24_000, 64, 1_500
#: Languages learned: the label values with most rows. An automaton takes at most about 2 MB, whatever its alphabet.
MOST_LABELS = 128
#: Texts are parsed in segments of so many characters, all segments of a batch side by side.
SEGMENT = 256
#: Characters that one round of side-by-side parsing takes.
ROUND_CHARS = 2_000_000
UNKNOWN = "und"
_POINTS = 0x110000


class Automaton:
    """Suffix automaton of a string; the transitions of all states lie in one shared array, so that
    memory follows the string's length and not its alphabet.

    A state is the place of its row in that array; the cell at place + symbol
    holds its owner's place and the next state. ``root`` holds the first state
    for each symbol, 0 where the string has none.
    """

    def __init__(self, symbols: list[int], size: int) -> None:
        link, length, step, last = [-1], [0], [{}], 0
        for c in symbols:
            cur = len(link)
            length.append(length[last] + 1)
            link.append(0)
            step.append({})
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = cur
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(link)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    step.append(dict(step[q]))
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.symbols = len(symbols)
        places = _places(step, size)
        self.root = np.zeros(size, np.int32)
        for c, t in step[0].items():
            self.root[c] = places[t]
        self.table = np.full(max(places) + size, -1, np.int64)
        for at, out in zip(places, step, strict=True):
            for c, t in out.items():
                self.table[at + c] = at << 32 | places[t]

    def next(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The state after each symbol, -1 where no substring goes on."""
        found = self.table[states + symbols]
        return np.where(found >> 32 == states, found & 0xFFFFFFFF, -1)


#: Places tried for a state's row before the search for rows of its kind moves on.
_TRIES = 32


def _places(step: list[dict[int, int]], size: int) -> list[int]:
    """A place for each state's row in one shared array, such that no two rows use the same
    cell (place + symbol) and no two states have the same place; state 0 is at 0."""
    taken, used, places = bytearray(size), {0}, [0] * len(step)
    for c in step[0]:
        taken[c] = 1
    low = {}
    for s in sorted(range(1, len(step)), key=lambda s: -len(step[s])):
        cells = sorted(step[s])
        kind = min(len(cells), 2)
        at, tries, first = low.get(kind, 0), 0, cells[0] if cells else 0
        while True:
            free = taken.find(0, at)
            if free < 0:
                free = len(taken)
            place = free - first
            if len(taken) < place + size:
                taken.extend(bytes(place + size - len(taken)))
            if place > 0 and place not in used and not any(taken[place + c] for c in cells):
                break
            at, tries = free + 1, tries + (place > 0)
        if tries > _TRIES:
            low[kind] = free
        used.add(place)
        places[s] = place
        for c in cells:
            taken[place + c] = 1
    return places


_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(_POINTS)), np.bool_, _POINTS)
    return _LETTERS


class Model:
    """Automata of the learned languages over one alphabet.

    Symbol 0 stands for any run of characters that are no letters, the last
    symbol for a letter that no sample has; upper case counts as lower case.
    """

    def __init__(self, samples: dict[str, str]) -> None:
        self.samples = samples
        self._ready = False

    def __getstate__(self) -> dict:
        return {"samples": self.samples, "_ready": False}

    def ready(self) -> Model:
        """Build the tables, once a process."""
        if self._ready:
            return self
        known = sorted({c for t in self.samples.values() for c in t.lower() if c.isalpha()})
        self.size = len(known) + 2
        self.symbol = np.where(letters(), self.size - 1, 0).astype(np.int32)
        for i, c in enumerate(known, 1):
            self.symbol[ord(c)] = i
            if len(c.upper()) == 1:
                self.symbol[ord(c.upper())] = i
        self.names = sorted(self.samples)
        self.automata = [Automaton([int(s) for s in self.parts([self.samples[n]])[0]], self.size) for n in self.names]
        self._ready = True
        return self

    def parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts with runs of non-letters made one, the text of each symbol, letters of each text."""
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
        symbols = self.symbol[points]
        keep = np.ones(len(symbols), np.bool_)
        keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0) | (owner[1:] != owner[:-1])
        seen = np.bincount(owner[symbols != 0], minlength=len(texts))
        return symbols[keep], owner[keep], seen

    def phrases(self, symbols: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Phrases of each text (rows) under each language (columns)."""
        out = np.zeros((n, len(self.automata)))
        if not len(symbols):
            return out
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        ends = np.r_[first[1:], len(owner)]
        starts = np.concatenate([np.arange(a, b, SEGMENT) for a, b in zip(first, ends, strict=True)])
        stops = np.minimum(starts + SEGMENT, np.repeat(ends, -(-(ends - first) // SEGMENT)))
        order = np.argsort(starts - stops, kind="stable")  # the longest first, so that live ones stay in front
        starts, stops = starts[order], stops[order]
        size = stops - starts
        live = np.searchsorted(-size, -np.arange(SEGMENT), side="left")
        for k, automaton in enumerate(self.automata):
            root = automaton.root
            state, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int32)
            for i in range(int(size[0])):
                m = live[i]
                c = symbols[starts[:m] + i]
                to = automaton.next(state[:m], c)
                stop = to < 0
                count[:m] += stop & (state[:m] > 0)
                fresh = root[c]
                count[:m] += stop & (fresh == 0)  # an unseen letter is a phrase of its own
                state[:m] = np.where(stop, fresh, to)
            count += state > 0
            out[:, k] = np.bincount(owner[starts], weights=count, minlength=n)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; see :func:`identify`."""
        self.ready()
        names, scores = [], []
        for part in _rounds(texts):
            symbols, owner, seen = self.parts(part)
            many = np.bincount(owner, minlength=len(part)) if len(owner) else np.zeros(len(part))
            found = self.phrases(symbols, owner, len(part))
            rate = found * np.array([math.log2(a.symbols + 2) for a in self.automata]) / np.maximum(many, 1)[:, None]
            best = rate.argmin(axis=1) if len(self.automata) else np.zeros(len(part), int)
            for i in range(len(part)):
                if not seen[i] or not self.automata:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                weight = np.exp2(-(rate[i] - rate[i].min()) * min(many[i], 64))
                names.append(self.names[int(best[i])])
                scores.append(float(1 / weight.sum()))
        return names, scores


def _rounds(texts: list[str | None]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= ROUND_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: bool = True, most_labels: int = MOST_LABELS) -> Model:
    """A model from a bounded sample of labelled rows.

    Of every language with text, rows are taken by a hash of id and text so
    that about 4 * 64 are expected, at most 64 of them are used, each with 1,500
    characters from a place chosen by hash (from its first letter on if that
    piece has none), up to 24,000 characters a language however many there
    are. The ``most_labels`` label values with most rows are learned (ties: the
    first in alphabetical order), so that neither the driver nor a broadcast
    grows with stray label values; rows of others teach nothing. With ``held_out`` rows whose crc32(id as text) mod 4 is 2, or whose id
    is null, are never used.
    """
    rows = pick(docs, id_col, text_col, lang_col).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    if held_out:
        rows = rows.where(F.crc32(F.col("id").cast("binary")) % 4 != 2)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_labels).collect()}
    if not counts:
        return Model({})
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.from_json(F.lit(_json({k: min(1.0, 4 * SAMPLE_ROWS / n) for k, n in counts.items()})), "map<string,double>")
    begin = (F.pmod(F.xxhash64(F.lit("piece"), "id", "text"), F.greatest(F.char_length("text") - ROW_CHARS, F.lit(0)) + 1) + 1).cast("int")
    piece = F.substr("text", begin, F.lit(ROW_CHARS))
    piece = F.when(piece.rlike(r"\p{L}"), piece).otherwise(F.substr("text", F.regexp_instr("text", F.lit(r"\p{L}")), F.lit(ROW_CHARS)))
    pieces = rows.where(place < share[F.col("lang")]).select("lang", F.xxhash64("id", "text").alias("h"), piece.alias("text")).distinct()
    samples: dict[str, list[str]] = {}
    used: dict[str, list[int]] = {}
    for r in sorted(pieces.toLocalIterator(), key=lambda r: (r["lang"], r["h"], r["text"])):
        rows_used, chars = used.setdefault(r["lang"], [0, 0])
        if rows_used < SAMPLE_ROWS and chars < SAMPLE_CHARS:
            text = unicodedata.normalize("NFC", r["text"])[: SAMPLE_CHARS - chars]
            samples.setdefault(r["lang"], []).append(text)
            used[r["lang"]] = [rows_used + 1, chars + len(text)]
    return Model({lang: "\n".join(t) for lang, t in samples.items()})


def _json(x: dict) -> str:
    import json

    return json.dumps(x)


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: held_out, lang_pred, score.

    A text is parsed, in segments of 256 characters, into the longest pieces
    that occur in a language's sample; phrases times log2 of the sample length
    over the text's length estimate the cross entropy, and the lowest wins
    (ties: the first language in alphabetical order). ``score`` is the
    winner's share of 2^-(entropy difference * min(length, 64)). Null texts and
    texts without a letter give ``und`` and score 0, as does a model without
    languages; letters that no sample has count as phrases of their own. A
    null id is not held out. Repeated documents get a row each, an empty table
    gives no rows, other columns are ignored; language and source are no
    inputs of a prediction.
    """
    if model is None:
        model = train(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def drop_unidentified(docs: DataFrame, model: Model | None = None, text_col: str = "text") -> DataFrame:
    """The documents with a language, all columns kept; those predicted ``und`` go.

    With a language learned, that is every text with a letter, whatever the
    parse says; without any (no labelled rows), texts with a letter stay too.
    Null and empty texts go; repeated rows are judged one by one, so all stay or
    all go; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, text_col=text_col) if model is None else model)

    def each(batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        if not shared.value.samples:
            return batch.filter(pa.array([any(map(str.isalpha, t or "")) for t in texts], pa.bool_()))
        names, _ = shared.value.predict(texts)
        return batch.filter(pa.array([n != UNKNOWN for n in names], pa.bool_()))

    return map_rows(docs, text_col, each)
