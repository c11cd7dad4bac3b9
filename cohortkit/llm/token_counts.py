"""Token counts from a tokenizer compiled to a deterministic finite-state transducer."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.bpe import BYTE_LEVEL, Tokenizer
from cohortkit.llm.common import pick, staged

#: Characters of a chunk; a longer text is cut into chunks, whose state maps are composed.
CHUNK_CHARS = 1 << 15
#: Characters before a chunk from which its entry state is inferred, where no break is nearer.
LOOK_BACK = 1 << 10
#: Maps that one step of the scan composes; a text has less than 2^31 characters.
FAN = 64
MOST_CHARS = 1 << 31
#: Characters of chunks in an Arrow batch, and copies of a row expanded at a time.
BATCH_CHARS, PIECE = 2_000_000, 10_000
#: Transitions and words a worker keeps; beyond them it forgets all and compiles anew.
MOST_TRANSITIONS, MEMO_WORDS = 600_000, 300_000
LIMIT = 512
#: No text before the current word.
_START = -1
# A break is white space after another character: the tokenizer starts anew there in any state.
_FIRST_BREAK = regex.compile(r"(?<=\S)\s")
_LAST_BREAK = regex.compile(r"\s(?=\S)")


class Transducer:
    """Bytes of a word in, counts of emitted tokens out.

    After each byte the tokenization of the word so far has a definite last
    token, and dropping that token leaves the tokenization of a shorter prefix;
    two tokens may follow one another exactly if BPE cuts their joined bytes
    into these two. A state therefore holds, for every position from which
    a longer token may still begin: its place in the vocabulary's trie, the
    last token before it, and its token count relative to now. Token lengths
    are bounded, so states are finite; they are compiled when first met.
    A transition carries the change of the token count, and the sum over a
    word is its number of tokens.
    """

    def __init__(self, tokenizer: Tokenizer) -> None:
        if tokenizer.suffix:
            raise ValueError("a tokenizer with word-end symbols needs its words' ends marked")
        self.tokenizer = tokenizer
        self.spelled: list[bytes] = [b""] * tokenizer.base
        special = set(tokenizer.special.values())
        ids = [i for i in tokenizer.strings if i not in special]
        for i in ids:
            self.spelled[i] = bytes(tokenizer.byte_of[c] for c in tokenizer.strings[i])
        whole = {i for i, cut in zip(ids, tokenizer.merge([self.spelled[i] for i in ids]), strict=True) if cut == i.to_bytes(4, "little")}
        self.child: dict[int, int] = {}
        self.token: dict[int, int] = {}
        self.open: set[int] = set()
        nodes = 1
        for i in sorted(whole):
            node = 0
            for b in self.spelled[i]:
                self.open.add(node)
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = nodes
                    nodes += 1
                node = self.child[key]
            self.token[node] = i
        self.follows: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        start = ((0, _START, 0),)
        self.states, self.number = [start], {start: 0}
        self.step: dict[int, tuple[int, int]] = {}

    def may_follow(self, a: int, b: int) -> bool:
        key = (a, b)
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) > MOST_TRANSITIONS:
                self.follows.clear()
            word = self.spelled[a] + self.spelled[b]
            known = self.follows[key] = _cuts(self.tokenizer, word) == [a, b]
        return known

    def compile(self, key: int) -> tuple[int, int]:
        """The transition for state << 8 | byte: next state, change of the count."""
        at, b = self.states[key >> 8], key & 255
        grown, last, emitted = [], None, 0
        for node, before, count in at:
            node = self.child.get(node << 8 | b, -1)
            if node < 0:
                continue
            token = self.token.get(node)
            if last is None and token is not None and (before == _START or self.may_follow(before, token)):
                last, emitted = token, count + 1
            if node in self.open:
                grown.append((node, before, count))
        state = tuple((node, before, count - emitted) for node, before, count in grown) + ((0, last, 0),)
        self.step[key] = (self.enter(state), emitted)
        return self.step[key]

    def enter(self, state: tuple) -> int:
        """The number of a state, which may come from another process."""
        at = self.number.setdefault(state, len(self.states))
        if at == len(self.states):
            self.states.append(state)
        return at

    def feed(self, at: int, char: str) -> tuple[int, int]:
        """The state after one more character, and the change of the count."""
        total = 0
        for b in char.encode():
            got = self.step.get(at << 8 | b)
            if got is None:
                if len(self.step) > MOST_TRANSITIONS:
                    state = self.states[at]
                    self.reset()
                    at = self.enter(state)
                got = self.compile(at << 8 | b)
            at, emitted = got
            total += emitted
        return at, total

    def count(self, word: bytes) -> int:
        if len(self.step) > MOST_TRANSITIONS:
            self.reset()
        state, total, step = 0, 0, self.step
        for b in word:
            key = state << 8 | b
            state, emitted = step.get(key) or self.compile(key)
            total += emitted
        return total


def _cuts(tokenizer: Tokenizer, word: bytes) -> list[int]:
    """BPE of a short byte string by rank, as ids."""
    ids, rank_of, base = [int(tokenizer.inner[b]) for b in word], tokenizer.rank_of, tokenizer.base
    while len(ids) > 1:
        rank, i = min((rank_of.get(a * base + b, len(rank_of)), i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)))
        if rank == len(rank_of):
            break
        ids[i : i + 2] = [int(tokenizer.made[rank])]
    return ids


class State(NamedTuple):
    """Where the tokenizer stands between two characters of a text.

    ``mode`` is the kind of the word being read (L letters, N numbers, S white
    space, O others), an apostrophe with the letter after it while these may
    still become a contraction, or empty where a word begins. ``held`` is the
    transducer's state in this word. The last character of white space belongs
    to what follows: ``delta`` tokens are taken back for ``last`` if a word does.
    """

    mode: str = ""
    held: tuple = ((0, _START, 0),)
    delta: int = 0
    last: str = ""

    def key(self) -> str:
        return json.dumps(self)


BEGIN = State()


class Kinds(dict):
    """Kind of each character, as the tokenizers library tells it; looked up once a process."""

    def __init__(self, path: str) -> None:
        self.cut = tokenizers.Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def __missing__(self, char: str) -> str:
        alike = [kind for kind, lead in (("L", "a"), ("N", "1"), ("O", "!")) if len(self.cut(lead + char)) == 1]
        self[char] = alike[0] if alike else "S"
        return self[char]


class Counter:
    """Token counts of whole texts, and state maps of their chunks."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer(path)
        if self.tokenizer.steps or self.tokenizer.find.__self__.pattern != BYTE_LEVEL:
            raise ValueError("only byte-level tokenizers without a normalizer and a pattern of their own are compiled")
        self.transducer = Transducer(self.tokenizer)
        self.kinds = Kinds(path)
        self.memo: dict[str, int] = {}

    def words(self, text: str) -> int:
        memo, pieces, total = self.memo, self.tokenizer.pieces(text), 0
        try:
            return sum(map(memo.__getitem__, pieces))
        except KeyError:
            for w in pieces:
                n = memo.get(w)
                if n is None:
                    if len(memo) > MEMO_WORDS:
                        memo.clear()
                    n = memo[w] = self.transducer.count(w.encode())
                total += n
            return total

    def parts(self, text: str) -> list[str]:
        """Plain texts (even places) and the special strings between them."""
        if not any(s in text for s in self.tokenizer.special):
            return [text]
        return self.tokenizer.split.split(text)

    def count(self, text: str) -> int:
        parts = self.parts(text)
        return sum(map(self.words, parts[::2])) + len(parts) // 2

    def run(self, state: State, text: str) -> tuple[State, int]:
        """Reads a text without special strings from a state: the state after it, the change of the count."""
        feed, kinds, total = self.transducer.feed, self.kinds, 0
        mode, _, delta, last = state
        at = self.transducer.enter(state.held)
        for c in text:
            kind = kinds[c]
            if mode == "S":
                if kind == "S":
                    at, delta = feed(at, c)
                    total += delta
                    last = c
                    continue
                total -= delta
                at, n = feed(0, last)
                total += n
                if last == " ":  # one space joins the word after it
                    at, n = feed(at, c)
                    total += n
                    mode = kind
                    continue
            elif mode == kind:
                at, n = feed(at, c)
                total += n
                continue
            elif mode == "'":
                if c in "stmd":
                    total += feed(at, c)[1]
                    mode, at = "", 0
                    continue
                if c in "rvl":
                    mode += c
                    continue
                if kind == "O":
                    at, n = feed(at, c)
                    total += n
                    mode = "O"
                    continue
            elif mode[:1] == "'":
                first = mode[1]
                if c == ("l" if first == "l" else "e"):
                    at, n = feed(at, first)
                    total += n + feed(at, c)[1]
                    mode, at = "", 0
                    continue
                at, n = feed(0, first)
                total += n
                mode = "L"
                if kind == "L":
                    at, n = feed(at, c)
                    total += n
                    continue
            at, n = feed(0, c)  # a word begins
            total += n
            mode = "'" if c == "'" else kind
            delta, last = n, c
        if mode == "S":
            return State(mode, self.transducer.states[at], delta, last), total
        return (State(mode, self.transducer.states[at]) if mode else BEGIN), total

    def finish(self, state: State) -> int:
        """Tokens still to come where the text, or its part before a special string, ends."""
        return self.transducer.count(state.mode[1:].encode()) if state.mode[:1] == "'" else 0

    def step(self, state: State, text: str) -> tuple[State, int]:
        """As ``run``; between its first and last break a text is counted by words."""
        first = _FIRST_BREAK.search(text)
        if first is None:
            return self.run(state, text)
        a = first.start()
        b = len(text) - _LAST_BREAK.search(text[::-1]).end()
        state, total = self.run(state, text[:a])
        total += self.finish(state) + self.words(text[a:b])
        state, n = self.run(BEGIN, text[b:])
        return state, total + n

    def apply(self, state: State, text: str, ends: bool) -> tuple[State, int]:
        """The state map of a chunk (``ends``: the last of its text) at one state."""
        total = 0
        for i, part in enumerate(self.parts(text)):
            if i % 2:
                total += self.finish(state) + 1
                state = BEGIN
            else:
                state, n = self.step(state, part)
                total += n
        return (BEGIN, total + self.finish(state)) if ends else (state, total)

    def chunks(self, text: str, size: int, look_back: int) -> Iterator[tuple[str, str, bool]]:
        """A text in chunks, none of which ends inside a special string: what stands before
        (from the last break, if it is near), the chunk, and whether it is the last."""
        spans = [(0, 0)]
        if any(s in text for s in self.tokenizer.special):
            spans += [m.span() for m in self.tokenizer.split.finditer(text)]
        start, before, near = 0, "", 0
        while True:
            end = min(start + size, len(text))
            while near + 1 < len(spans) and spans[near + 1][0] < end:
                near += 1
            end = max(end, spans[near][1])
            yield before, text[start:end], end == len(text)
            if end == len(text):
                return
            window = text[max(spans[near][1], end - look_back) : end]
            cut = _LAST_BREAK.search(window[::-1])
            before = window[len(window) - cut.start() - 1 :] if cut else window
            start = end


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The compiled counter of a tokenizer file, one a process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS, look_back: int = LOOK_BACK
) -> DataFrame:
    """Per document: n_bytes, n_tokens, over_limit.

    One scan counts the texts of up to ``chunk_chars`` characters where they
    are read and cuts longer ones into chunk rows, which are written with the
    counts under the shared folder and dealt over all tasks. A chunk's map
    leads from an entry state to an exit state and a count. The entry state
    is read off the characters before the chunk, exactly if a break is among
    them; else it is a guess that the composition checks. Maps compose over
    neighbours, ``FAN`` at a time, level by level, so no task holds a text; a
    text where a guess was wrong is read once more, in order and as a stream.

    The tokenizer file must be at ``path`` on every executor. Null and empty
    texts have 0 bytes and tokens; a special string inside a text counts one
    token; repeated documents get a row each; an empty table gives no rows;
    other columns are ignored.
    """
    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    cut = staged(rows.mapInArrow(_count_or_cut(path, chunk_chars, look_back), f"doc_id {kind}, n_bytes long, n_tokens long, text_key string, k int, before string, chunk string, ends boolean"), "chunks")
    short = cut.where("text_key IS NULL").select("doc_id", "n_bytes", "n_tokens")
    pieces = cut.where("text_key IS NOT NULL").drop("n_tokens")
    maps = pieces.repartition("text_key", "doc_id", "k").mapInArrow(_state_maps(path), f"doc_id {kind}, text_key string, n_bytes long, k int, entry string, exit string, n long")
    maps = maps.groupBy(*maps.columns).agg(F.count("*").alias("copies")).withColumn("ok", F.lit(True))
    reach = chunk_chars
    while reach < MOST_CHARS:
        maps, reach = compose(maps), reach * FAN
    texts = staged(maps.select("doc_id", "text_key", "n_bytes", F.col("n").alias("n_tokens"), "copies", "ok"), "texts")
    long = texts.where("ok").select("doc_id", "n_bytes", "n_tokens", "copies")
    wrong = texts.where("NOT ok").select("text_key").distinct()
    if not wrong.isEmpty():
        again = pieces.join(wrong, "text_key", "left_semi").repartition("text_key", "doc_id").sortWithinPartitions("text_key", "doc_id", "k")
        long = long.unionByName(again.select("text_key", "doc_id", "n_bytes", "k", "chunk", "ends").mapInArrow(_in_order(path), f"doc_id {kind}, n_bytes long, n_tokens long, copies long"))
    long = long.withColumn("piece", F.explode(F.expr(f"sequence(0L, (copies - 1) div {PIECE})")))
    long = long.withColumn("copy", F.explode(F.expr(f"sequence(1L, least({PIECE}L, copies - piece * {PIECE}))")))
    return short.unionByName(long.select(*short.columns)).withColumn("over_limit", F.col("n_tokens") > limit)


def compose(maps: DataFrame) -> DataFrame:
    """State maps of up to ``FAN`` neighbouring chunks of a text as one (associative).

    ``ok`` tells whether each map was entered in the state that the one before it left.
    """
    key = ["doc_id", "text_key", "n_bytes", "copies"]
    run = F.array_sort(F.collect_list(F.struct("k", "entry", "exit", "n", "ok"))).alias("m")
    grown = maps.groupBy(*key, F.expr(f"k div {FAN}").cast("int").alias("k")).agg(run).selectExpr(*key, "k", "m", """
        aggregate(m, named_struct('exit', m[0].entry, 'n', 0L, 'ok', true),
                  (a, x) -> named_struct('exit', x.exit, 'n', a.n + x.n, 'ok', a.ok AND x.ok AND x.entry = a.exit)) AS r""")
    return grown.selectExpr(*key, "k", "m[0].entry AS entry", "r.exit AS exit", "r.n AS n", "r.ok AS ok")


def _count_or_cut(path: str, chunk_chars: int, look_back: int):
    names = ["doc_id", "n_bytes", "n_tokens", "text_key", "k", "before", "chunk", "ends"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_()]

    def made(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        at, *cols = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), *map(pa.array, cols, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            rows, held = [], 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                text = text or ""
                raw = text.encode()
                if len(text) <= chunk_chars:
                    rows.append((i, len(raw), c.count(text), None, None, None, None, None))
                    continue
                key = hashlib.sha256(raw).hexdigest()
                for k, (before, chunk, ends) in enumerate(c.chunks(text, chunk_chars, look_back)):
                    rows.append((i, len(raw), None, key, k, before, chunk, ends))
                    held += len(chunk)
                    if held > BATCH_CHARS:
                        yield made(batch.column(0), rows)
                        rows, held = [], 0
            if rows:
                yield made(batch.column(0), rows)

    return run


def _state_maps(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            entries, exits, counts = [], [], []
            for before, chunk, ends in zip(*(batch.column(name).to_pylist() for name in ("before", "chunk", "ends")), strict=True):
                entry = c.run(BEGIN, before)[0]
                left, n = c.apply(entry, chunk, ends)
                entries.append(entry.key())
                exits.append(left.key())
                counts.append(n)
            kept = ["doc_id", "text_key", "n_bytes", "k"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(entries, pa.string()), pa.array(exits, pa.string()), pa.array(counts, pa.int64())], [*kept, "entry", "exit", "n"])

    return run


def _in_order(path: str):
    """Chunks of texts in order, equal rows side by side: counts from the states that really occur,
    one row for each row of a text's last chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        text, state, total, done = None, BEGIN, 0, -1
        for batch in batches:
            found = []
            for i, (key, doc, k, chunk, ends) in enumerate(zip(*(batch.column(name).to_pylist() for name in ("text_key", "doc_id", "k", "chunk", "ends")), strict=True)):
                if (key, doc) != text:
                    text, state, total, done = (key, doc), BEGIN, 0, -1
                if k != done:
                    state, n = c.apply(state, chunk, ends)
                    total, done = total + n, k
                if ends:
                    found.append((i, total))
            at, n = zip(*found, strict=True) if found else ((), ())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("n_bytes").take(at), pa.array(n, pa.int64()), pa.array([1] * len(n), pa.int64())], ["doc_id", "n_bytes", "n_tokens", "copies"])

    return run
