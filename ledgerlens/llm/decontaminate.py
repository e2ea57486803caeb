"""Benchmark decontamination with a generalised suffix automaton (operator 4).

The normalised test items form one automaton (in blocks of bounded size).
Every document's words stream through it once; the longest match that ends at
each word is tracked, and matches that reach the length limit become spans.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections.abc import Callable, Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._tables import materialize, pick, text_or_empty

#: Text bytes of test items in one automaton: what one broadcast and one worker hold
#: (measured: 16 MB are 1.8 million states, 364 MB of a worker and 18 s to build).
BLOCK_BYTES = 16 << 20
#: Bytes of a word: digits, a-z and all of every non-ASCII character; A-Z are lower-cased.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

SPANS = "array<struct<start:int,end:int>>"


def words(raw: bytes) -> list[bytes]:
    """The normalised words of a UTF-8 text."""
    return raw.translate(_FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton over the word sequences of test items.

    A match is a run of words that is a window of an item: ``ngram``
    consecutive words, or the whole item if it is shorter.

    States are numbers into flat arrays.  Nearly all have one move, which lies
    in ``move_word`` and ``move_to``; the further moves of a state are in
    ``moves``.  Word 0 and state 0 (the root, which no move leads to) stand for none.
    """

    def __init__(self, items: list[tuple[str, bytes]], ngram: int) -> None:
        self.ngram = ngram
        self.move_word, self.move_to = array("i", [0]), array("i", [0])
        self.moves: dict[int, dict[int, int]] = {}
        self.link, self.length = array("i", [-1]), array("i", [0])
        self.vocabulary: dict[bytes, int] = {}
        sequences = []
        for item_id, raw in items:
            ids = array("i", (self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(raw)))
            if ids:
                sequences.append((item_id, ids))
                self._add(ids)
        self.shortest = min([ngram, *(len(s) for _, s in sequences)])
        self._anchor()
        #: (window state, item number) of all windows as sorted pairs; (length, item) of short items by state
        self.names: list[str] = []
        self.short_at: dict[int, list[tuple[int, str]]] = {}
        pairs, numbers = array("q"), {}
        for item_id, ids in sequences:
            number = numbers.setdefault(item_id, len(numbers))
            state = 0
            for j, c in enumerate(ids):
                state, _ = self._step(state, j, c)
                if j + 1 >= ngram:
                    pairs.append(self.window_state[state] << 32 | number)
            if len(ids) < ngram:
                self.short_at.setdefault(state, []).append((len(ids), item_id))
        self.names = list(numbers)
        self.pairs = np.unique(np.frombuffer(pairs, np.int64)) if pairs else np.zeros(0, np.int64)

    def _move(self, p: int, c: int) -> int:
        """The state that word ``c`` leads to from ``p``, or 0."""
        if self.move_word[p] == c:
            return self.move_to[p]
        more = self.moves.get(p)
        return more.get(c, 0) if more else 0

    def _set(self, p: int, c: int, to: int) -> None:
        if self.move_word[p] in (0, c):
            self.move_word[p], self.move_to[p] = c, to
        else:
            self.moves.setdefault(p, {})[c] = to

    def _new(self, length: int, link: int, like: int = -1) -> int:
        """A further state, with the moves of ``like``."""
        state = len(self.link)
        self.length.append(length)
        self.link.append(link)
        self.move_word.append(self.move_word[like] if like >= 0 else 0)
        self.move_to.append(self.move_to[like] if like >= 0 else 0)
        if like in self.moves:
            self.moves[state] = dict(self.moves[like])
        return state

    def _split(self, p: int, c: int, q: int) -> int:
        """The state of length(p) + 1 reached from p by c, split off q if need be."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._new(self.length[p] + 1, self.link[q], like=q)
        self.link[q] = clone
        while p >= 0 and self._move(p, c) == q:
            self._set(p, c, clone)
            p = self.link[p]
        return clone

    def _add(self, ids: array) -> None:
        last = 0
        for c in ids:
            known = self._move(last, c)
            if known:  # another item has been here
                last = self._split(last, c, known)
                continue
            state, p = self._new(self.length[last] + 1, 0), last
            while p >= 0 and not self._move(p, c):
                self._set(p, c, state)
                p = self.link[p]
            if p >= 0:
                self.link[state] = self._split(p, c, self._move(p, c))
            last = state

    def _anchor(self) -> None:
        """window_state: for a state that matches ``ngram`` words or more, that of its last ``ngram``."""
        length, up = np.array(self.length), np.array(self.link)
        state = np.arange(len(up), dtype=np.int32)
        state[1:] = np.where(length[up[1:]] >= self.ngram, up[1:], state[1:])
        while True:  # links of links, until all end
            after = state[state]
            if np.array_equal(after, state):
                break
            state = after
        self.window_state = array("i", np.where(length >= self.ngram, state, 0).astype(np.int32).tobytes())

    def _step(self, state: int, n: int, c: int) -> tuple[int, int]:
        word, moves = self.move_word, self.moves
        while True:
            if word[state] == c:
                return self.move_to[state], n + 1
            if state in moves and c in moves[state]:
                return moves[state][c], n + 1
            if not state:
                return 0, 0
            state = self.link[state]
            n = self.length[state]

    def _items(self, state: int) -> list[str]:
        """Ids of the items with the window of a window state."""
        begin, end = np.searchsorted(self.pairs, [state << 32, (state + 1) << 32])
        return [self.names[i] for i in (self.pairs[begin:end] & 0xFFFFFFFF).tolist()]

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged spans [start, end) of hit words, and ids of the items met.

        Words no item has reset the automaton, so only runs of known words
        that could hold the shortest window are streamed.
        """
        found = words(raw)
        total = len(found)
        if total < self.shortest or not self.vocabulary:
            return total, [], set()
        ids = np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.int32, total)
        edge = np.diff((ids > 0).view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - starts >= self.shortest
        spans: list[list[int]] = []
        states: set[int] = set()
        items: set[str] = set()

        def hit(a: int, b: int) -> None:
            while spans and a <= spans[-1][1]:
                a = min(a, spans.pop()[0])
            spans.append([a, b])

        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            state = n = 0
            for j, c in enumerate(ids[a:b].tolist(), a + 1):
                state, n = self._step(state, n, c)
                if n >= self.ngram:
                    states.add(self.window_state[state])
                    hit(j - n, j)
                if self.short_at:
                    v = state
                    while v > 0:
                        for size, item in self.short_at.get(v, ()):
                            if size <= n:
                                items.add(item)
                                if not (spans and spans[-1][1] == j and spans[-1][0] <= j - size):
                                    hit(j - size, j)
                        v = self.link[v]
        for v in states:
            items.update(self._items(v))
        return total, [(x, y) for x, y in spans], items


_built: dict[str, SuffixAutomaton] = {}


def _automaton(number: str, shared, ngram: int) -> SuffixAutomaton:
    """The automaton of a block, built once per Python worker and block."""
    if number not in _built:
        _built.clear()
        _built[number] = SuffixAutomaton(shared.value, ngram)
    return _built[number]


def _scan(docs: DataFrame, shared, ngram: int, hits_only: bool) -> DataFrame:
    """doc_id, n_words, spans and items of ``docs`` (doc_id, text, further columns, which are handed on)."""
    number, more = uuid.uuid4().hex, docs.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _automaton(number, shared, ngram).scan
        for batch in batches:
            rows, counts, spans, items = [], [], [], []
            for i, raw in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                n, s, x = scan(raw or b"")
                if s or not hits_only:
                    rows.append(i)
                    counts.append(n)
                    spans.append([{"start": a, "end": b} for a, b in s])
                    items.append(sorted(x))
            take = lambda c: batch.column(c).take(pa.array(rows, pa.int32()))
            yield pa.RecordBatch.from_arrays([
                take("doc_id"), pa.array(counts, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(items, pa.list_(pa.string())), *map(take, more)], ["doc_id", "n_words", "spans", "items", *more])

    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in more)
    return docs.mapInArrow(run, f"doc_id long, n_words long, spans {SPANS}, items array<string>{kinds}")


def find_overlaps(docs: DataFrame, items: DataFrame, ngram: int = 10,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, the merged spans of hit words, ids of the items met.

    ``items`` (item_id, text) may have any size: it is dealt by hash into
    blocks of about ``block_bytes`` of text, and each block is one automaton,
    broadcast on its own.  With one block the documents are scanned without
    any shuffle.  With more, each block's hits are written and merged by the
    text's hash.

    Null texts have no words; items without words match nothing; a null
    item_id counts as the empty string; equal items under several ids all
    count; rows that repeat a doc_id are scanned each.  Empty tables give
    empty results or no hits.
    """
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_or_empty(F.col("text")).alias("text"))
    blocks = _blocks(items, block_bytes)
    if len(blocks) == 1:
        return _scan(d, blocks[0](), ngram, hits_only=False)
    merged = _found(d, blocks, ngram)
    counted = _scan(d.withColumn("key", F.xxhash64("text")), d.sparkSession.sparkContext.broadcast([]), ngram, hits_only=False)
    return counted.join(merged, F.expr("key = _key"), "left").select(
        "doc_id", "n_words", F.coalesce(merged["spans"], F.array().cast(SPANS)).alias("spans"),
        F.coalesce(merged["items"], F.array().cast("array<string>")).alias("items"))


def _blocks(items: DataFrame, block_bytes: int) -> list[Callable]:
    """For every block of ``items`` a function that broadcasts its (item_id, text) rows."""
    spark = items.sparkSession
    bench = pick(items, "item_id", "text").select(
        text_or_empty(F.col("item_id").cast("string")).alias("item_id"), text_or_empty(F.col("text")).alias("text"))
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))

    def shared(block: int):
        rows = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        return spark.sparkContext.broadcast(sorted((r["item_id"], r["text"].encode()) for r in rows))

    return [partial(shared, block) for block in range(n)]


def _found(docs: DataFrame, blocks: list[Callable], ngram: int) -> DataFrame:
    """(_key, spans, items) of the texts that any block hits; _key is the text's hash, so equal texts share a row."""
    d = docs.filter("text IS NOT NULL").select(F.lit(None).cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key"))
    found = None
    for block in blocks:
        part = materialize(_scan(d, block(), ngram, hits_only=True), "overlaps")
        found = part if found is None else found.union(part)
    return materialize(_merge(found), "overlaps").withColumnRenamed("key", "_key")


def _merge(found: DataFrame) -> DataFrame:
    """One row per key: its blocks' spans merged, its items without repeats."""
    found = found.dropDuplicates(["key", "spans", "items"])  # copies of a text
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    merged = F.aggregate("s", F.array().cast(SPANS), lambda a, x: F.when(
        (F.size(a) > 0) & (F.element_at(a, -1)["end"] >= x["start"]),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
            F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], x["end"]).alias("end")))),
    ).otherwise(F.concat(a, F.array(x))))
    return (found.groupBy("key").agg(spans.alias("s"), F.array_sort(F.array_distinct(
        F.flatten(F.collect_list("items")))).alias("items")).select("key", merged.alias("spans"), "items"))


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without its hit words and what stands between them."""
    at = [m.span() for m in _WORD.finditer(raw)]
    out, begin = [], 0
    for s in spans:
        a, b = s[0], min(s[1], len(at))
        if a < b:
            out.append(raw[begin:at[a][0]])
            begin = at[b - 1][1]
    return b"".join(out) + raw[begin:]


def decontaminate(docs: DataFrame, items: DataFrame, ngram: int = 10, max_coverage: float = 0.5,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without test passages; columns unchanged.

    Spans of matched windows (``ngram`` words or more) are cut from the text,
    and n_chars is set anew.  A document of whose words more than
    ``max_coverage`` are hit is dropped.  All others keep their text as it is.
    Every row is judged and cut by its own text, whatever other rows share
    its id, and with a null id too.  With one block of items a row is scanned
    and cut in one go, without a shuffle.
    """
    own = [f"_c{i}" for i in range(len(docs.columns))]
    flat = docs.toDF(*own)
    text = own[docs.columns.index("text")]
    n_chars = own[docs.columns.index("n_chars")] if "n_chars" in docs.columns else None
    blocks = _blocks(items, block_bytes)
    spans = "_spans"
    if len(blocks) == 1:
        shared, number = blocks[0](), uuid.uuid4().hex
    else:
        found = _found(flat.select(F.col(text).alias("text")), blocks, ngram)
        flat = flat.join(found.select("_key", "spans"), F.xxhash64(text) == F.col("_key"), "left").select(*own, F.col("spans").alias(spans))
        shared = number = None
    plain = docs.toDF(*own).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            if number is not None:
                scan = _automaton(number, shared, ngram).scan
                rows = [scan(t)[1] if t is not None else None for t in texts]
            else:
                rows = [[(s["start"], s["end"]) for s in r or ()] for r in batch.column(spans).to_pylist()]
            new, keep, lengths = [], [], batch.column(n_chars).to_pylist() if n_chars else None
            for i, (t, s) in enumerate(zip(texts, rows)):
                hit = sum(b - a for a, b in s or ())
                keep.append(not hit or hit <= max_coverage * len(words(t)))
                new.append(_cut(t, s) if hit and keep[-1] else t)
                if lengths and hit:
                    lengths[i] = len(new[-1].decode())
            columns = {c: batch.column(c) for c in own}
            columns[text] = pa.array(new, pa.binary()).cast(columns[text].type)
            if n_chars:
                columns[n_chars] = pa.array(lengths, columns[n_chars].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns)).filter(pa.array(keep, pa.bool_()))

    return flat.mapInArrow(run, plain).toDF(*docs.columns)
