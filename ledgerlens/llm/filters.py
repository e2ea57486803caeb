"""Interaction of filters, from a sparse document-term matrix (operator 13).

Words are dictionary-encoded over the whole corpus and the documents built as
CSR shards: row sums are the words of a document, nonzero counts its distinct
words.  With these, the other flags and the labels, every document is a mask
of the filters it fails; masks are counted per part, and every order of the
filters is told from the counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._tables import materialize, pick

#: One letter per filter; filter i is bit i of a mask.
FILTERS = "ABCDE"
# The failure conditions.
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 50, 65, 5, b"#$%&*|"
#: Bytes of text in a shard (a longer document is a shard of its own).
SHARD_BYTES = 8 << 20
#: Bytes of words, counted once per shard, that are numbered together (words are dealt out by hash).
BUCKET_BYTES = 4 << 20

_FACTS = "doc_id array<long>, part array<string>, marks array<int>, digest array<binary>"
_LOCAL = f"shard long, {_FACTS}, indptr array<long>, columns binary, counts binary, words binary, size long"
_MATRIX = f"shard long, {_FACTS}, indptr array<long>, columns array<long>, counts array<int>"
_ROWS = "doc_id long, part string, marks int, digest binary, n_words long, n_distinct long"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _list(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _joined(words: pa.ListArray) -> pa.Array:
    """A row's words as one value: no word has a space."""
    return pc.binary_join(words, b" ")


def _split(joined: pa.Array) -> pa.ListArray:
    return pc.split_pattern(joined, pattern=b" ")


def _hashes(joined: pa.Scalar) -> np.ndarray:
    """32 bits of each of some joined words, to deal them out by (they are told apart by their bytes)."""
    return np.fromiter(map(crc32, joined.as_py().split(b" ")), np.int64)


def _marks(text: bytes) -> int:
    """Bits of the filters on characters: C (upper-case share) and D (symbols)."""
    raw = np.frombuffer(text, np.uint8)
    points = int(np.count_nonzero((raw & 0xC0) != 0x80))
    upper = int(np.count_nonzero(raw - np.uint8(65) < 26))
    return (4 if 100 * upper > UPPER_PERCENT * points else 0) | (8 if any(x in text for x in SYMBOLS) else 0)


class _Shard:
    """Documents gathered for one shard, and their CSR rows over a dictionary of its own words."""

    def __init__(self) -> None:
        self.size, self.facts, self.texts = 0, [], []

    def add(self, doc_id: int | None, part: str, text: bytes) -> None:
        self.facts.append((doc_id, part, _marks(text), hashlib.blake2b(text, digest_size=16).digest()))
        self.size += len(text) + 64

    def batch(self, shard: int) -> pa.RecordBatch:
        split = pc.ascii_split_whitespace(pa.concat_arrays(self.texts)).cast(pa.list_(pa.binary()))
        doc = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
        coded = split.flatten().dictionary_encode()
        known = coded.dictionary
        order = np.argsort(_hashes(_joined(_list(known, pa.binary()))[0]), kind="stable")
        order = order[pc.binary_length(known).to_numpy()[order] > 0]  # beside leading and trailing space are empty ones
        place = np.full(len(known), -1, np.int64)
        place[order] = np.arange(len(order))
        place = place[coded.indices.to_numpy()]
        if len(order) < len(known):
            doc, place = doc[place >= 0], place[place >= 0]
        cells = np.sort(doc << 32 | place)
        first = np.flatnonzero(np.diff(cells, prepend=-1))
        counts, cells = np.diff(first, append=len(cells)).astype(np.int32), cells[first]
        ends = np.append(0, np.cumsum(np.bincount(cells >> 32, minlength=len(split))))
        words = known.take(pa.array(order))
        lists = [*map(list, zip(*self.facts))]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary()]
        arrays = [pa.array([shard], pa.int64()), *[pa.array([x], pa.list_(k)) for x, k in zip(lists, kinds)], _list(ends, pa.int64()),
                  *[pa.array([x.tobytes()], pa.binary()) for x in ((cells & 0xFFFFFFFF).astype(np.int32), counts)],
                  _joined(_list(words, pa.binary())), pa.array([pc.sum(pc.binary_length(words)).as_py() or 0], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, _names(_LOCAL))


def local_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """CSR shards of ``docs`` (doc_id, part, text; no nulls in the last two), columns numbered within each shard.

    ``columns`` and ``counts`` are int32 in one value each; ``words``, the
    shard's distinct words in the order of their hashes, are one value with a
    space between, of ``size`` bytes without the spaces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            texts, begin = batch.column(2), 0
            raw = texts.cast(pa.binary())
            for i in range(batch.num_rows):
                text = raw[i].as_py()
                if shard.size and shard.size + len(text) > shard_bytes:
                    shard.texts.append(texts.slice(begin, i - begin))
                    yield shard.batch(at)
                    at, shard, begin = at + 1, _Shard(), i
                shard.add(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), text)
            shard.texts.append(texts.slice(begin))
        if shard.size:
            yield shard.batch(at)

    return docs.mapInArrow(run, _LOCAL)


def word_pieces(local: DataFrame, buckets: int) -> DataFrame:
    """The words of each shard, a row for each bucket of hashes that it meets (a row for each word, where buckets are many)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = _split(batch.column(1).slice(i, 1)).flatten()
                bucket = _hashes(batch.column(1)[i]) * buckets >> 32
                starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                pieces = pa.ListArray.from_arrays(pa.array(np.append(starts, len(words)), pa.int32()), words)
                yield pa.RecordBatch.from_arrays([pa.array(bucket[starts], pa.int32()), batch.column(0).take(pa.array(np.full(len(starts), i))),
                                                  _joined(pieces)], _names(schema))

    schema = "bucket int, shard long, words binary"
    return local.filter("size > 0").select("shard", "words").mapInArrow(run, schema)


def _numbered(pieces: DataFrame) -> DataFrame:
    """Numbers of the words of ``pieces`` within their bucket, equal words having one number.

    Buckets are dealt out and pass one after the other, so a task holds the
    distinct words of one bucket.  A row holds the numbers of a shard's words
    in a bucket, in their order (int32 in one value), or, with a null shard,
    new words of a bucket and the number of the first of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.array([], pa.binary())
        bucket, known, held, size = None, none, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal known
            shard, lists = pa.concat_arrays([x for x, _ in held]), pa.concat_arrays([x for _, x in held])
            n, rows = len(known), len(lists)
            coded = pa.concat_arrays([known, lists.flatten()]).dictionary_encode()
            known, codes = coded.dictionary, coded.indices.to_numpy()[n:].astype(np.int32)
            ends = 4 * np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy())).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends), pa.py_buffer(codes)])
            own = pa.array(np.full(rows, bucket), pa.int32())
            yield pa.RecordBatch.from_arrays([shard, own, packed, pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary())], _names(schema))
            if len(known) > n:
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), own[:1], pa.nulls(1, pa.binary()), pa.array([n], pa.int64()),
                                                  _joined(_list(known.slice(n), pa.binary()))], _names(schema))

        for batch in batches:
            buckets = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.diff(buckets, prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(buckets)]):
                if held and (buckets[a] != bucket or size >= max(BUCKET_BYTES, known.nbytes)):
                    yield from flush()
                    held, size = [], 0
                if buckets[a] != bucket:
                    bucket, known = buckets[a], none
                rows = batch.slice(a, b - a)
                held.append((rows.column(1), _split(rows.column(2))))
                size += rows.column(2).nbytes
        if held:
            yield from flush()

    schema = "shard long, bucket int, terms binary, first long, words binary"
    return pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _dictionary(numbered: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = _split(batch.column(2).slice(i, 1)).flatten()
                n = _term(batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                yield pa.RecordBatch.from_arrays([words, pa.array(np.arange(n, n + len(words)))], ["word", "term"])

    return numbered.filter("shard IS NULL").select("bucket", "first", "words").mapInArrow(run, "word binary, term long")


def _term(bucket, number):
    """The number over the corpus of a bucket's word (numbers or arrays of them)."""
    return (bucket << 32) + number


def document_term_matrix(docs: DataFrame, shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """(matrix, dictionary) of ``docs`` (doc_id, part, text).

    dictionary: word (binary), term (its number, unique over the corpus).
    matrix: a row per shard with the facts of its documents and their CSR rows,
    ``columns`` being terms.  A word is numbered once per shard, not once per
    document, and the words of a shard travel together by bucket of hashes.
    """
    local = materialize(local_shards(docs, shard_bytes), "shards", "zstd")
    buckets = -(-(local.agg(F.sum("size")).first()[0] or 1) // bucket_bytes)
    # numbered while written: what is read back is one numbering, whatever was retried
    numbered = materialize(_numbered(word_pieces(local, buckets)), "numbers", "zstd")
    packs = numbered.filter("shard IS NOT NULL").groupBy(F.col("shard").alias("_shard")).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "terms"))).alias("pieces"))
    both = local.drop("words", "size").join(packs, F.expr("shard = _shard"), "left").drop("_shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                pieces = row.column("pieces").flatten()
                terms = [_term(np.int64(b), np.frombuffer(x.as_buffer(), np.int32))
                         for b, x in zip(pieces.field("bucket").to_pylist(), pieces.field("terms"))]
                terms = np.concatenate([np.empty(0, np.int64), *terms])
                columns, counts = (np.frombuffer(row.column(c)[0].as_buffer(), np.int32) for c in ("columns", "counts"))
                arrays = {n: row.column(n) for n in row.schema.names}
                arrays["columns"], arrays["counts"] = _list(terms[columns], pa.int64()), _list(counts, pa.int32())
                yield pa.RecordBatch.from_arrays([arrays[n] for n in _names(_MATRIX)], _names(_MATRIX))

    return both.mapInArrow(run, _MATRIX), _dictionary(numbered)


def row_measures(matrix: DataFrame) -> DataFrame:
    """Per document its facts, row sum (n_words) and nonzero count (n_distinct)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ends = row.column("indptr").flatten().to_numpy()
                total = np.concatenate([[0], np.cumsum(row.column("counts").flatten().to_numpy(), dtype=np.int64)])
                facts = [row.column(c).flatten() for c in ("doc_id", "part", "marks", "digest")]
                yield pa.RecordBatch.from_arrays([*facts, pa.array(np.diff(total[ends])), pa.array(np.diff(ends))],
                                                 _names(_ROWS))

    return matrix.select("doc_id", "part", "marks", "digest", "indptr", "counts").mapInArrow(run, _ROWS)


def failure_masks(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, part, n_words, n_distinct, mask, good, toxic.

    Bits of mask: 1 under 50 words, 2 distinct words under 65 %, 4 more than
    5 % ``[A-Z]``, 8 a symbol of ``#$%&*|``, 16 text identical (128-bit
    digest) to that of a smaller doc_id.  Null text is empty, null source the
    empty part.  A null doc_id is no smaller than any and has no smaller one;
    rows that repeat an id are rows of their own.  An id labelled more than
    once is good or toxic if any of its labels says so; unlabelled ones are
    neither.  Empty tables give an empty result.
    """
    d = pick(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = materialize(row_measures(document_term_matrix(d, shard_bytes)[0]), "measures")
    copies = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).filter("n > 1")
    named = pick(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = rows.join(copies.select(F.col("digest").alias("_digest"), "first"), F.expr("digest = _digest"), "left")
    rows = rows.join(named, F.expr("doc_id = _id"), "left")
    bit = lambda condition, value: F.when(condition, value).otherwise(0)
    mask = (bit(F.col("n_words") < MIN_WORDS, 1) + bit(100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words"), 2)
            + F.col("marks") + bit(F.col("first") < F.col("doc_id"), 16))
    return rows.select("doc_id", "part", "n_words", "n_distinct", mask.cast("int").alias("mask"),
                       F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def audit(masks: DataFrame) -> DataFrame:
    """Every order of the filters over ``masks`` (part, mask, good, toxic), per part and step.

    Rows are counted per part and mask first (32 masks, 4 kinds of label), so
    what the orders are spread over does not grow with the documents.
    """
    counts = masks.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    d = counts.select("*", F.explode(orders).alias("filter_order"))
    place = lambda letter: F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord(FILTERS[0]))
    letters = F.transform(F.sequence(F.lit(1), F.lit(len(FILTERS))),
                          lambda i: F.struct(i.alias("step"), place(F.substring(F.col("filter_order"), i, F.lit(1))).alias("bit")))
    d = d.select("*", letters.alias("s")).select("*", F.explode("s").alias("x"))
    before = F.aggregate(F.filter("s", lambda y: y["step"] < F.col("x.step")), F.lit(0), lambda a, y: a.bitwiseOR(y["bit"]))
    fails = F.col("mask").bitwiseAND(F.col("x.bit")) != 0
    early = F.col("mask").bitwiseAND(before) != 0
    d = d.select("part", "filter_order", F.col("x.step").alias("step"), "n", "good", "toxic", fails.alias("fails"),
                 early.alias("early"), (F.col("mask") == F.col("x.bit")).alias("only"), F.bit_count("mask").alias("k"))
    total = lambda where, value=F.col("n"): F.sum(F.when(where, value).otherwise(0)).cast("long")
    removed = F.col("fails") & ~F.col("early")
    # of all orders, a document that fails k filters is removed by each of them in one of k
    share = F.expr("n * (120 DIV k)")
    return d.groupBy("part", "filter_order", "step").agg(
        total(~F.col("fails") & ~F.col("early")).alias("kept"), total(removed).alias("removed"),
        total(F.col("fails") & F.col("early")).alias("redundant"), total(F.col("only")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"), total(removed & F.col("toxic")).alias("toxic_lost"),
        total(F.col("fails"), share).alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Interaction of the five filters on ``docs`` (doc_id, text, source) with ``labels`` (doc_id, quality, toxic).

    A row per part, order of the filters and step: kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.  Nulls, repeated ids and
    empty tables are as in :func:`failure_masks`.
    """
    return audit(materialize(failure_masks(docs, labels), "masks"))
