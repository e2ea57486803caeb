"""Token counts per section from offset-mapped whole-document encoding (operator 5).

A document is encoded once.  A byte-level vocabulary's tokens spell the text's
bytes, so token offsets are running sums of token byte lengths; they become
character spans, which are joined to the sections' spans as intervals.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._tables import pick, text_or_empty

#: Byte-level BPE ranks; a parameter, read once by the driver (about 1 MB) and broadcast.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that goes with this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space of the pattern (the White_Space property), and runs of it that the pattern's own matcher cannot hold.
_WHITE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LONG_RUN = 100_000
#: How such a pattern ends: a run goes without its last character, which goes with what follows.
_RUN_RULE = r"\s+(?!\S)|\s+"

SECTIONS = "array<struct<section:long,start:long,end:long>>"


def line_sections(text: Column) -> Column:
    """The ``\\n``-split lines of a text as sections: number from 0, character span without the line break."""
    lengths = F.transform(F.split(text_or_empty(text), "\n"), lambda x: F.length(x).cast("long"))
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SECTIONS).alias("out"))
    return F.aggregate(lengths, state, lambda s, n: F.struct(
        (s["at"] + n + 1).alias("at"),
        F.concat(s["out"], F.array(F.struct(F.size(s["out"]).cast("long").alias("section"), s["at"].alias("start"),
                                            (s["at"] + n).alias("end")))).alias("out")), lambda s: s["out"])


def attribute(starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section index (or -1) of each token, and whether it crosses a section's edge.

    Tokens [starts, ends) and sections [low, high) are character spans in
    ascending order; sections do not overlap.  Rule: a token belongs to the
    section that holds most of its characters, the earlier one of equals, and
    to none (-1) if no section holds any.  A token crosses an edge if it has
    characters both inside and outside its section.
    """
    if not len(low):
        return np.full(len(starts), -1), np.zeros(len(starts), bool)
    first = np.searchsorted(high, starts, side="right")  # first section that ends after the token's start
    last = np.searchsorted(low, ends, side="left") - 1  # last one that starts before its end
    at = np.clip(first, 0, len(low) - 1)
    held = np.minimum(ends, high[at]) - np.maximum(starts, low[at])
    owner = np.where((first <= last) & (held > 0), at, -1)
    best = np.where(owner >= 0, held, 0)
    for i in np.flatnonzero(last > first):  # tokens that touch several sections
        share = np.minimum(ends[i], high[first[i]:last[i] + 1]) - np.maximum(starts[i], low[first[i]:last[i] + 1])
        k = int(np.argmax(share))
        owner[i], best[i] = (first[i] + k, share[k]) if share[k] > 0 else (-1, 0)
    return owner, (owner >= 0) & (best < ends - starts)


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """One row per section of each row of ``docs`` (doc_id, text, sections), and one for the text between them.

    ``sections`` has ascending, non-overlapping character spans.  Returns
    doc_id, section (-1: outside all sections), n_chars, n_tokens and
    n_crossing (tokens counted here with characters elsewhere too); see
    :func:`attribute` for the rule.  The n_tokens of a document sum up to the
    tokens of its whole text, each counted once.

    A null text is empty; null sections are none, so all tokens are at -1.
    Spans beyond the text hold nothing there.  Null ids and repeated rows are
    counted row by row; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    number = uuid.uuid4().hex
    d = pick(docs, "doc_id", "text", "sections").select("doc_id", text_or_empty(F.col("text")).alias("text"), "sections")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sizes = _encoder(number, shared.value, pattern)
        for batch in batches:
            texts, sections = batch.column("text"), batch.column("sections")
            for begin in range(0, batch.num_rows, 256):
                rows = [_count(encode, sizes, texts[i].as_py(), sections[i]) for i in range(begin, min(begin + 256, batch.num_rows))]
                ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(begin, begin + len(rows)), [len(r[0]) for r in rows])))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(np.concatenate([r[c] for r in rows]), pa.int64()) for c in range(4))],
                                                 ["doc_id", "section", "n_chars", "n_tokens", "n_crossing"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, section long, n_chars long, n_tokens long, n_crossing long")


_encoders: dict[str, tuple] = {}


def _encoder(number: str, raw: bytes, pattern: str) -> tuple:
    """The encoder and its tokens' byte lengths, built once per Python worker."""
    if number not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        sizes[list(ranks.values())] = list(map(len, ranks))
        own = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _encoders.clear()
        _encoders[number] = (_with_runs(own) if pattern.endswith(_RUN_RULE) else own.encode_ordinary), sizes
    return _encoders[number]


def _with_runs(encoding, long_run: int = LONG_RUN) -> Callable[[str], list[int]]:
    """The encoder of whole texts, with very long runs of white space encoded as the pieces that the pattern makes of them.

    A run before another character is one piece up to its last character; a
    run that ends the text is one piece.  So the text is cut there, and its
    tokens are those of the text uncut.
    """
    runs = re.compile(f"(?<!{_WHITE}){_WHITE}{{{long_run},}}")

    def encode(text: str) -> list[int]:
        if len(text) < long_run:
            return encoding.encode_ordinary(text)
        out, at = [], 0
        for run in runs.finditer(text):
            begin, end = run.start(), run.end() - (run.end() < len(text))
            out += encoding.encode_ordinary(text[at:begin])
            out += encoding._encode_single_piece(text[begin:end])
            at = end
        return out + encoding.encode_ordinary(text[at:])

    return encode


def _count(encode, sizes: np.ndarray, text: str, sections: pa.ListScalar) -> tuple[np.ndarray, ...]:
    spans = sections.values
    section, low, high = ((spans.field(c).to_numpy(zero_copy_only=False) if spans is not None else np.zeros(0, np.int64))
                          for c in ("section", "start", "end"))
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # character that each byte belongs to
    ends = np.cumsum(sizes[encode(text)])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    owner, crossing = attribute(char[starts], char[ends - 1] + 1, low, high) if len(ends) else (ends.astype(int), ends.astype(bool))
    n = len(low)
    tokens = np.bincount(owner + 1, minlength=n + 1)
    crossed = np.bincount(owner + 1, weights=crossing, minlength=n + 1).astype(np.int64)
    inside = np.maximum(0, np.minimum(high, len(text)) - np.minimum(low, len(text)))
    chars = np.concatenate([[len(text) - inside.sum()], inside])
    return np.concatenate([[-1], section]), chars, tokens, crossed
