"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import brute
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import arc, chat, decontaminate, licenses, lines, near_dedup, packing, quality, substring, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, kept boolean, _s0 long, bucket int"
LONG = " ".join(f"w{i % 9973}" for i in range(60_000))
TEXTS = [(1, "a b c"), (2, None), (3, ""), (4, " \t\r\n "), (5, LONG), (6, LONG), (7, "x\n\ny\nz\nx\ny\nz"),
         (8, "Released under the MIT License."), (9, "é|| ÉÀ #*"), (None, "a b c"), (10, "a b c")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i == 5 else "en", None if i == 6 else "s", None, "clash", None, 0, 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "A, b"), (None, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (3, None), (4, "--")],
                                 "item_id long, text string")


def calls(items):
    split = lambda d: d.select("doc_id", F.col("`text`"), tokens.line_sections(F.col("text")).alias("sections"))
    return {
        "pack": packing.pack_documents, "substring": substring.dedup_substrings, "licenses": licenses.scan_licenses,
        "overlaps": lambda d: decontaminate.find_overlaps(d, items),
        "blocks": lambda d: decontaminate.find_overlaps(d, items, block_bytes=20),
        "cut": lambda d: decontaminate.decontaminate(d, items),
        "tokens": lambda d: tokens.count_tokens(split(d.toDF("doc_id", "text", *[f"c{i}" for i in range(len(d.columns) - 2)]))),
        "near": near_dedup.near_duplicates, "keep_one": near_dedup.keep_one, "quality": quality.quality_rules,
        "keep_quality": quality.keep_quality, "lines": lines.dedup_lines, "replace_lines": lines.replace_lines}


NAMES = sorted(calls(None))


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_empty_tables(docs, items, name):
    call = calls(items)[name]
    got = call(docs).collect()
    if name in ("cut", "keep_one", "keep_quality", "replace_lines"):
        assert set(map(len, got)) <= {9} and call(docs).columns == docs.columns
    elif name != "tokens":
        assert len(got) == len(TEXTS)  # a row per row, null ids too
    assert call(docs.limit(0)).collect() == []


def test_values_of_odd_rows(docs, items):
    known = [(i, t) for i, t in TEXTS if i is not None]
    by = lambda rows, *c: {r["doc_id"]: tuple(r[x] for x in c) for r in rows if r["doc_id"] is not None}
    got = by(near_dedup.near_duplicates(docs, k=2).collect(), "n_shingles", "component_id", "kept")
    assert got == brute.near(known, 2) and got[6] == (got[5][0], 5, False) and got[10][1] == 1
    got = substring.dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("s")).collect()
    assert by(got, "n_words", "n_removed", "s") == brute.substring_dedup(known)
    for size in (1 << 20, 20):
        got = decontaminate.find_overlaps(docs, items, block_bytes=size).collect()
        want = brute.overlaps(known, [tuple(r) for r in items.collect()])
        assert {r["doc_id"]: (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["items"]))
                for r in got if r["doc_id"] is not None} == {i: w[:3] for i, w in want.items()}
    assert by(lines.dedup_lines(docs).collect(), "n_lines", "n_removed", "text") == brute.line_dedup(known)
    got = by(quality.quality_rules(docs).collect(), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == {i: brute.quality_base(t) for i, t in known}
    got = by(licenses.scan_licenses(docs).collect(), "license", "dice", "unit")
    assert got[8] == ("MIT-notice", 1.0, -1) and got[2] == (None, None, None)
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items).collect()}
    assert 1 not in cut and cut[2] is None and len(cut[5]) < len(LONG)


def test_repeated_rows_stay_alike(spark):
    text = " ".join(f"t{i}" for i in range(80)) + "\nl1\nl2\nl3"
    d = spark.createDataFrame([(i, text) for i in (1, 1, 2, 2)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in substring.dedup_substrings(d).collect()) == [0, 0, 83, 83]
    assert sorted(r["kept"] for r in near_dedup.near_duplicates(d).collect()) == [False, False, True, True]
    assert sorted(r["n_removed"] for r in lines.dedup_lines(d).collect()) == [0, 0, 4, 4]
    assert near_dedup.keep_one(d).count() == 2


def test_boundaries_are_optimal():
    """The dynamic programme against every choice of boundaries."""
    from itertools import combinations

    lengths, counts = [1, 2, 5, 9, 10, 40], [7, 3, 8, 1, 4, 2]
    cost = lambda ends: sum(n * (min(e for e in ends if e >= x) - x) for x, n in zip(lengths, counts))
    for k in range(1, 7):
        best = min(cost([*c, 40]) for c in combinations(lengths[:-1], k - 1))
        assert cost(packing.best_boundaries(lengths, counts, k)) == best


def test_boundaries_of_long_histograms():
    """Equal to the plain programme over all splits, ties too; sums beyond 64 bits still give boundaries."""
    import random

    import brute

    draw = random.Random(3)
    for m, buckets, most in ((1, 4, 9), (7, 16, 3), (60, 5, 2), (300, 16, 1000), (400, 9, 1)):
        lengths = sorted(draw.sample(range(5 * m), m))
        counts = [draw.randint(1, most) for _ in lengths]
        every = [x for x, n in zip(lengths, counts) for _ in range(n)]
        assert packing.best_boundaries(lengths, counts, buckets) == brute.boundaries(every, buckets)
    assert packing.best_boundaries([], [], 3) == []
    assert packing.best_boundaries([1, 2, 1 << 40], [1 << 30, 1 << 30, 1 << 30], 2) == [2, 1 << 40]


def test_token_rule_conserves_tokens(spark):
    rows = [(1, "alpha beta gamma", [(0, 0, 8), (1, 8, 16)]), (2, "日本語 text", [(7, 1, 2)]), (3, None, None)]
    d = spark.createDataFrame(rows, f"doc_id long, text string, sections {tokens.SECTIONS}")
    got = {(r["doc_id"], r["section"]): r for r in tokens.count_tokens(d).collect()}
    import tiktoken, base64  # noqa: E401
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokens.VOCABULARY, "rb"))}
    own = tiktoken.Encoding("t", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text, _ in rows:
        assert sum(r["n_tokens"] for k, r in got.items() if k[0] == i) == len(own.encode_ordinary(text or ""))
    assert got[1, 0]["n_chars"] == 8 and got[1, 0]["n_crossing"] + got[1, 1]["n_crossing"] >= 1


def test_chat_edges(spark):
    rows = [(1, 0, "system", "s " * 50), *[(1, i, ("user", "assistant")[i % 2], f"{i} " * 60) for i in range(1, 13)],
            (2, 0, None, None), (None, None, "assistant", "<|im_end|>\\s<\\p"), (3, 300, "assistant", "late"), (3, 0, "user\nx", ""),
            (4, 0, "assistant", "same"), (4, 0, "assistant", "same")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    w = chat.chat_windows(d)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
           for r in chat.conversation_digests(w).collect()}
    assert got == brute.chat(rows)
    assert all(r["n_tokens"] <= chat.BUDGET for r in w.collect()) and w.filter("conv_id = 1 AND n_repeated > 1").count() > 0
    assert chat.chat_windows(d.limit(0)).collect() == []


def test_arc_and_warc_edges(spark, scratch):
    rows = [(1, "http://a/ b", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (None, "n", "<p>é</p>"), (5, "u", "x" * 200_000)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
           for r in arc.convert_pages(d, f"{scratch}/warc-edges").collect()}
    assert got.pop(None)[2] == "response" and got == brute.warc([(i, h) for i, _, h in rows if i is not None])
    got = {r["page_id"]: r["record_type"] for r in arc.convert_pages(d, f"{scratch}/warc-min", min_bytes=1).collect()}
    assert got[4] == "response" and got[2] == "revisit"
    assert arc.convert_pages(d.limit(0), f"{scratch}/warc-none").collect() == []
    good = arc.arc_bytes("x.arc", 1, [(1, "u", b"\xff\x00")])
    bad = spark.createDataFrame([("a", good), ("b", good[:-20]), ("c", b"junk"), ("d", None)], "archive string, content binary")
    found = {r["archive"]: (r["payload"], r["error"]) for r in arc.read_arc(bad).collect()}
    assert bytes(found["a"][0]) == b"\xff\x00" and found["b"][1] and found["c"][1] and "d" not in found
    for version in (1, 2):
        (r,) = arc.arc_records("x", arc.arc_bytes("x", version, [(7, "http://h/", b"body")]))
        assert (r["arc_version"], r["url"], r["payload"]) == (version, "http://h/", b"body")


def test_long_payloads_have_files_of_their_own(spark, scratch):
    """Files and archives are bounded in bytes as in records; every record is read back."""
    rows = [(i, "u", "x" * (40 + i) if i % 5 else "y" * (5_000 + i)) for i in range(1, 41)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    archives = arc.to_arc(d, records=10, max_bytes=6_000)
    assert max(len(list(arc.arc_records(r["archive"], bytes(r["content"])))) for r in archives.collect()) <= 10
    assert max(len(r["content"]) for r in archives.collect()) < 6_000 + 10 * 200
    path = f"{scratch}/warc-long"
    arc.to_warc(arc.read_arc(archives).withColumn("number", arc.page_number()), path, per_file=10, max_bytes=11_000)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    held = [[len(r["block"]) for r in arc.warc_records(bytes(f["content"]))] for f in files.collect()]
    assert max(map(len, held)) <= 10 and max(map(sum, held)) < 11_000 + 10 * 200
    got = {r["n"]: bytes(r["payload"]).decode() for r in arc.read_warc(spark, path).withColumn("n", arc.page_number()).collect()}
    assert got == {i: x for i, _, x in rows}


def test_doubling_goes_on_until_nothing_repeats(spark):
    """The longest level at which a window repeats: 13 * 2**k words, by document."""
    w = [f"u{i}" for i in range(200)]
    rows = [(1, " ".join(w)), (2, "x " + " ".join(w[10:110])), (3, " ".join(w[150:170])), (4, "no such words here")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_words"] for r in substring.longest_repeats(d).collect()}
    assert got == {1: 52, 2: 52, 3: 13}
