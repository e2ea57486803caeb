"""Filter audit on odd rows, against applying the filters one after the other; the matrix against the texts."""

from collections import Counter
from itertools import permutations

import brute

from ledgerlens.llm import filters

LONG = " ".join(f"w{i % 61}" for i in range(200_000))
DOCS = [(1, "a B", "s"), (2, None, "s"), (3, "", None), (4, " \t\n", ""), (5, LONG, "s"), (6, LONG, "t"), (7, "a B", "s"), (7, "x #", "s"),
        (None, "a B", "t"), (8, " ".join(f"é{i}" for i in range(60)), "t"), (9, "W" * 100, "t"), (10, "x #", "s"), (10, "x #", "s")]
LABELS = [(1, 1, 0), (5, 0, 1), (5, 1, 0), (7, None, 1), (10, 1, 1), (None, 1, 1), (99, 1, 1)]


def frames(spark):
    docs = spark.createDataFrame([(*d, "x", 0) for d in DOCS], "doc_id long, text string, source string, TEXT string, mask int")
    labels = spark.createDataFrame([(*x, 0) for x in LABELS], "doc_id long, quality int, toxic int, Doc_Id int")
    return docs, labels


def fails():
    out = []
    for i, text, source in DOCS:
        t = text or ""
        w = brute.words(t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
             "D": any(c in "#$%&*|" for c in t), "E": i is not None and any(j is not None and j < i and (x or "") == t for j, x, _ in DOCS)}
        labels = [x for x in LABELS if i is not None and x[0] == i]
        out.append((source or "", {k for k in f if f[k]}, any(x[1] == 1 for x in labels), any(x[2] == 1 for x in labels)))
    return out


def test_audit(spark):
    rows = fails()
    want = Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                out = [r for r in left if f in r[1]]
                redundant = sum(f in r[1] for r in gone)
                left, gone = [r for r in left if f not in r[1]], gone + out
                want[part, order, step] = [len(left), len(out), redundant, sum(r[1] == {f} for r in rows if r[0] == part),
                                           sum(r[2] for r in out), sum(r[3] for r in out)]
    total = Counter()
    for (part, order, step), values in want.items():
        total[part, order[step - 1]] += values[1]
    want = {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in want.items()}
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in names) for r in filters.audit_filters(*frames(spark)).collect()}
    assert got == want


def test_matrix(spark):
    docs = spark.createDataFrame([(i, "p", t or "") for i, t, _ in DOCS], "doc_id long, part string, text string").repartition(3)
    matrix, dictionary = filters.document_term_matrix(docs, shard_bytes=64)
    words = {r["term"]: bytes(r["word"]).decode() for r in dictionary.collect()}
    assert len(words) == dictionary.count() == len(set(words.values())) == len({w for _, t, _ in DOCS for w in brute.words(t)})
    got = []
    for r in matrix.collect():
        for i, doc in enumerate(r["doc_id"]):
            a, b = r["indptr"][i], r["indptr"][i + 1]
            got.append((doc, sorted((words[t], n) for t, n in zip(r["columns"][a:b], r["counts"][a:b]))))
    assert sorted(got, key=str) == sorted(((i, sorted(Counter(brute.words(t)).items())) for i, t, _ in DOCS), key=str)


def test_empty(spark):
    docs, labels = frames(spark)
    assert filters.audit_filters(docs.limit(0), labels).collect() == []
    assert len(filters.audit_filters(docs, labels.limit(0)).collect()) == 3 * 120 * 5


def test_words_travel_by_shard_and_bucket(spark):
    """A row per shard and bucket, not one per word; the words of a bucket are those of its hashes in every shard."""
    docs = spark.createDataFrame([(i, "p", t or "") for i, t, _ in DOCS], "doc_id long, part string, text string").coalesce(1)
    local = filters.local_shards(docs, shard_bytes=64).localCheckpoint()
    pieces = filters.word_pieces(local, 3).collect()
    shards = [r for r in local.select("shard", "words").collect() if r["words"]]
    assert len({(r["shard"], r["bucket"]) for r in pieces}) == len(pieces) <= 3 * len(shards) < sum(len(r["words"].split()) for r in shards)
    for r in shards:
        own = sorted((p["bucket"], p["words"]) for p in pieces if p["shard"] == r["shard"])
        assert b" ".join(w for _, w in own) == bytes(r["words"])
    buckets = {}
    for r in pieces:
        for w in bytes(r["words"]).split():
            buckets.setdefault(w, set()).add(r["bucket"])
    assert all(len(b) == 1 for b in buckets.values()) and {b for x in buckets.values() for b in x} == {0, 1, 2}


def test_matrix_of_many_buckets(spark, monkeypatch):
    """Words at every white space and beside none, in buckets that take several Arrow batches."""
    monkeypatch.setattr(filters, "BUCKET_BYTES", 16)
    texts = ["\x1ca\x85b c \x00 a\x0bb\x0cc\r\nd\t\te ", " ", "", *[" ".join(f"w{j % (i + 3)}" for j in range(40)) + "  " for i in range(40)], "é x" * 50]
    docs = spark.createDataFrame([(i, "p", t) for i, t in enumerate(texts)], "doc_id long, part string, text string").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        matrix, dictionary = filters.document_term_matrix(docs, shard_bytes=300, bucket_bytes=32)
        words = {r["term"]: bytes(r["word"]) for r in dictionary.collect()}
        measures = {r["doc_id"]: (r["n_words"], r["n_distinct"]) for r in filters.row_measures(matrix).collect()}
        rows = matrix.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = [Counter(t.encode().split()) for t in texts]
    assert len(words) == dictionary.count() and set(words.values()) == {w for t in want for w in t} and len(set(words.values())) == len(words)
    assert len({t >> 32 for t in words}) > 3  # buckets
    got = {}
    for r in rows:
        for i, doc in enumerate(r["doc_id"]):
            a, b = r["indptr"][i], r["indptr"][i + 1]
            got[doc] = {words[t]: n for t, n in zip(r["columns"][a:b], r["counts"][a:b])}
    assert got == dict(enumerate(want))
    assert measures == {i: (t.total(), len(t)) for i, t in enumerate(want)}
