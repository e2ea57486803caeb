"""MinHash near-duplicates with sequential Bayesian verification (operator 6).

Banded MinHash proposes pairs; their signatures are compared batch by batch,
and a pair is dropped as soon as the posterior chance that its similarity
reaches the threshold falls below a chosen miss probability; every survivor
is verified on the full shingle sets.  Equal sets are one class from the
start, so copies never meet in a bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._graph import components
from ledgerlens.llm._tables import materialize, pick
from ledgerlens.llm._words import LOWER, U64, WordHasher, parts, windows

#: A signature is HASHES one-byte minima; BANDS bands of ROWS of them.  A pair of
#: similarity 0.8 shares no band with probability (1 - 0.8**6)**48 < 5e-7.
HASHES, BANDS, ROWS = 288, 48, 6
#: Minima compared between two looks at the posterior.
BATCH = 32
#: Chance below which a pair is given up.
MISS = 1e-7


def shingle_sets(texts: list[bytes | None], k: int, hasher: WordHasher) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its k-word shingles.

    A text of fewer words has one shingle, the whole sequence; a text without
    words has none.
    """
    words, first = hasher.words(texts)
    grams = windows(words, k)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            sets.append(np.unique(grams[a:b - k + 1]))
        else:
            sets.append(windows(words[a:b], b - a) if b > a else np.zeros(0, U64))
    return sets


def _multipliers() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, HASHES, dtype=U64) * U64(2) + U64(1)


def signatures(sets: list[np.ndarray], multipliers: np.ndarray) -> np.ndarray:
    """One row of HASHES bytes per non-empty set: the top bits of a mix of each minimum."""
    if not sets:
        return np.zeros((0, len(multipliers)), np.uint8)
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets)])[:-1]
    out, x = np.empty((len(sets), len(multipliers)), np.uint8), np.empty_like(flat)
    for i, m in enumerate(multipliers):
        np.multiply(flat, m, out=x)
        least = np.minimum.reduceat(x, at)
        out[:, i] = ((least ^ (least >> U64(29))) * U64(0xBF58476D1CE4E5B9)) >> U64(56)
    return out


def sign(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature, text_hash) per row of ``docs``; set_key and signature are null without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, multipliers = WordHasher(LOWER), _multipliers()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in parts(texts, 1 << 20):
                sets = shingle_sets(texts[part], k, hasher)
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full, multipliers))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.start, part.stop - part.start),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                    batch.column(2).slice(part.start, part.stop - part.start),
                ], ["doc_id", "n_shingles", "set_key", "signature", "text_hash"])

    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return hashed.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary, text_hash long")


def prune_bounds(percent: int, miss: float = MISS) -> np.ndarray:
    """Least number of equal minima after each batch for a pair to stay in.

    Prior: similarity s uniform on [0, 1].  Two one-byte minima agree with
    probability s + (1 - s) / 256, so after n comparisons with m equal the
    posterior of s is proportional to p(s)**m * (1 - p(s))**(n - m); the bound
    is the smallest m at which P(s >= percent / 100) reaches ``miss``.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256
    high = s >= percent / 100
    bounds = []
    for n in range(BATCH, HASHES + 1, BATCH):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(p) + (n - m) * np.log1p(-p)
        weight = np.exp(log - log.max(axis=1, keepdims=True))
        chance = weight[:, high].sum(axis=1) / weight.sum(axis=1)
        bounds.append(int(np.argmax(chance >= miss)))
    return np.array(bounds)


def prune(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the size bound and every batch of the sequential test."""
    bounds = prune_bounds(percent)
    left = signed.select(F.col("rep").alias("a"), F.col("signature").alias("x"), F.col("n_shingles").alias("n"))
    right = signed.select(F.col("rep").alias("b"), F.col("signature").alias("y"), F.col("n_shingles").alias("m"))
    both = (pairs.join(left, "a").join(right, "b")
            .filter(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).select("a", "b", "x", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, HASHES) for c in "xy")
            alive, equal = np.arange(n), np.zeros(n, np.int64)
            for i, bound in enumerate(bounds):
                part = slice(i * BATCH, (i + 1) * BATCH)
                equal[alive] += (x[alive, part] == y[alive, part]).sum(axis=1)
                alive = alive[equal[alive] >= bound]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in "ab"], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= percent * union."""
    both = (pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("rep").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(LOWER)
        for batch in batches:
            x, y = (batch.column(c).cast(pa.binary()).to_pylist() for c in "xy")
            for part in parts([p + q for p, q in zip(x, y)]):
                linked = []
                for s, t in zip(shingle_sets(x[part], k, hasher), shingle_sets(y[part], k, hasher)):
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    linked.append(100 * both >= percent * (len(s) + len(t) - both))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(part.start, len(linked)).filter(pa.array(linked)) for c in "ab"], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _split(buckets: DataFrame, group: DataFrame) -> DataFrame:
    """Rows (bucket, rep, component) of buckets whose members span components."""
    own = buckets.select("bucket", "rep").join(group, F.expr("rep = id"), "left")
    own = materialize(own.select("bucket", "rep", F.coalesce("component", "rep").alias("component")), "members")
    spread = own.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    spread = materialize(spread.filter("low <> high").select(F.col("bucket").alias("_bucket")), "split-buckets")
    return materialize(own.join(spread, F.expr("bucket = _bucket"), "left_semi"), "members")


def _rare_pairs(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs of ``members`` (bucket, rep, component) in different components that may still reach ``percent``.

    An exact prefix filter in place of all pairs of a bucket.  Members that
    meet in buckets, directly or through others, form a cluster; a member's
    shingles are ordered by how many of its cluster have them, rarest first.
    If the first shingle that two sets of n and m have in common is at
    positions p and q, their intersection is at most min(n - p, m - q), which
    bounds how late it may come.  So sets are joined on their rarest shingles
    only, and copies that share no more than their common source never meet.
    One side leaves out the largest component of each cluster.
    """
    first = members.groupBy("bucket").agg(F.min("rep").alias("a")).withColumnRenamed("bucket", "_bucket")
    clusters = components(members.join(first, F.expr("bucket = _bucket")).select("a", F.col("rep").alias("b")))
    who = members.select(F.col("rep").alias("_rep"), F.col("component").alias("own")).distinct()
    who = materialize(clusters.join(who, F.expr("id = _rep")).select("id", F.col("component").alias("cluster"), "own"), "clusters")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(LOWER)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for part in parts(texts, 1 << 20):
                sets = shingle_sets(texts[part], k, hasher)
                n = np.array(list(map(len, sets)), np.int64)
                rows = pa.array(np.repeat(np.arange(part.start, part.stop), n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cluster").take(rows), batch.column("rep").take(rows), pa.array(np.repeat(n, n)),
                     pa.array(np.concatenate(sets).view(np.int64))], ["cluster", "rep", "n", "h"])

    shingles = texts.join(who, F.expr("rep = id")).select("cluster", "rep", "text").mapInArrow(
        explode, "cluster long, rep long, n long, h long")
    shingles = materialize(shingles, "shingles")
    sizes = who.groupBy("cluster", "own").agg(F.count("*").alias("n")).groupBy("cluster").agg(
        F.max(F.struct("n", "own")).alias("top")).select("cluster", F.col("top.own").alias("largest"))
    sizes = sizes.join(shingles.groupBy("cluster").agg(F.min("n").alias("least")), "cluster")
    # the facts of a cluster travel by document: shingles never meet on the cluster, which may hold a third of them
    who = materialize(who.join(materialize(sizes, "cluster-sizes"), "cluster").drop("cluster"), "clusters")
    common = materialize(shingles.groupBy("cluster", "h").agg(F.count("*").alias("df"))
                         .withColumnsRenamed({"cluster": "_cluster", "h": "_h"}), "frequencies")
    ordered = shingles.join(common, F.expr("cluster = _cluster AND h = _h")).select("cluster", "rep", "n", "h", "df")
    ordered = ordered.withColumn("at", F.expr("row_number() OVER (PARTITION BY rep ORDER BY df, h) - 1"))
    prefix = ordered.filter("df > 1").join(who, F.expr("rep = id")).filter(
        f"100 * (n - at) >= {percent} * (at + greatest(least, ceil({percent} * n / 100)))")
    prefix = materialize(prefix.select("cluster", "h", "rep", "n", "at", "own", "largest"), "prefixes")
    x = prefix.filter("own <> largest").select(*[F.col(c).alias(f"_{c}") for c in ("cluster", "h", "rep", "n", "at", "own")])
    most = "least(n - at, _n - _at)"
    pairs = prefix.join(x, F.expr(
        f"cluster = _cluster AND h = _h AND own <> _own AND 100 * {most} >= {percent} * (n + _n - {most})"))
    return pairs.select(F.least("rep", "_rep").alias("a"), F.greatest("rep", "_rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_shingles, component_id, kept.

    Words are ``[^ \\t-\\r]+`` with A-Z lower-cased; a document's set are its
    distinct k-word shingles.  Documents are linked if 100 * intersection >=
    percent * union, and component_id is the smallest doc_id reachable.  kept:
    the row's id is its component's.

    Candidates come from bands, and no bucket is expanded into all its pairs:
    first each class meets the hubs of its buckets, then members of a bucket
    that are still in different components meet on their rarest shingles
    (:func:`_rare_pairs`, an exact bound).  No bucket is capped.

    Null or wordless texts have an empty set and stay alone.  Rows that repeat
    an id are one document with several texts: it is linked by each of them,
    and all its rows with words are kept or none.  Rows with a null id have a
    null component and are kept.  An empty table gives an empty result.

    Nodes are classes of equal sets, under numbers of their own; ids come in
    at the end, a component's being the smallest of its classes' ids.
    """
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    signed = materialize(sign(d, k), "signatures")
    known = signed.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
    # numbered while written, so the numbers stay what they are
    classes = materialize(known.groupBy("set_key").agg(F.min("doc_id").alias("least"))
                          .withColumn("rep", F.monotonically_increasing_id()), "classes")
    of = classes.select(F.col("set_key").alias("_key"), "least", "rep")
    reps = known.join(of, F.expr("doc_id = least AND set_key = _key")).dropDuplicates(["rep"])
    reps = reps.select("rep", "n_shingles", "signature", "least", "text_hash")

    bands = reps.select("rep", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("signature"), i * ROWS + 1, F.lit(ROWS))))).alias("bucket"))
    full = materialize(bands.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
                       .select(F.col("bucket").alias("_bucket"), "n"), "full-buckets")
    buckets = materialize(bands.join(full, F.expr("bucket = _bucket")).select("bucket", "rep", "n"), "buckets")
    # a member that meets many others is the likely centre of its near copies: it is the hub of its buckets
    met = materialize(buckets.groupBy("rep").agg(F.sum("n").alias("met")), "met")
    hubs = buckets.join(met.withColumnRenamed("rep", "_rep"), F.expr("rep = _rep")).groupBy("bucket").agg(
        F.max(F.struct("met", (-F.col("rep")).alias("o"))).alias("h"))
    hubs = hubs.select(F.col("bucket").alias("_bucket"), (-F.col("h.o")).alias("hub"))
    met = met.select("rep")
    signed_met = materialize(reps.join(met, "rep", "left_semi"), "met-signatures")
    wanted = signed_met.select("rep", "least", F.col("text_hash").alias("_hash"))
    texts = materialize(d.join(wanted, (F.col("doc_id") == F.col("least")) & (F.xxhash64("text") == F.col("_hash")))
                        .select("rep", "text").dropDuplicates(["rep"]), "met-texts")

    def linked(pairs: DataFrame) -> DataFrame:
        left = materialize(prune(pairs, signed_met, percent), "pruned")
        return materialize(verify(left, texts, k, percent), "links")

    stars = buckets.join(hubs, F.expr("bucket = _bucket")).filter("rep <> hub").select(
        F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()
    stars = materialize(stars, "stars")
    links = linked(stars)
    several = known.groupBy("doc_id").agg(F.min(F.xxhash64("set_key")).alias("x"), F.max(F.xxhash64("set_key")).alias("y"))
    several = materialize(several.filter("x <> y").select(F.col("doc_id").alias("_id")), "repeated-ids")
    if not several.isEmpty():
        links = links.union(_same_id(known, of, several))
    group = components(links)
    members = _split(buckets, group)
    if not members.isEmpty():
        rest = materialize(_rare_pairs(members, texts, k, percent).join(stars, ["a", "b"], "left_anti"), "pairs")
        links = links.union(linked(rest))
        group = components(links)

    member = classes.join(group, F.expr("rep = id"), "left").select("set_key", "least", F.coalesce("component", "rep").alias("node"))
    least = member.groupBy("node").agg(F.min("least").alias("c")).withColumnRenamed("node", "_node")
    member = member.join(least, F.expr("node = _node")).select(F.col("set_key").alias("_key"), "c")
    member = materialize(member, "class-ids")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("c")), F.col("doc_id"))
    return (signed.select("doc_id", "n_shingles", "set_key").join(member, F.expr("set_key = _key"), "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")))


def _same_id(known: DataFrame, of: DataFrame, several: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of the ids ``several`` (_id), which have more than one."""
    held = known.select("doc_id", "set_key").join(several, F.expr("doc_id = _id"))
    held = materialize(held.join(of, F.expr("set_key = _key")).select("doc_id", "rep").distinct(), "repeated")
    first = held.groupBy("doc_id").agg(F.min("rep").alias("a")).withColumnRenamed("doc_id", "_id")
    return materialize(held.join(first, F.expr("doc_id = _id")).select("a", F.col("rep").alias("b")), "same-ids")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the smallest id of each near-duplicate component; columns unchanged, null ids and wordless texts kept."""
    gone = near_duplicates(docs, k, percent).filter("NOT kept").select(F.col("doc_id").alias("_id")).distinct()
    own = [f"_c{i}" for i in range(len(docs.columns))]
    doc_id, text = (F.col(own[docs.columns.index(c)]) for c in ("doc_id", "text"))
    left = docs.toDF(*own).join(materialize(gone, "near-copies"), (doc_id == F.col("_id")) & text.rlike(r"[^ \t-\r]"), "left_anti")
    return left.toDF(*docs.columns)
