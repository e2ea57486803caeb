"""Quality rules with thresholds learnt from mergeable quantile sketches (operator 7).

DataFrame functions only.  Every document gets integer measures; every
(language, source) gets a histogram sketch of each rate, whose counts merge by
addition; fences are read off the sketch's quartiles and joined back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm._tables import materialize, pick, text_or_empty

#: Separator run between words, and one word character (Java regex).
GAP, WORD_CHAR = r"[ \t-\r]+", r"[^ \t-\r]"
SYMBOL = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rate:
    """A sketched rate: ``scale * part / whole`` as an integer of any size (:func:`rate_bin`).

    A document fails above ``q75 + spread * (q75 - q25) + margin`` and, if
    ``low`` is given, below ``q25 - spread * (q75 - q25) - low``.
    """

    name: str
    part: str
    whole: str
    scale: int
    margin: int
    low: int | None = None


RATES = (
    Rate("symbols", "n_symbols", "word_chars", 1000, 50),
    Rate("repeats", "n_repeat_words", "n_words", 1000, 150),
    Rate("dup_lines", "n_dup_lines", "n_lines", 1000, 200),
    Rate("word_length", "word_chars", "n_words", 100, 150, 100),
)
#: Rates below 2**BITS have a bin each; of greater ones the leading BITS bits tell the bin.
BITS = 12
#: Interquartile ranges between a quartile and its fence.
SPREAD = 3
#: Groups with fewer sketched documents use their language's merged sketch, then that of all.
MIN_GROUP = 100


def _n(array: Column) -> Column:
    return F.size(array).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, and the integer measures of each whole text.

    - n_words: words ``[^ \\t-\\r]+``; word_chars: their code points.
    - n_symbols: characters of ``[#*$%&|<>]``.
    - n_lines: ``\\n``-split lines with a word; n_dup_lines: those equal to an earlier one.
    - n_repeat_words: words in three-word windows found twice or more in the
      text.  Window positions are sorted by window hash, equal neighbours
      marked, and covered words counted from the gaps between marked
      positions: n log n for any text.
    - base_failed: fewer than 50 words, or over half of them repeated.

    A null text has no words.  Rows are kept as they are, repeated ones too;
    lang and source may be null (a group of its own).
    """
    text = text_or_empty(F.col("text"))
    d = pick(docs, "doc_id", "lang", "source", "text").select(
        "doc_id", "lang", "source",
        F.filter(F.split(text, GAP), lambda w: w != "").alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR)).alias("x"),
        F.length(F.regexp_replace(text, GAP, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOL, ""))).cast("long").alias("n_symbols"),
    )
    plain = ["doc_id", "lang", "source", "word_chars", "n_symbols"]
    no_hashes = F.array().cast("array<bigint>")
    d = d.select(
        *plain, _n("w").alias("n_words"), _n("x").alias("n_lines"),
        (_n("x") - _n(F.array_distinct("x"))).alias("n_dup_lines"),
        F.when(F.size("w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("w") - 3),
            lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)),
        )).otherwise(no_hashes).alias("g"),
    )
    plain += ["n_words", "n_lines", "n_dup_lines"]
    pairs = F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    d = d.select(*plain, F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array(pairs))
                 .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("z"))

    def repeated(s: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("z", i - 1)["h"])
        return F.coalesce(before == s["h"], F.lit(False)) | F.coalesce(F.get("z", i + 1)["h"] == s["h"], F.lit(False))

    d = d.select(*plain, F.sort_array(F.transform(F.filter("z", repeated), lambda s: s["i"])).alias("p"))
    covered = F.transform("p", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("p", k + 1) - x, F.lit(3))))
    d = d.select(*plain, F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))
    return d.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


def rate(r: Rate) -> Column:
    """The rate as an integer; null where its whole is 0 (no words: base_failed anyway)."""
    return F.expr(f"CASE WHEN {r.whole} > 0 THEN {r.scale} * {r.part} DIV {r.whole} END")


def _cut_bits(value: Column) -> Column:
    """How many last bits of a rate its bin leaves out."""
    return F.when(value < 2**BITS, 0).otherwise(F.length(F.bin(value)) - BITS).cast("int")


def rate_bin(value: Column) -> Column:
    """The least rate of the bin that holds ``value``: the rate itself below 2**BITS, without an upper end."""
    cut = _cut_bits(value)
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def bin_end(least: Column) -> Column:
    """The greatest rate of the bin that begins at ``least``."""
    return least + F.call_function("shiftleft", F.lit(1).cast("long"), _cut_bits(least)) - 1


def sketches(measured: DataFrame, rates: tuple[Rate, ...] = RATES) -> DataFrame:
    """(lang, source, rate, bin, n): histogram sketches of the documents that pass the base rules.

    A sketch has a fixed grid of bins, so merging is adding counts: exact,
    order-free and the same however the rows were partitioned.  Its quantiles
    are exact below 2**BITS (all shares; words of 40.96 code points) and off
    by less than one part in 2**(BITS - 1) beyond; no bin is open.
    """
    ones = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rate"), rate_bin(rate(r)).alias("bin")) for r in rates]))
    return (measured.filter("NOT base_failed").select("lang", "source", ones.alias("s"))
            .groupBy("lang", "source", "s.rate", "s.bin").agg(F.count("*").alias("n")))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rate, n, q25, q75: the first bins at which a quarter and three quarters are reached.

    q25 is the least rate of its bin and q75 the greatest, so that the rows
    of a wide bin are never outside the fences that it makes itself.
    """
    group = [*keys, "rate"]
    merged = sketch.groupBy(*group, "bin").agg(F.sum("n").alias("n"))
    below = Window.partitionBy(*group).orderBy("bin")
    at = merged.select(*group, "bin", "n", F.sum("n").over(below).alias("c"),
                       F.sum("n").over(Window.partitionBy(*group)).alias("total"))
    return at.groupBy(*group).agg(
        F.max("total").alias("n"),
        F.min(F.when(F.expr("4 * c >= total"), F.col("bin"))).alias("q25"),
        bin_end(F.min(F.when(F.expr("4 * c >= 3 * total"), F.col("bin")))).alias("q75"))


def fences(sketch: DataFrame, rates: tuple[Rate, ...] = RATES, spread: int = SPREAD,
           min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, <rate>_lo, <rate>_hi): one row per group that has a sketch.

    A group with under ``min_group`` documents takes the fences of its
    language, and a language with too few those of all documents: merged
    sketches, never other rows.
    """
    parts = []
    for level, keys in enumerate((["lang", "source"], ["lang"], [])):
        parts.append(_quartiles(sketch, keys).select(*[F.col(k).alias(f"{k}{level}") for k in keys],
                     "rate", *[F.col(c).alias(f"{c}_{level}") for c in ("n", "q25", "q75")]))
    own, by_lang, by_all = parts
    d = own.join(by_lang, F.expr("lang0 <=> lang1") & (own["rate"] == by_lang["rate"])).drop(by_lang["rate"])
    d = d.join(by_all, "rate")

    def chosen(c: str) -> Column:
        return (F.when(F.col("n_0") >= min_group, F.col(f"{c}_0"))
                .when(F.col("n_1") >= min_group, F.col(f"{c}_1")).otherwise(F.col(f"{c}_2")))

    d = d.select(F.col("lang0").alias("lang"), F.col("source0").alias("source"), "rate",
                 chosen("q25").alias("q25"), chosen("q75").alias("q75"))
    columns = []
    for r in rates:
        mine = F.col("rate") == r.name
        columns.append(F.max(F.when(mine, F.col("q75") + spread * (F.col("q75") - F.col("q25")) + r.margin))
                       .alias(f"{r.name}_hi"))
        low = F.lit(-1) if r.low is None else F.col("q25") - spread * (F.col("q75") - F.col("q25")) - r.low
        columns.append(F.max(F.when(mine, low)).alias(f"{r.name}_lo"))
    return d.groupBy("lang", "source").agg(*columns)


def _judged(measured: DataFrame, rates: tuple[Rate, ...], spread: int, min_group: int) -> DataFrame:
    """``measured`` (a written table) with kept."""
    limits = materialize(fences(sketches(measured, rates), rates, spread, min_group), "fences")
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    within = F.lit(True)
    for r in rates:
        within &= rate(r).between(F.col(f"{r.name}_lo"), F.col(f"{r.name}_hi"))
    joined = measured.join(limits, F.expr("lang <=> _lang AND source <=> _source"), "left")
    return joined.select(*measured.columns, (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept"))


def quality_rules(docs: DataFrame, rates: tuple[Rate, ...] = RATES, spread: int = SPREAD,
                  min_group: int = MIN_GROUP) -> DataFrame:
    """One row per row of ``docs``: the measures, base_failed and kept.

    kept: not base_failed and every rate within the fences of its language
    and source.  A group without fences (all its documents failed) keeps
    nothing.  Empty input gives an empty result; a null doc_id stays null.
    """
    judged = _judged(materialize(measures(docs), "measures"), rates, spread, min_group)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged.

    Every row is kept or not by its own verdict, whatever other rows share its
    id, and with a null id too.  Verdicts meet their rows by id and a hash of
    what they are told from (text, lang and source).
    """
    def key(text: Column, lang: Column, source: Column) -> Column:
        return F.xxhash64(text, lang, lang.isNull(), source, source.isNull())

    d = pick(docs, "doc_id", "lang", "source", "text")
    numbered = d.select(F.struct("doc_id", key(d["text"], d["lang"], d["source"]).alias("row_key")).alias("doc_id"), "lang", "source", "text")
    judged = _judged(materialize(measures(numbered), "measures"), RATES, SPREAD, MIN_GROUP)
    kept = judged.filter("kept").select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.row_key").alias("_key")).distinct()
    own = [f"_c{i}" for i in range(len(docs.columns))]
    flat = docs.toDF(*own)
    at = lambda name: F.col(own[docs.columns.index(name)])
    hashed = key(at("text"), at("lang"), at("source"))
    return flat.join(kept, at("doc_id").eqNullSafe(F.col("_id")) & (hashed == F.col("_key")), "left_semi").toDF(*docs.columns)
