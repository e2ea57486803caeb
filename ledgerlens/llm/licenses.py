"""Licence scans: Dice coefficient over word bigrams (operator 3), DataFrame functions only."""

from __future__ import annotations

from bisect import bisect_left
from functools import cache
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._tables import pick, text_or_empty

# Wordings of public licences and of the notices that name them.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause-notice": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Released under the MIT License.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
}


@cache
def known_templates() -> dict[str, str]:
    """TEMPLATES and the licence texts and standard file headers in ``wordings`` (<id>.txt)."""
    folder = resources.files("ledgerlens.llm") / "wordings"
    files = {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in folder.iterdir() if f.name.endswith(".txt")}
    return TEMPLATES | files


#: Least Dice coefficient of a match, in hundredths.
PERCENT = 80


def normalised(text: Column) -> Column:
    """Lower case; every run of other characters than a-z, 0-9 is one space; "licence" is spelt "license"."""
    plain = F.trim(F.regexp_replace(F.lower(text_or_empty(text)), "[^a-z0-9]+", " "))
    return F.replace(plain, F.lit("licence"), F.lit("license"))


def bigrams(words: Column) -> Column:
    """Distinct word bigrams of an array of words (empty with fewer than two)."""
    return F.array_distinct(F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))),
        lambda a, b: F.concat_ws(" ", a, b)))


def _template_table(spark, templates: dict[str, str]) -> list[tuple[str, int, list[str], list[int], list[int]]]:
    """Template ids with their number of words, their bigrams, the bigrams' hashes, by the same functions as the texts, and slots.

    There are as many slots as bigrams; those of slot ``i`` (hash modulo slots)
    are the bigrams from ``slots[i]`` to ``slots[i + 1]``, so a bigram is
    looked up among one or a few, however long the template.
    """
    rows = spark.createDataFrame(sorted(templates.items()), "id string, text string")
    words = rows.select("id", F.filter(F.split(normalised(F.col("text")), " "), lambda w: w != "").alias("w"))
    found = words.select("id", F.size("w").alias("n"), bigrams(F.col("w")).alias("b")).withColumn(
        "h", F.transform("b", lambda b: F.xxhash64(b)))
    known = []
    for r in found.collect():
        if m := len(r["b"]):
            dealt = sorted(zip((h % m for h in r["h"]), r["b"], r["h"]))
            slots = [bisect_left(dealt, (i,)) for i in range(m + 1)]
            known.append((r["id"], r["n"], [b for _, b, _ in dealt], [h for *_, h in dealt], slots))
    return known


def _strings(values: list[str]) -> Column:
    """A constant array of bigrams, which the optimizer folds."""
    return F.split(F.lit("|".join(values)), r"\|")


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_units, n_matched, license, dice, unit, passage_start, passage_words.

    Units are the whole text (unit -1) and its ``\\n``-split lines (from 0);
    n_units counts those with a bigram.  Besides, every passage is compared
    that has the size of a template, wherever it begins and whatever surrounds
    it: all runs of consecutive words, over line ends too, that have at most
    ``(200 - percent) / percent`` times the template's word bigrams (repeated
    ones counted).  A passage is a unit (-2) if it is the template's best one
    in the text and better than the whole text and every line; then
    passage_start and passage_words give it in words of the normalised text.
    A unit matches its best template with a Dice coefficient
    ``2 * shared / (a + b)`` over distinct bigrams of ``percent`` or more;
    n_matched counts matching units, and license, dice and unit give the best
    one (ties: the smaller template id, then the earlier unit, then the
    earlier passage).  Without a match they are null.

    No candidate is lost on the way: a match shares ``percent / (200 -
    percent)`` of the template's bigrams at least, so texts that hold fewer
    (by hash) are left out; and a passage that begins or ends with a foreign
    bigram, or stops short of the next bigram of the template, is never better
    than the one cut or extended there, so passages go from the first to the
    last bigram of a maximal stretch of template bigrams.  Distinct bigrams
    are counted while a passage grows or moves, so a text costs its words plus,
    for each beginning of a stretch with enough of a template behind it, the
    template's size.

    ``templates`` (default :func:`known_templates`) is held in the plan, so
    meant for the usual some hundred wordings.  Null and empty texts have no
    units.  Rows are kept as they are, null ids and repeated rows too.
    """
    known = _template_table(docs.sparkSession, known_templates() if templates is None else templates)
    if not known:
        known = [("", 0, ["\n"], [0], [0, 1])]  # matches no text
    least = [-(-percent * len(b) // (200 - percent)) for _, _, b, *_ in known]
    words = lambda x: F.filter(F.split(x, "[ \n]+"), lambda w: w != "")
    d = pick(docs, "doc_id", "text").select("doc_id", normalised_lines(F.col("text")).alias("x"))
    d = d.select("doc_id", "x", words(F.col("x")).alias("w"))
    pairs = lambda w, f: F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
                                    F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), f)
    joined = lambda a, b: F.concat_ws(" ", a, b)
    all_hashes = sorted({x for t in known for x in t[3]})
    constant = lambda h, kind="bigint": F.split(F.lit(",".join(map(str, h))), ",").cast(f"array<{kind}>")
    hits = F.array_intersect(constant(all_hashes), pairs(F.col("w"), lambda a, b: F.xxhash64(joined(a, b))))
    d = d.select("doc_id", "x", "w", hits.alias("hits"))
    # numbers of the templates of which the text has enough bigrams
    enough = [F.when((F.size("hits") >= k) & (F.size(F.array_intersect("hits", constant(h))) >= k), F.lit(i))
              for i, (k, (_, _, _, h, _)) in enumerate(zip(least, known))]
    d = d.select("doc_id", "x", "w", F.array_compact(F.array(*enough)).alias("c"))
    some = F.size("c") > 0
    line_units = F.transform(F.split("x", "\n"), lambda line, i: F.struct(i.alias("unit"), bigrams(words(line)).alias("b")))
    units = F.concat(F.array(F.struct(F.lit(-1).alias("unit"), bigrams(F.col("w")).alias("b"))), line_units)
    # a line has a bigram if words stand at both sides of a space
    n_units = (F.size(F.filter(F.split("x", "\n"), lambda line: line.rlike("[^ ] +[^ ]"))) + (F.size("w") > 1).cast("int"))
    chosen = F.transform("c", lambda i: F.struct(
        F.get(F.array(*[F.lit(t[0]) for t in known]), i).alias("id"),
        F.get(F.array(*[F.lit(k) for k in least]), i).alias("least"),
        F.get(F.array(*[F.lit((t[1] - 1) * (200 - percent) // percent) for t in known]), i).alias("longest"),
        F.get(F.array(*[_strings(t[2]) for t in known]), i).alias("b"),
        F.get(F.array(*[constant(t[4], "int") for t in known]), i).alias("slots")))
    d = d.select("doc_id", n_units.cast("long").alias("n_units"),
                 F.when(some, F.filter(units, lambda u: F.size(u["b"]) > 0)).alias("u"),
                 F.when(some, pairs(F.col("w"), joined)).alias("g"), F.when(some, chosen).alias("t"))

    def match(t: Column, size: Column, shared: Column, unit: Column, start: Column, n_words: Column) -> Column:
        """(rank, id, unit, start, words) of a comparison that reaches ``percent``, else null: smaller is better."""
        n = size + F.size(t["b"])
        return F.when(200 * shared >= percent * n, F.struct(
            (-F.round(2.0 * shared / n, 6)).alias("rank"), t["id"].alias("id"), unit.alias("unit"),
            start.alias("start"), n_words.alias("words")))

    none = F.lit(None).cast("int")
    no_match = F.lit(None).cast("struct<rank: double, id: string, unit: int, start: int, words: int>")

    def compare(u: Column, t: Column) -> Column:
        n, k = F.size(u["b"]), F.size(t["b"])
        return F.when(percent * (n + k) <= 200 * F.least(n, k), match(
            t, n, F.size(F.array_intersect(u["b"], t["b"])), u["unit"], none, none))

    def held(t: Column, x: Column) -> Column:
        """Whether ``x`` is a bigram of the template."""
        slot = F.pmod(F.xxhash64(x), F.size(t["b"])).cast("int")
        first = F.get(t["slots"], slot)
        return F.array_contains(F.slice(t["b"], first + 1, F.get(t["slots"], slot + 1) - first), x)

    # the positions before and after each bigram of the text where it stands too (-1 and the size: nowhere)
    order = F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    d = d.select("doc_id", "n_units", "u", "t", "g", order.alias("o"))
    beside = lambda o, j, other: F.when(F.get("o", j)["x"] == o["x"], F.get("o", j)["i"]).otherwise(other)
    d = d.select("doc_id", "n_units", "u", "t", "g", F.sort_array(F.transform("o", lambda o, j: F.struct(
        o["i"].alias("i"), beside(o, j - 1, F.lit(-1)).alias("before"), beside(o, j + 1, F.size("o")).alias("after")))).alias("e"))
    before, after = (lambda i: F.get("e", i)["before"]), (lambda i: F.get("e", i)["after"])
    # which of the text's bigrams are the template's, and the positions of those
    places = F.transform("t", lambda t: F.struct(t.alias("t"), F.transform("g", lambda x: held(t, x)).alias("hit")))
    marked = F.transform("s", lambda s: s.withField("p", F.filter(
        F.transform(s["hit"], lambda y, i: F.when(y, i)), lambda i: i.isNotNull())))

    def passages(s: Column) -> Column:
        """The template's best passage of all that may be it."""
        t, p, hit, size = s["t"], s["p"], s["hit"], F.size("g")
        longest = t["longest"]
        at = lambda i: F.coalesce(F.get(hit, i), F.lit(False))
        one = lambda y: y.cast("int")
        state = lambda n, shared, best: F.struct(n.alias("n"), shared.alias("shared"), best.alias("best"))
        empty = state(F.lit(0), F.lit(0), no_match)
        # beginnings of stretches with enough of the template's bigrams within its longest passage
        starts = F.filter(F.transform(p, lambda x, a: F.when(
            ~at(x - 1) & (F.get(p, a + t["least"] - 1) < x + longest), x)), lambda x: x.isNotNull())

        def from_start(first: Column) -> Column:
            """The best passage from there to the end of a stretch: distinct bigrams are counted as they come by."""
            def step(s: Column, i: Column) -> Column:
                new = before(i) < first
                n, shared = s["n"] + one(new), s["shared"] + one(new & at(i))
                ends = at(i) & ~at(i + 1)
                return state(n, shared, F.when(ends, F.least(s["best"], match(
                    t, n, shared, F.lit(-2), first, i - first + 2))).otherwise(s["best"]))

            return F.aggregate(F.sequence(first, F.least(first + longest, size) - 1), empty, step, lambda s: s["best"])

        # passages of the greatest length that it stops inside a stretch: one window, moved along the text
        stops = lambda x: at(x) & at(x + longest - 1) & (at(x - 1) | at(x + longest))

        def move(s: Column, x: Column) -> Column:
            out, come = after(x) >= x + longest, F.coalesce(before(x + longest) <= x, F.lit(False))
            best = F.when(stops(x), F.least(s["best"], match(t, s["n"], s["shared"], F.lit(-2), x, longest + 1)))
            return state(s["n"] - one(out) + one(come), s["shared"] - one(out & at(x)) + one(come & at(x + longest)),
                         best.otherwise(s["best"]))

        window = F.aggregate(F.sequence(F.lit(0), longest - 1), empty, lambda s, i: state(
            s["n"] + one(before(i) < 0), s["shared"] + one((before(i) < 0) & at(i)), s["best"]))
        stopped = F.when((longest > 1) & F.exists(p, stops), F.aggregate(
            F.sequence(F.lit(0), size - longest), window, move, lambda s: s["best"]))
        return F.array_min(F.concat(F.transform(starts, from_start), F.array(stopped)))

    d = d.select("doc_id", "n_units", "g", "e", F.transform(
        "u", lambda u: F.array_compact(F.transform("t", lambda t: compare(u, t)))).alias("m"), places.alias("s"))
    d = d.select("doc_id", "n_units", "g", "e", "m", marked.alias("s"))
    d = d.select("doc_id", "n_units", "m", F.array_compact(F.transform("s", passages)).alias("q"))
    better = F.filter("q", lambda q: ~F.exists(F.flatten("m"), lambda m: (m["id"] == q["id"]) & (m["rank"] <= q["rank"])))
    d = d.select("doc_id", "n_units", F.concat(F.filter(F.transform("m", lambda m: F.array_min(m)), lambda m: m.isNotNull()),
                                               better).alias("m"))
    d = d.select("doc_id", "n_units", F.coalesce(F.size("m"), F.lit(0)).alias("n"), F.array_min("m").alias("top"))
    top = F.col("top")
    return d.select("doc_id", "n_units", F.greatest("n", F.lit(0)).cast("long").alias("n_matched"), top["id"].alias("license"),
                    (-top["rank"]).alias("dice"), top["unit"].alias("unit"),
                    top["start"].alias("passage_start"), top["words"].alias("passage_words"))


def normalised_lines(text: Column) -> Column:
    """:func:`normalised` for each ``\\n``-split line at once; lines stay lines."""
    plain = F.regexp_replace(F.lower(text_or_empty(text)), "[^a-z0-9\n]+", " ")
    return F.replace(plain, F.lit("licence"), F.lit("license"))
