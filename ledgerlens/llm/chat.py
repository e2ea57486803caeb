"""Chat formatting in budgeted windows (operator 8), DataFrame functions only.

A conversation becomes training windows: turn-aligned spans chosen on prefix
sums of turn tokens, each opened by the system turn and a little repeated
history, with a loss mask on the assistant turns that no window had before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm._tables import pick, text_or_empty

# Marks of the template.
BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Tokens (words) a window may hold, repeated turns included.
BUDGET = 512
#: Turns repeated at most, and the tokens they may take together.
HISTORY_TURNS, HISTORY_TOKENS = 2, 128
#: Tokens the marks and role of a turn count for.
TURN_TOKENS = 4
#: A conversation is handled in stretches of so many turns: what one row gathers, besides the neighbours' edges.
STRETCH = 256

_TURN = "struct<turn:bigint,role:string,text:string>"


def escape(col: Column) -> Column:
    r"""Text without control strings, reversibly: ``\`` to ``\s``, then ``<|`` to ``<\p``."""
    return F.replace(F.replace(col, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\p"))


def unescape(col: Column) -> Column:
    return F.replace(F.replace(col, F.lit("<\\p"), F.lit("<|")), F.lit("\\s"), F.lit("\\"))


def escape_role(col: Column) -> Column:
    r"""As :func:`escape`; a line break, which would end the role, becomes ``\n`` spelt out."""
    return F.replace(escape(col), F.lit("\n"), F.lit("\\n"))


def unescape_role(col: Column) -> Column:
    return unescape(F.replace(col, F.lit("\\n"), F.lit("\n")))


def turn_tokens(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")) + TURN_TOKENS


def format_turn(turn: Column) -> Column:
    return F.concat(F.lit(BEGIN), escape_role(turn["role"]), F.lit("\n"), escape(turn["text"]), F.lit(END + "\n"))


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
                 history_tokens: int = HISTORY_TOKENS, stretch: int = STRETCH) -> DataFrame:
    """Windows of ``conversations`` (conv_id, turn, role, text; a row per turn).

    Returns conv_id, stretch, window (from 0 in the stretch), text, n_repeated
    (leading turns that an earlier window had), n_new, n_tokens and loss, the
    0-based character spans (start, length) of the assistant texts among the
    new turns.

    Turns go by (turn, role, text), nulls first.  A window takes turns while
    the system turn, the repeated history and the new turns fit ``budget``.
    The system turn is the conversation's first with role "system"; it opens
    every later window.  History is the longest run of up to ``history_turns``
    turns before the window with at most ``history_tokens`` tokens; it gives
    way if it leaves no room for the window's first new turn.  A single turn
    over the budget is a window of its own, never cut.

    A conversation is dealt over rows of ``stretch`` turns, counted densely
    whatever the turn numbers, which do not alter its windows: a stretch has
    the last turns of the one before as history and the first of the next, as
    many as a window can reach, and tells for every turn at which a window may
    enter it where the first window after it begins.  Following these tables
    from the first stretch on gives each its first window.  ``stretch`` in the
    result is the one in which the window begins.  A row holds the tables of
    its conversation's earlier stretches, ``budget / TURN_TOKENS`` numbers each.

    Null text and role are empty.  Null conv_ids are one conversation, null
    turns come first.  Repeated rows are turns like any other.  An empty table
    gives an empty result.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), text_or_empty(F.col("role")).alias("role"),
        text_or_empty(F.col("text")).alias("text"))
    reach = budget // TURN_TOKENS + 1  # turns that a window may have, and one
    stretch = max(stretch, reach, history_turns)
    turn = F.struct("turn", "role", "text")
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = rows.select(
        "*", (F.row_number().over(so_far) - 1).cast("long").alias("i"),
        F.first(F.when(F.col("role") == "system", turn), ignorenulls=True).over(so_far).alias("system"))
    shares = F.sequence(F.expr(f"greatest(0L, (i - {reach}) DIV {stretch})"), F.expr(f"(i + {history_turns}) DIV {stretch}"))
    d = d.select("conv_id", F.explode_outer(shares).alias("stretch"), F.struct("i", "turn", "role", "text").alias("x"), "system")
    d = d.groupBy("conv_id", "stretch").agg(F.sort_array(F.collect_list("x")).alias("t"), F.min("system").alias("system"))
    first = F.element_at("t", 1)["i"]
    d = d.select("conv_id", "stretch", "system", F.transform("t", lambda x: x.dropFields("i")).alias("t"),
                 (F.col("stretch") * stretch - first).cast("int").alias("own"),
                 F.least(F.size("t"), ((F.col("stretch") + 1) * stretch - first).cast("int")).alias("own_end"))
    d = d.filter("own < own_end")  # turns of its own, not only history

    # p[i]: tokens of the first i turns
    p = F.aggregate("t", F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + turn_tokens(x["text"]))))
    d = d.select("conv_id", "stretch", "t", "system", "own", "own_end", p.alias("p"),
                 F.coalesce(turn_tokens(F.col("system.text")), F.lit(0)).alias("lead"))

    def lead(j: Column) -> Column:
        """Tokens of the system turn if a window that starts at turn j repeats it."""
        return F.when(F.col("system") < F.get("t", j), F.col("lead")).otherwise(0)

    def history(j: Column) -> Column:
        """How many turns before j a window that starts there repeats."""
        options = []
        for h in range(history_turns, 0, -1):
            tokens = F.get("p", j) - F.get("p", j - h)
            after_system = F.coalesce((F.col("system") >= F.get("t", j)) | (F.get("t", j - h) > F.col("system")), F.lit(True))
            fits = (j >= h) & (tokens <= history_tokens) & after_system
            fits &= lead(j) + F.get("p", j + 1) - F.get("p", j - h) <= budget
            options.append(F.when(fits, F.lit(h)))
        return F.coalesce(*options, F.lit(0))

    back = F.transform("t", lambda x, j: F.struct(history(j).alias("turns"), lead(j).alias("lead")))
    d = d.select("*", back.alias("h"))

    def following(j: Column) -> Column:
        """Where the window that starts at turn j ends: every further turn takes tokens, so those that fit are counted."""
        room = budget - F.get("h", j)["lead"] + F.get("p", j - F.get("h", j)["turns"])
        return F.when((j >= F.col("own")) & (j < F.col("own_end")),
                      j + 1 + F.size(F.filter(F.slice("p", j + 3, reach), lambda x: x <= room)))

    d = d.select("*", F.transform("t", lambda x, j: following(j)).alias("next"))
    steps = F.sequence(F.lit(1), F.col("own_end") - F.col("own"))

    def leave(j: Column) -> Column:
        """The first start behind the stretch of the windows from j on."""
        return F.aggregate(steps, j, lambda at, _: F.when(at < F.col("own_end"), F.get("next", at)).otherwise(at))

    entries = F.sequence(F.lit(0), F.when(F.col("stretch") > 0, F.lit(reach - 1)).otherwise(F.lit(0)))
    table = F.when(F.size("t") > F.col("own_end"), F.transform(
        entries, lambda e: leave(e + F.col("own")) - F.col("own_end"))).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("table", table)
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("tables", F.collect_list("table").over(before))
    entry = F.aggregate("tables", F.lit(0), lambda e, x: F.get(x, e))
    d = d.withColumn("enter", F.col("own") + entry)

    def step(starts: Column, _: Column) -> Column:
        then = F.get("next", F.element_at(starts, -1))
        return F.when(then < F.col("own_end"), F.concat(starts, F.array(then))).otherwise(starts)

    d = d.withColumn("starts", F.aggregate(steps, F.array("enter"), step)).drop("table", "tables")
    d = d.select("*", F.posexplode_outer("starts").alias("window", "s"))
    d = d.filter("s < own_end")  # not so if a window of an earlier stretch has all its turns
    d = d.withColumn("e", F.get("next", F.col("s")))
    d = d.withColumn("back", F.get("h", F.col("s"))["turns"]).withColumn("lead", F.get("h", F.col("s"))["lead"])
    opening = F.when(F.col("lead") > 0, F.array("system")).otherwise(F.array().cast(f"array<{_TURN}>"))
    d = d.select(
        "conv_id", "stretch", "window", (F.size(opening) + F.col("back")).alias("n_repeated"),
        (F.col("e") - F.col("s")).alias("n_new"),
        (F.col("lead") + F.get("p", F.col("e")) - F.get("p", F.col("s") - F.col("back"))).alias("n_tokens"),
        F.concat(opening, F.slice("t", F.col("s") - F.col("back") + 1, F.col("e") - F.col("s") + F.col("back"))).alias("turns"))
    d = d.withColumn("pieces", F.transform("turns", format_turn))

    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("out"))

    def mask(a: Column, i: Column) -> Column:
        x, piece = F.get("turns", i), F.get("pieces", i)
        length = F.length(escape(x["text"]))
        start = a["at"] + F.length(piece) - len(END) - 1 - length
        span = F.struct(start.alias("start"), length.alias("length"))
        target = (x["role"] == "assistant") & (i >= F.col("n_repeated"))
        return F.struct((a["at"] + F.length(piece)).alias("at"),
                        F.when(target, F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    loss = F.aggregate(F.sequence(F.lit(0), F.size("turns") - 1), state, mask, lambda a: a["out"])
    return d.select("conv_id", "stretch", "window", F.array_join("pieces", "").alias("text"), "n_repeated", "n_new",
                    "n_tokens", loss.alias("loss"))


def read_turns(text: Column) -> Column:
    """The (role, text) turns of a formatted window, in order."""
    def one(piece: Column) -> Column:
        cut = F.position(F.lit("\n"), piece)
        body = F.substring(piece, cut + 1, F.length(piece) - cut - len(END) - 1)
        return F.struct(unescape_role(F.substring(piece, F.lit(1), cut - 1)).alias("role"), unescape(body).alias("text"))

    pieces = F.split(text, r"<\|im_start\|>")
    return F.transform(F.slice(pieces, 2, F.size(pieces) - 1), one)


def masked_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between its spans."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(text, s["start"] + 1, s["length"]))), "")


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation what its windows hold, read back from their texts and masks.

    conv_id, n_turns, turns_sha256 (role, \\n, text, \\n of every new turn in
    order), loss_chars, loss_sha256 (all masked text), formatted_chars and
    n_windows.
    """
    new = F.filter(read_turns(F.col("text")), lambda x, i: i >= F.col("n_repeated"))
    told = F.array_join(F.transform("new", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    d = windows.select("conv_id", "stretch", "window", F.length("text").cast("long").alias("chars"), new.alias("new"),
                       masked_text(F.col("text"), F.col("loss")).alias("loss"))
    d = d.select("conv_id", F.struct("stretch", "window", F.size("new").alias("n"), told.alias("told"), "loss", "chars").alias("w"))
    d = d.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"))
    join = lambda c: F.array_join(F.transform("w", lambda w: w[c]), "")
    total = lambda c: F.aggregate("w", F.lit(0).cast("long"), lambda a, w: a + w[c])
    return d.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(join("told"), 256).alias("turns_sha256"),
        F.length(join("loss")).cast("long").alias("loss_chars"), F.sha2(join("loss"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"), F.size("w").cast("long").alias("n_windows"))
