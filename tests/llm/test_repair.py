"""Conversation repair against a row-by-row table and, for tiny inputs, all edit strings."""

import itertools
import random

import brute
import pytest
from support import result, rows  # noqa: F401

from ledgerlens.llm import repair

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def by_conversation(df):
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df}
    assert len(got) == len(df)
    return got


def test_op11(rows, result):
    got = result("op11_repair_conversations")
    assert by_conversation([r for r in got]) == brute.repair(rows("conversations", "conv_id", "turn", "role", "text"))


def test_search_equals_table():
    random.seed(3)
    for _ in range(1500):
        n = random.randrange(9)
        turns = [(i, random.choice(["user", "assistant", "system", "tool", ""]), random.choice(["a.", "b", "", "c?", "c?"]))
                 for i in range(n)]
        want = brute.repair_one(turns)
        seen, faulty = set(), []
        for _, role, text in turns:
            faulty.append((role[:1], repair._fault(text, (role, text) in seen)))
            seen.add((role, text))
        assert repair.search(faulty, repair.NOTHING, repair.ENDS) == want[5:7]


def test_search_equals_all_edit_strings():
    random.seed(4)
    for _ in range(60):
        turns = [(random.choice("usat"), random.randrange(4)) for _ in range(random.randrange(4))]
        options = []
        for size in range(7):
            for audit in map("".join, itertools.product("DIKR", repeat=size)):
                at, state, cost = 0, 0, 0
                for edit in audit:
                    steps = {e: (c, to) for e, c, to in repair._edits_from(turns, (at, state))}
                    if edit not in steps:
                        break
                    more, (at, state) = steps[edit]
                    cost += more
                else:
                    if at == len(turns) and state in repair.ENDS:
                        options.append((cost, audit))
        assert repair.search(turns, repair.NOTHING, repair.ENDS) == min(options)


def conversations(spark):
    random.seed(5)
    out = []
    for c in [*range(40), None]:
        for t in range(random.randrange(1, 14)):
            out.append((c, random.choice([t, t, t, None, 3]), random.choice(["user", "assistant", "system", "tool", "", None]),
                        random.choice(["yes.", "no", "", " \t", None, "Why? Because", "é!"])))
    out += [(99, t, ("user", "assistant")[t % 2], f"text {t % 70}.") for t in range(700)]  # one long conversation
    out += out[:30]  # repeated rows
    return out


@pytest.mark.parametrize("stretch", [2, 128])
def test_odd_rows(spark, stretch):
    turns = conversations(spark)
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, TEXT string, own int")
    assert by_conversation(repair.repair_report(df, stretch).collect()) == brute.repair(turns)


def test_empty_and_dropped(spark):
    schema = "conv_id string, turn long, role string, text string"
    assert repair.repair_report(spark.createDataFrame([], schema)).collect() == []
    gone = next(str(i) for i in range(200) if __import__("zlib").crc32(f"{i}:0".encode()) % 20 == 0)
    got = repair.repair_report(spark.createDataFrame([(gone, 0, "user", "a.")], schema)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", brute.sha(""))]
