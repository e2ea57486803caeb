"""Windows of long conversations and of sparse turn numbers, against a version that walks turn by turn."""

import random
from collections import defaultdict

from ledgerlens.llm import chat


def brute_windows(rows, budget=512, most=2, most_tokens=128):
    """{conv_id: [(n_repeated, n_new, n_tokens, first new text)]} in order."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        order = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])
        size = [len(x[2].split()) + 4 for x in turns]
        system = next((x for x in turns if x[1] == "system"), None)
        windows, s = [], 0
        while s < len(turns):
            lead = len(system[2].split()) + 4 if system and order(system) < order(turns[s]) else 0
            back = 0
            for h in range(most, 0, -1):
                if (s >= h and sum(size[s - h:s]) <= most_tokens and lead + sum(size[s - h:s + 1]) <= budget
                        and (not system or order(system) >= order(turns[s]) or order(turns[s - h]) > order(system))):
                    back = h
                    break
            e = s + 1
            while e < len(turns) and lead + sum(size[s - back:e + 1]) <= budget:
                e += 1
            windows.append((bool(lead) + back, e - s, lead + sum(size[s - back:e]), turns[s][2]))
            s = e
        out[c] = windows
    return out


def conversation(conv, n, numbers, seed, system=True):
    pick = random.Random(seed)
    text = lambda i: " ".join([f"t{conv}-{i}"] + ["w"] * pick.choice([0, 0, 1, 5, 30, 60, 120, 130, 600 if pick.random() < .1 else 9]))
    return [(conv, numbers(i), "system" if system and i == n // 9 else ("user", "assistant")[i % 2], text(i)) for i in range(n)]


def test_stretch_edges_do_not_alter_windows(spark):
    rows = [*conversation(1, 1500, lambda i: i, 1), *conversation(2, 700, lambda i: 1000 * i - 9000, 2),
            *conversation(3, 300, lambda i: 1_700_000_000_000 + 61_000 * i, 3, False), *conversation(4, 257, lambda i: i, 4),
            *conversation(5, 5, lambda i: 1000 * i, 5), *conversation(None, 600, lambda i: None if i < 3 else 7 * i, 6),
            *((6, i, "user", "") for i in range(900)), *((7, 0, "assistant", "same") for _ in range(600))]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    for stretch in (1, chat.STRETCH, 100_000):
        got = defaultdict(list)
        w = chat.chat_windows(d, stretch=stretch)
        for r in w.orderBy("conv_id", "stretch", "window").collect():
            turn = r["text"].split(chat.BEGIN)[1 + r["n_repeated"]]
            text = turn.split("\n", 1)[1].removesuffix(chat.END + "\n")
            got[r["conv_id"]].append((r["n_repeated"], r["n_new"], r["n_tokens"], text))
        assert got == brute_windows(rows)
