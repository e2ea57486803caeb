"""Reading physical plans (what ``explain`` prints), for checks and tuning."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

# Operators that would mean a plan left the JVM or paired rows without a key.
SLOW_OPERATORS = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                  "BroadcastNestedLoopJoin")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def pushed_filters(plan: str) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*)\]", plan)


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*>)", plan)


def slow_operators(plan: str) -> list[str]:
    return [op for op in SLOW_OPERATORS if op in plan]


def scan_ancestors(plan: str, table_file: str) -> list[str]:
    """Operator names from the scan of ``table_file`` up to the root of a
    ``formatted`` plan (nearest first)."""
    tree, _, details = plan.partition("\n\n\n")
    ids = re.findall(r"\((\d+)\) Scan \w+\s*\n(?:.*\n)*?Location: .*?" + re.escape(table_file),
                     details)
    lines = tree.splitlines()
    for i, line in enumerate(lines):
        m = re.search(r"Scan \w+\s*\((\d+)\)", line)
        if not (m and m.group(1) in ids):
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        chain = []
        for above in reversed(lines[:i]):
            d = len(above) - len(above.lstrip(" :+-"))
            if d < depth:
                chain.append(re.sub(r"\s*\(\d+\)$", "", above.strip(" :+-")))
                depth = d
        return chain
    return []
