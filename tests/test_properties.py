"""Randomised checks: the sales operators against plain-Python brute force.

Hypothesis draws small sales tables with nulls in every column, ties and
missing years; each operator runs on the plain frame and on a Lookup (with
and without eager aggregation) and must equal the brute-force answer.
"""

import datetime as dt
import math
from collections import defaultdict
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.operators import (
    Lookup,
    busiest_month,
    category_mix,
    flag_share,
    top_groups_by_avg,
    value_spread,
    yoy_change,
)

CUSTOMERS = {1: "A", 2: "A", 3: "B", 4: None}      # customer 5 has no lookup row
row = st.tuples(
    st.sampled_from([1, 2, 3, 4, 5, None]),                    # customer
    st.one_of(st.none(), st.integers(0, 40).map(lambda x: x * 2.5)),  # price
    st.one_of(st.none(), st.tuples(st.integers(2010, 2013), st.integers(1, 12))),  # (year, month)
    st.sampled_from(["D", "F", None]),                         # type
    st.sampled_from(["Y", "N", None]),                         # flag
    st.one_of(st.none(), st.integers(0, 3)),                   # id
)
tables = st.lists(row, min_size=1, max_size=25)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def county(cust):
    return CUSTOMERS.get(cust) if cust is not None else None


def sources(spark, rows):
    fact = spark.createDataFrame(
        [(c, p, dt.datetime(d[0], d[1], 10) if d else None, t, f, None if i is None else str(i))
         for c, p, d, t, f, i in rows],
        "cust long, price double, date timestamp_ntz, property_type string, "
        "new_property string, transaction_id string")
    table = spark.createDataFrame(list(CUSTOMERS.items()), "c_custkey long, county string")
    look = Lookup(fact, "cust", table, "c_custkey")
    return [look.rows(), replace(look, eager=True), replace(look, eager=False)]


def close(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def same(got, want):
    key = lambda r: tuple((x is None, repr(x)) for x in r[:2])
    got, want = sorted(got, key=key), sorted(want, key=key)
    return len(got) == len(want) and all(
        len(g) == len(w) and all(close(x, y) for x, y in zip(g, w)) for g, w in zip(got, want))


def avg(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) / len(xs) if xs else None


@pytest.fixture(scope="module")
def sp(spark):
    return spark


@SETTINGS
@given(tables)
def test_value_spread(sp, rows):
    groups = defaultdict(list)
    for c, p, _, t, _, _ in rows:
        groups[(county(c), t)].append(p)
    want = []
    for (k, t), ps in groups.items():
        vals = [p for p in ps if p is not None]
        want.append((k, t, max(vals) - min(vals) if vals else None))
    for src in sources(sp, rows):
        got = [tuple(r) for r in value_spread(src, ordered=False).collect()]
        assert same(got, want)


@SETTINGS
@given(tables)
def test_flag_share(sp, rows):
    groups = defaultdict(lambda: [0, 0])
    for c, _, _, _, f, _ in rows:
        k = county(c)
        groups[k][0] += k is not None
        groups[k][1] += f == "Y"
    want = [(k, n, (y / n * 100.0) if n else None) for k, (n, y) in groups.items()]
    for src in sources(sp, rows):
        got = [tuple(r) for r in flag_share(src, "county", F.col("new_property") == "Y",
                                            ordered=False).collect()]
        assert same(got, want)


@SETTINGS
@given(tables)
def test_category_mix(sp, rows):
    n = defaultdict(int)
    for c, _, _, t, _, _ in rows:
        n[(county(c), t)] += 1
    tot = defaultdict(int)
    for (k, _), v in n.items():
        tot[k] += v
    want = [(k, t, v, tot[k], round(v / tot[k] * 100 + 1e-12, 2)) for (k, t), v in n.items()]
    for src in sources(sp, rows):
        assert same([tuple(r) for r in category_mix(src).collect()], want)


@SETTINGS
@given(tables)
def test_top_groups_by_avg(sp, rows):
    groups = defaultdict(list)
    for c, p, *_ in rows:
        groups[county(c)].append(p)
    ranked = sorted(((k, avg(ps)) for k, ps in groups.items()),
                    key=lambda kv: (kv[1] is None, -(kv[1] or 0), kv[0] is not None, kv[0] or ""))
    for src in sources(sp, rows):
        got = [tuple(r) for r in top_groups_by_avg(src, "county", "price", k=2).collect()]
        assert len(got) == min(2, len(ranked))
        assert all(g[0] == w[0] and close(g[1], w[1]) for g, w in zip(got, ranked))


@SETTINGS
@given(tables)
def test_busiest_month(sp, rows):
    groups = defaultdict(lambda: defaultdict(list))
    for c, p, d, _, _, i in rows:
        if d and d[0] == 2011:
            groups[county(c)][d[1]].append((i, p))
    want = []
    for k, months in groups.items():
        best = min(months, key=lambda m: (-sum(i is not None for i, _ in months[m]), m))
        items = months[best]
        want.append((k, str(best), dt.date(2000, best, 1).strftime("%B"),
                     sum(i is not None for i, _ in items), avg([p for _, p in items])))
    for src in sources(sp, rows):
        assert same([tuple(r) for r in busiest_month(src, year=2011).collect()], want)


@SETTINGS
@given(tables, st.booleans())
def test_yoy_change(sp, rows, strict):
    groups = defaultdict(lambda: defaultdict(list))
    for c, p, d, *_ in rows:
        if d and 2011 <= d[0] <= 2012 + 1:
            groups[county(c)][d[0]].append(p)
    want = []
    for k, years in groups.items():
        prev_year, prev = None, None
        for y in sorted(years):
            a = avg(years[y])
            use = prev if (not strict or prev_year == y - 1) else None
            if prev_year is None:
                use = None
            change = a - use if a is not None and use is not None else None
            pct = (round(change / use * 100 + 1e-12, 2)
                   if change is not None and use not in (None, 0) else None)
            want.append((k, y, a, y - 1, use, change, pct))
            prev_year, prev = y, a
    for src in sources(sp, rows):
        got = [tuple(r) for r in yoy_change(src, start=2011, end=2013, strict_gap=strict,
                                            ordered=False).collect()]
        assert same(got, want)
