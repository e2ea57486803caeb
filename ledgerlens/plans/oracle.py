"""The registered queries as plain SQL over the driver's tables (DuckDB dialect).

These are the independent statement of each query's meaning: they follow
the original jobs' shape (e.g. the enrichment joins every incident with
every sale and counts distinct incidents) rather than our plans.
"""

from __future__ import annotations

from ledgerlens.plans import queries as Q
from ledgerlens.plans import views as V

HOUSE = """house AS (
  SELECT o.o_orderkey AS transaction_id,
         o.o_totalprice AS price,
         o.o_orderdate AS date,
         o.o_custkey AS postcode,
         o.o_orderpriority AS property_type,
         CASE WHEN o.o_orderstatus = 'F' THEN 'Y'
              WHEN o.o_orderstatus IS NOT NULL THEN 'N' END AS new_property,
         n.n_name AS town,
         n.n_name AS county
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def _r(expr: str, digits: int = Q.DIGITS) -> str:
    """Half-up rounding of a double, as ``stable_round`` does it."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def _hours(text: str) -> int:
    n, unit = text.split()
    assert unit.startswith("hour")
    return int(n) * 3600 * 1_000_000


def _windows(source: str, size: str, slide: str) -> str:
    """Every (row, sliding window) pair: windows of ``size`` starting at
    multiples of ``slide`` since the epoch that contain ``ts``."""
    s, l = _hours(size), _hours(slide)
    n = -(-s // l)
    return f"""(SELECT e.*, make_timestamp(b.s_us) AS start, make_timestamp(b.s_us + {s}) AS "end"
  FROM (SELECT *, epoch_us(ts) AS us FROM {source}) e,
  LATERAL (SELECT ((e.us // {l}::BIGINT) - k) * {l}::BIGINT AS s_us FROM range(0, {n}) t(k)) b
  WHERE b.s_us + {s} > e.us)"""


def _year_range(first: int, last: int) -> str:
    return f"date >= TIMESTAMP '{first}-01-01' AND date < TIMESTAMP '{last + 1}-01-01'"


def _yoy(strict: bool) -> str:
    prev = "lag(avg_price) OVER (PARTITION BY county ORDER BY year)"
    if strict:
        prev = (f"CASE WHEN lag(year) OVER (PARTITION BY county ORDER BY year) = year - 1 "
                f"THEN {prev} END")
    return f"""WITH {HOUSE},
y AS (SELECT county, CAST(year(date) AS INTEGER) AS year, avg(price) AS avg_price
      FROM house WHERE {_year_range(*Q.YEAR_RANGE)} GROUP BY county, year(date)),
l AS (SELECT county, year, avg_price, year - 1 AS previous_year, {prev} AS prev FROM y)
SELECT county, year, {_r('avg_price')} AS avg_price, previous_year,
       {_r('prev')} AS prev_year_avg_price,
       {_r('avg_price - prev')} AS price_change,
       CASE WHEN prev = 0 THEN NULL
            ELSE {_r('(avg_price - prev) / prev * 100.0', 2)} END AS percentage_change
FROM l"""


def _spot(key: str) -> tuple[str, str]:
    step = f"CAST({V.SPOT_STEP} AS DOUBLE)"
    return (f"CAST({key} % {V.SPOT_COLUMNS} AS DOUBLE) * {step}",
            f"CAST({key} // {V.SPOT_COLUMNS} AS DOUBLE) * {step}")


def _offset(key: str, spec: tuple[int, int, float]) -> str:
    modulus, shift, step = spec
    return f"CAST({key} % {modulus} - {shift} AS DOUBLE) * CAST({step} AS DOUBLE)"


def _locate() -> str:
    """Nearest postcode within the radius by brute force: every pair closer
    than twice the radius per axis, exact distance, first by (distance, key)."""
    px, py = _spot("user_id")
    rx, ry = _spot("c_custkey")
    radius = f"CAST({Q.LOCATE_RADIUS} AS DOUBLE)"
    return f"""WITH p AS (SELECT event_id AS crime_id,
                  {px} + {_offset('event_id', V.OFFSET_X)} AS longitude,
                  {py} + {_offset('event_id', V.OFFSET_Y)} AS latitude FROM events),
r AS (SELECT CAST(c_custkey AS VARCHAR) AS postcode, {rx} AS x, {ry} AS y FROM customer),
c AS (SELECT p.crime_id, r.postcode,
             sqrt((r.x - p.longitude) * (r.x - p.longitude)
                  + (r.y - p.latitude) * (r.y - p.latitude)) AS d
      FROM p JOIN r ON r.x BETWEEN p.longitude - 2 * {radius} AND p.longitude + 2 * {radius}
                   AND r.y BETWEEN p.latitude - 2 * {radius} AND p.latitude + 2 * {radius}),
b AS (SELECT crime_id, postcode, d,
             row_number() OVER (PARTITION BY crime_id ORDER BY d, postcode) AS rk
      FROM c WHERE d <= {radius})
SELECT p.crime_id, {_r('p.longitude')} AS longitude, {_r('p.latitude')} AS latitude,
       b.postcode, {_r('b.d')} AS distance
FROM p LEFT JOIN b ON p.crime_id = b.crime_id AND b.rk = 1"""


def oracle_sql() -> dict[str, str]:
    top_w = _windows("events", *Q.TOP_TYPE_WINDOW)
    count_w = _windows("events", *Q.TYPE_COUNT_WINDOW)
    alarm_w = _windows(f"(SELECT * FROM events WHERE event_type = '{Q.ALARM_TYPE}')",
                       *Q.TOP_TYPE_WINDOW)
    enrich_w = _windows("(SELECT * FROM events WHERE user_id IS NOT NULL)", *Q.ENRICH_WINDOW)
    # append mode: the windows that end no later than the watermark, an hour behind the newest event
    closed = f"""WITH w AS {count_w}
SELECT start, "end", event_type AS crime_type, count(*) AS crime_count FROM w
WHERE "end" <= (SELECT max(ts) FROM events) - INTERVAL {Q.WATERMARK.split()[0]} HOUR
GROUP BY start, "end", event_type"""
    return {
        "top_groups_by_avg": f"""WITH {HOUSE}
SELECT town, {_r('avg(price)')} AS avg_price FROM house GROUP BY town
ORDER BY avg(price) DESC NULLS LAST, town ASC NULLS FIRST LIMIT 10""",

        "monthly_counts": f"""WITH {HOUSE},
m AS (SELECT CAST(month(date) AS INTEGER) AS m FROM house WHERE {_year_range(Q.YEAR, Q.YEAR)})
SELECT CAST(m AS VARCHAR) AS month, count(*) AS count,
       monthname(make_date(2000, m, 1)) AS month_name
FROM m GROUP BY m""",

        "value_spread": f"""WITH {HOUSE}
SELECT county, property_type, {_r('max(price) - min(price)')} AS price_difference
FROM house GROUP BY county, property_type""",

        "yoy_change": _yoy(strict=False),
        "yoy_change_strict": _yoy(strict=True),

        "busiest_month": f"""WITH {HOUSE},
m AS (SELECT county, CAST(month(date) AS INTEGER) AS m,
             count(transaction_id) AS num_transactions, avg(price) AS avg_price
      FROM house WHERE {_year_range(Q.YEAR, Q.YEAR)} GROUP BY county, month(date)),
r AS (SELECT *, row_number() OVER (PARTITION BY county
                                   ORDER BY num_transactions DESC, m ASC) AS rk FROM m)
SELECT county, CAST(m AS VARCHAR) AS month, monthname(make_date(2000, m, 1)) AS month_name,
       num_transactions, {_r('avg_price')} AS avg_price
FROM r WHERE rk = 1""",

        "flag_share": f"""WITH {HOUSE}
SELECT county, count(county) AS total_count,
       CASE WHEN count(county) = 0 THEN NULL
            ELSE {_r("CAST(count(*) FILTER (WHERE new_property = 'Y') AS DOUBLE) / CAST(count(county) AS DOUBLE) * 100.0")}
       END AS percentage_new_properties
FROM house GROUP BY county""",

        "category_mix": f"""WITH {HOUSE},
c AS (SELECT county, property_type, count(*) AS num_of_type FROM house GROUP BY county, property_type)
SELECT county, property_type, num_of_type,
       CAST(sum(num_of_type) OVER (PARTITION BY county) AS BIGINT) AS total_num,
       {_r('CAST(num_of_type AS DOUBLE) / CAST(sum(num_of_type) OVER (PARTITION BY county) AS DOUBLE) * 100.0', 2)} AS percentage_of_type
FROM c""",

        "bottom_groups_by_median": f"""WITH {HOUSE}
SELECT county, quantile_disc(price, 0.5) AS median_price FROM house GROUP BY county
ORDER BY median_price ASC NULLS LAST, county ASC NULLS FIRST LIMIT 20""",

        "csv_decode": """SELECT ts AS "timestamp", event_id, user_id, event_type, value, props
FROM events""",

        "combine_shuffle": "SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier",

        "stream_passthrough": "SELECT event_id, user_id, event_type, value FROM events",

        "stream_top_type": f"""WITH w AS {top_w},
c AS (SELECT start, "end", event_type AS crime_type, count(*) AS crime_count
      FROM w GROUP BY start, "end", event_type)
SELECT * FROM c ORDER BY crime_count DESC, start, "end", crime_type ASC NULLS FIRST LIMIT 1""",

        "stream_top_type_per_window": f"""WITH w AS {top_w},
c AS (SELECT start, "end", event_type AS crime_type, count(*) AS crime_count
      FROM w GROUP BY start, "end", event_type),
r AS (SELECT *, row_number() OVER (PARTITION BY start, "end"
                                   ORDER BY crime_count DESC, crime_type ASC NULLS FIRST) AS rk FROM c)
SELECT start, "end", crime_type, crime_count FROM r WHERE rk = 1""",

        "stream_type_counts": f"""WITH w AS {count_w}
SELECT start, "end", event_type AS crime_type, count(*) AS crime_count
FROM w GROUP BY start, "end", event_type""",

        "stream_distinct_types": f"""WITH w AS {count_w}
SELECT start, "end", count(DISTINCT event_type) AS num_different_types
FROM w GROUP BY start, "end\"""",

        "stream_alarm_counts": f"""WITH w AS {alarm_w}
SELECT start, "end", count(event_type) AS crime_count,
       count(event_type) > {Q.ALARM_THRESHOLD} AS alarm
FROM w GROUP BY start, "end\"""",

        "stream_alarm": f"""WITH w AS {alarm_w}
SELECT start, "end", count(event_type) AS crime_count
FROM w GROUP BY start, "end" HAVING count(event_type) > {Q.ALARM_THRESHOLD}""",

        "stream_enriched": f"""WITH {HOUSE},
w AS {enrich_w},
j AS (SELECT w.start, w."end", w.user_id AS postcode, w.event_id, h.price
      FROM w JOIN house h ON w.user_id = h.postcode)
SELECT start, "end", postcode, {_r('avg(price)')} AS average_price,
       count(DISTINCT event_id) AS crime_count
FROM j GROUP BY start, "end", postcode""",

        "locate_incidents": _locate(),

        "pane_type_counts": f"""WITH w AS {top_w}
SELECT start, "end", event_type AS crime_type, count(*) AS crime_count
FROM w GROUP BY start, "end", event_type""",

        "pane_distinct_types": f"""WITH w AS {count_w}
SELECT start, "end", count(DISTINCT event_type) AS num_different_types
FROM w GROUP BY start, "end\"""",

        "bottom_medians_merged": f"""WITH {HOUSE}
SELECT county, quantile_disc(price, 0.5) AS median_price FROM house GROUP BY county
ORDER BY median_price ASC NULLS LAST, county ASC NULLS FIRST LIMIT 20""",

        "landed_monthly_counts": f"""WITH {HOUSE},
m AS (SELECT CAST(month(date) AS INTEGER) AS m FROM house WHERE {_year_range(Q.YEAR, Q.YEAR)})
SELECT CAST(m AS VARCHAR) AS month, count(*) AS count,
       monthname(make_date(2000, m, 1)) AS month_name
FROM m GROUP BY m""",

        "combine_folder": """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier""",

        "stream_append_counts": closed,
        "stream_replayed_counts": closed,

        "stream_alarm_once": f"""WITH w AS {alarm_w}
SELECT start, "end" FROM w GROUP BY start, "end" HAVING count(event_type) > {Q.ALARM_THRESHOLD}""",

        "stream_running_top": f"""WITH w AS {top_w},
c AS (SELECT start, "end", event_type AS crime_type, count(*) AS crime_count
      FROM w GROUP BY start, "end", event_type)
SELECT * FROM c ORDER BY crime_count DESC, start, "end", crime_type ASC NULLS FIRST LIMIT 1""",
    }
