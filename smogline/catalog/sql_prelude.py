"""SQL text of the fixture adapters, shared by the DuckDB oracles.

Each constant is one CTE body over the driver's views; ``with_ctes`` puts
the ones a query needs in front of its body.  These mirror
``smogline.sources.fixtures`` and ``smogline.plans.preprocess`` written as
plain ANSI SQL (DuckDB dialect), independent of the Spark code.
"""

from __future__ import annotations

import re

CTE = {}

CTE["geo"] = """
SELECT n.n_nationkey, r.r_name AS city
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""

CTE["readings"] = """
SELECT g.city, CAST(g.n_nationkey AS BIGINT) AS sensor_id, CAST(l.l_shipdate AS DATE) AS date,
       avg(l.l_extendedprice) / 1000 - 10 AS pm25_avg
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN geo g ON s.s_nationkey = g.n_nationkey
GROUP BY 1, 2, 3
"""

CTE["readings_sparse"] = """
SELECT g.city, CAST(g.n_nationkey AS BIGINT) AS sensor_id, CAST(o.o_orderdate AS DATE) AS date,
       avg(o.o_totalprice) / 1000 AS pm25_avg
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN geo g ON c.c_nationkey = g.n_nationkey
GROUP BY 1, 2, 3
"""

CTE["wday"] = """
SELECT CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS q, avg(l_discount) AS di,
       avg(l_tax) AS tx, avg(l_extendedprice) AS p
FROM lineitem GROUP BY 1
"""

CTE["spine"] = """
SELECT CAST(r.r_regionkey AS DOUBLE) AS rk, r.r_name AS city, CAST(d.d AS DATE) AS date
FROM region r,
     (SELECT unnest(generate_series((SELECT min(date) FROM wday), (SELECT max(date) FROM wday),
                                    INTERVAL 1 DAY)) AS d) d
"""

CTE["wjoin"] = """
SELECT s.date, s.city, s.rk,
       coalesce(w.q, 25.0) AS q, coalesce(w.di, 0.05) AS di,
       coalesce(w.tx, 0.04) AS tx, coalesce(w.p, 40000.0) AS p
FROM spine s LEFT JOIN wday w ON s.date = w.date
"""

CTE["weather"] = """
SELECT date,
       0.6 * q + rk - 100 * di AS temp_min,
       0.6 * q + rk AS temp_max,
       0.6 * q + rk - 50 * di AS temp_avg,
       1000 * tx AS cloud_cover,
       40 + q AS humidity,
       20 * di AS precipitation,
       1000 + q AS pressure,
       100 * tx AS wind_speed,
       p % 360 AS wind_direction,
       city
FROM wjoin
"""

CTE["events_raw"] = """
SELECT event_type AS city, user_id AS sensor_id, event_id, ts, value,
       strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS ts_local
FROM events
"""

# --- preprocessing chain ------------------------------------------------

CTE["clean"] = "SELECT * FROM readings WHERE pm25_avg > 0"

CTE["sdays"] = """
SELECT city, sensor_id, date,
       CAST(date - lag(date) OVER (PARTITION BY sensor_id ORDER BY date) AS BIGINT) AS delta
FROM clean
"""

CTE["gap_stats"] = """
SELECT city, sensor_id, count(*) AS gap_count, max(delta) AS gap_max,
       quantile_cont(CAST(delta AS DOUBLE), 0.5) AS gap_median,
       quantile_cont(CAST(delta AS DOUBLE), 0.75) AS gap_q75
FROM sdays WHERE delta > 1 GROUP BY city, sensor_id
"""

CTE["gap_flag"] = "SELECT sensor_id FROM gap_stats WHERE gap_max >= 30 OR gap_q75 >= 10.0"

CTE["cov_month"] = """
SELECT city, sensor_id, last_day(date) AS month, count(*) AS nb_readings,
       CAST(day(last_day(date)) AS BIGINT) AS days_in_month,
       count(*) / day(last_day(date)) * 100 AS coverage_pct,
       CAST(count(*) / day(last_day(date)) * 100 < 70 AS INTEGER) AS bad_month
FROM clean GROUP BY city, sensor_id, last_day(date)
"""

CTE["cov_flag"] = """
SELECT sensor_id FROM cov_month GROUP BY city, sensor_id HAVING avg(bad_month) > 0.20
"""

CTE["flagged"] = "SELECT sensor_id FROM gap_flag UNION SELECT sensor_id FROM cov_flag"

CTE["kept"] = "SELECT * FROM clean WHERE sensor_id NOT IN (SELECT sensor_id FROM flagged)"

CTE["aq_train"] = "SELECT city, date, avg(pm25_avg) AS pm25_avg FROM kept GROUP BY city, date"
CTE["aq_eval"] = "SELECT city, date, avg(pm25_avg) AS pm25_avg FROM clean GROUP BY city, date"


def merged_cte(aq: str) -> str:
    return f"""
SELECT w.city, w.date, a.pm25_avg, w.temp_min, w.temp_max, w.cloud_cover, w.humidity,
       w.precipitation, w.pressure, w.wind_speed, w.wind_direction
FROM weather w LEFT JOIN {aq} a ON w.date = a.date AND w.city = a.city
"""


CTE["merged_eval"] = merged_cte("aq_eval")
CTE["merged_train"] = merged_cte("aq_train")


def tagged_cte(src: str) -> str:
    return f"""
SELECT *,
  last_value(pm25_avg IGNORE NULLS) OVER wp AS pv,
  last_value(CASE WHEN pm25_avg IS NOT NULL THEN date END IGNORE NULLS) OVER wp AS pd,
  first_value(pm25_avg IGNORE NULLS) OVER wn AS nv,
  first_value(CASE WHEN pm25_avg IS NOT NULL THEN date END IGNORE NULLS) OVER wn AS nd
FROM {src}
WINDOW wp AS (PARTITION BY city ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       wn AS (PARTITION BY city ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
"""


def repaired_cte(src: str, limit: int = 1) -> str:
    return f"""
SELECT city, date,
  CASE WHEN pm25_avg IS NULL AND pv IS NOT NULL AND nv IS NOT NULL AND (date - pd) <= {limit}
       THEN pv + (nv - pv) * (CAST(date - pd AS DOUBLE) / CAST(nd - pd AS DOUBLE))
       ELSE pm25_avg END AS pm25_avg,
  temp_min, temp_max, cloud_cover, humidity, precipitation, pressure, wind_speed, wind_direction
FROM {src}
"""


CTE["tagged_eval"] = tagged_cte("merged_eval")
CTE["tagged_train"] = tagged_cte("merged_train")
CTE["repaired_eval"] = repaired_cte("tagged_eval")
CTE["repaired_train"] = repaired_cte("tagged_train")

FEATURES_SELECT = """
SELECT city, date, pm25_avg, temp_min, temp_max, cloud_cover, humidity, precipitation, pressure,
  wind_speed, wind_direction,
  lead(pm25_avg, 1) OVER w AS target,
  temp_max - temp_min AS temp_gradient,
  cos(month(date) * 2 * pi() / 12) AS month_cos,
  sin(month(date) * 2 * pi() / 12) AS month_sin,
  CAST(isodow(date) - 1 AS BIGINT) AS dow,
  CAST(isodow(date) - 1 >= 5 AS INTEGER) AS is_weekend,
  (lag(pm25_avg, 12) OVER w + lag(pm25_avg, 13) OVER w + lag(pm25_avg, 14) OVER w) / 3 AS lag_avg_14,
  CASE WHEN count(pm25_avg) OVER w7 = 7 THEN stddev_samp(pm25_avg) OVER w7 END AS week_std,
  pm25_avg AS lag_1,
  lag(pm25_avg, 1) OVER w AS lag_2,
  lag(pm25_avg, 2) OVER w AS lag_3,
  lag(pm25_avg, 6) OVER w AS lag_7
FROM {src}
WINDOW w AS (PARTITION BY city ORDER BY date),
       w7 AS (PARTITION BY city ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
"""

ALL_FEATURE_COLS = [
    "city", "date", "pm25_avg", "temp_min", "temp_max", "cloud_cover", "humidity", "precipitation",
    "pressure", "wind_speed", "wind_direction", "target", "temp_gradient", "month_cos", "month_sin",
    "dow", "is_weekend", "lag_avg_14", "week_std", "lag_1", "lag_2", "lag_3", "lag_7",
]

NOT_NULL_ALL = " AND ".join(f"{c} IS NOT NULL" for c in ALL_FEATURE_COLS)

for _m in ("eval", "train"):
    CTE[f"logged_{_m}"] = f"SELECT * REPLACE (ln(1 + pm25_avg) AS pm25_avg) FROM repaired_{_m}"
    CTE[f"feat_{_m}"] = FEATURES_SELECT.format(src=f"logged_{_m}")
    CTE[f"full_{_m}"] = f"SELECT * EXCLUDE (pm25_avg) FROM feat_{_m} WHERE {NOT_NULL_ALL}"

# dependencies between CTEs (to emit only what a query needs, in order)
DEPS = {
    "readings": ["geo"],
    "readings_sparse": ["geo"],
    "spine": ["wday"],
    "wjoin": ["spine", "wday"],
    "weather": ["wjoin"],
    "clean": ["readings"],
    "sdays": ["clean"],
    "gap_stats": ["sdays"],
    "gap_flag": ["gap_stats"],
    "cov_month": ["clean"],
    "cov_flag": ["cov_month"],
    "flagged": ["gap_flag", "cov_flag"],
    "kept": ["clean", "flagged"],
    "aq_train": ["kept"],
    "aq_eval": ["clean"],
    "merged_eval": ["weather", "aq_eval"],
    "merged_train": ["weather", "aq_train"],
}
for _m in ("eval", "train"):
    DEPS[f"tagged_{_m}"] = [f"merged_{_m}"]
    DEPS[f"repaired_{_m}"] = [f"tagged_{_m}"]
    DEPS[f"logged_{_m}"] = [f"repaired_{_m}"]
    DEPS[f"feat_{_m}"] = [f"logged_{_m}"]
    DEPS[f"full_{_m}"] = [f"feat_{_m}"]


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in DEPS.get(n, []):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def windowed(tag: str, mode: str, where: str) -> dict[str, str]:
    """The chain down to ``full_<mode>`` over the raw rows that meet ``where``
    only: every CTE once more, its name ended by ``_<tag>``."""
    chain = [n for n in _order([f"full_{mode}"]) if n not in ("geo", "wday", "spine", "wjoin")]
    out = {}
    for n in chain:
        body = f"SELECT * FROM {n} WHERE {where}" if n in ("readings", "weather") else re.sub(
            r"\b(" + "|".join(chain) + r")\b", lambda m: f"{m[1]}_{tag}", CTE[n])
        out[f"{n}_{tag}"] = body
    return out


def with_ctes(body: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause of the needed fixture CTEs (plus ``extra`` ones, in
    the given order, after them) followed by ``body``."""
    parts = [f"{n} AS ({CTE[n].strip()})" for n in _order(list(needs))]
    for n, sql in (extra or {}).items():
        parts.append(f"{n} AS ({sql.strip()})")
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def rounded(body: str, doubles: list[str], bits: int = 24) -> str:
    """Round the named double columns to the nearest multiple of 2^-bits
    with the same IEEE operations as ``functions.round_double``."""
    if not doubles:
        return body
    m = 2**bits
    reps = ", ".join(f"floor({c} * {m}.0 + 0.5) / {m}.0 + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({reps}) FROM (\n{body}\n) AS q"
