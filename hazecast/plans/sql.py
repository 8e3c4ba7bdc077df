"""SQL twins of the derived series, shared by the oracle queries."""

from __future__ import annotations

import re

from hazecast.schemas import MEMORY, READINGS

STATION_HOURS = """
SELECT date_trunc('hour', ts) AS date,
       {means},
       cast(count(*) AS double) AS carbon_monoxide,
       cast(round(max(value) * 100) AS double) AS nitrogen_dioxide,
       cast(round(min(value) * 100) AS double) AS sulphur_dioxide,
       cast(floor(cast(sum(cast(round(value * 100) AS bigint)) AS double) / count(*)) AS double) AS us_aqi,
       CASE user_id % 3 WHEN 0 THEN 'Karachi' WHEN 1 THEN 'Lahore' ELSE 'Islamabad' END AS city
FROM events
GROUP BY city, date
""".format(
    means=",\n       ".join(
        f"cast(floor(cast(sum(CASE WHEN event_type = '{kind}' THEN cast(round(value * 100) AS bigint) END) AS double)"
        f" / nullif(count(CASE WHEN event_type = '{kind}' THEN 1 END), 0)) AS double) AS {name}"
        for kind, name in [
            ("click", "pm10"),
            ("view", "pm2_5"),
            ("purchase", "ozone"),
            ("signup", "dust"),
            ("error", "uv_index"),
        ]
    )
)


def _mean_cents(column: str) -> str:
    return f"floor(cast(sum(cast(round({column} * 100) AS bigint)) AS double) / count(*))"


def _line_readings(city: str, date: str) -> str:
    return f"""
SELECT {date} AS date,
       cast({_mean_cents('l_quantity')} AS double) AS pm10,
       cast({_mean_cents('l_discount')} AS double) AS pm2_5,
       cast({_mean_cents('l_tax')} AS double) AS carbon_monoxide,
       max(l_quantity) AS nitrogen_dioxide,
       cast(count(*) AS double) AS sulphur_dioxide,
       cast(floor(100 * sum(l_linenumber) / count(*)) AS double) AS ozone,
       cast(floor(min(l_extendedprice)) AS double) AS dust,
       cast(floor(max(l_extendedprice)) AS double) AS uv_index,
       cast(floor({_mean_cents('l_extendedprice')} / 500.0) AS double) AS us_aqi,
       {city} AS city
FROM lineitem
GROUP BY 1, city
"""


SERIES_DAYS = _line_readings(
    "CASE l_returnflag WHEN 'A' THEN 'Karachi' WHEN 'N' THEN 'Lahore' ELSE 'Islamabad' END",
    "l_shipdate",
)
SHIPMENT_TICKS = _line_readings(
    "CASE WHEN l_returnflag = 'N' THEN 'hub' ELSE 'S' || cast(l_suppkey AS varchar) END",
    "l_shipdate + to_seconds((l_orderkey * 7 + l_linenumber) % 86400)",
)

W = "PARTITION BY city ORDER BY date"
FRAME = "ROWS BETWEEN 23 PRECEDING AND CURRENT ROW"
FEATURES = f"""
       cast(hour(date) AS int) AS hour,
       cast(isodow(date) - 1 AS int) AS day_of_week,
       cast(month(date) AS int) AS month,
       lag(us_aqi, 24) OVER ({W}) AS aqi_lag_24,
       lag(us_aqi, 48) OVER ({W}) AS aqi_lag_48,
       CASE WHEN count(us_aqi) OVER ({W} {FRAME}) = 24 THEN avg(us_aqi) OVER ({W} {FRAME}) END
         AS aqi_rolling_24_mean,
       CASE WHEN count(us_aqi) OVER ({W} {FRAME}) = 24 THEN stddev_samp(us_aqi) OVER ({W} {FRAME}) END
         AS aqi_rolling_24_std,
       (us_aqi - lag(us_aqi, 24) OVER ({W})) / nullif(lag(us_aqi, 24) OVER ({W}), 0) AS aqi_change_rate
"""


def with_series(select: str, **views: str) -> str:
    """SELECT text over named views; ``hours``, ``days`` and ``ticks`` name the derived series."""
    named = {"station_hours": STATION_HOURS, "series_days": SERIES_DAYS, "shipment_ticks": SHIPMENT_TICKS}
    used, seen = [], select + " ".join(views.values())
    for name, text in named.items():
        if re.search(rf"\b{name}\b", seen):
            used.append(f"{name} AS ({text})")
    used += [f"{name} AS ({text})" for name, text in views.items()]
    return f"WITH {', '.join(used)} {select}"


def not_null(columns: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def rounded_std(prefix: str = "") -> str:
    """All feature columns, the rolling deviation rounded."""
    kept = ["date", *READINGS, "city", "hour", "day_of_week", "month", *MEMORY]
    return ", ".join(
        f"round({prefix}{c}, 4) AS {c}" if c == "aqi_rolling_24_std" else f"{prefix}{c}" for c in kept
    )
