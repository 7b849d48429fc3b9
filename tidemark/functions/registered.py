"""The exchange's functions in SQL: scalar and table functions of a session, over a view of its captures.

``register(spark, quotes)`` makes a temporary view ``market_sessions`` and these functions, all plain SQL, so that Catalyst
inlines them in whatever calls them; ``spark.sql("select prev_session(date'2024-01-10', 5)")`` then works as it does in
``from prev_session(...)`` and in a lateral join. Each row of the view is a session, so its one array is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LIMITS, Limits

SESSIONS, CAPTURED = "market_sessions", "market_captured_days"


def statements(limits: Limits = LIMITS) -> list[str]:
    weekend = ", ".join(map(str, limits.weekend))
    local = "timestampadd(HOUR, 3, at)"
    minutes = f"hour({local}) * 60 + minute({local})"
    before = "filter(days, x -> x < d)"
    # columns by names of their own, so that none is taken for one of the caller's, who may read the same views
    sessions, captured = f"(select trading_date as t from {SESSIONS})", f"(select symbol as s, trading_date as t, captures as n from {CAPTURED})"
    return [
        # the n-th session before a day that has data, or the oldest where there are fewer; null where there is none
        f"prev_session(d date, n int default 1) returns date return (select get({before}, size({before}) - least(greatest(n, 1), size({before}))) from (select array_sort(collect_set(t)) as days from {sessions}))",
        f"prev_session(d date, n int default 1) returns table (nth int, trading_date date) return select nth, t from (select cast(row_number() over (order by t desc) as int) as nth, t from {sessions} where t < prev_session.d) where nth <= greatest(prev_session.n, 1)",
        f"prev_session_of(name string, d date) returns date return (select max(t) from {captured} where s = name and t < d)",
        f"symbols_of(d date) returns table (symbol string, captures bigint) return select s, n from {captured} where t = symbols_of.d",
        "trading_day(at timestamp_ntz) returns date return to_date(timestampadd(HOUR, 3, at))",
        "minute_bucket(at timestamp_ntz) returns timestamp_ntz return timestampadd(SECOND, -second(at), cast(date_trunc('SECOND', at) as timestamp_ntz))",
        f"is_trading_day(d date) returns boolean return dayofweek(d) not in ({weekend})",
        f"is_within_window(at timestamp_ntz) returns boolean return dayofweek({local}) not in ({weekend}) and {minutes} >= {limits.window_start} and {minutes} < {limits.window_end}",
        "half_up(x double, places int default 4) returns double return floor(x * power(10, places) + 0.5) / power(10, places)",
    ]


def register(spark: SparkSession, quotes: DataFrame, limits: Limits = LIMITS) -> None:
    """Views over captures (symbol, trading_date) and the functions that read them, for this session."""
    days = quotes.groupBy("symbol", "trading_date").agg(F.count("*").alias("captures"))
    days.createOrReplaceTempView(CAPTURED)
    days.select("trading_date").distinct().createOrReplaceTempView(SESSIONS)
    for s in statements(limits):
        spark.sql(f"create or replace temporary function {s}")
