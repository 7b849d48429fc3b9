"""Rules of the instrument registry, each a rewrite of the whole (small) table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .canonical import best_of


def with_latest_market(instruments: DataFrame, quotes: DataFrame) -> DataFrame:
    """The market of each symbol's latest labelled capture, and the session in which it changed."""
    latest = quotes.where("market is not null").groupBy("symbol").agg(F.max_by(F.struct("market", "trading_date"), F.struct("created_at", "id")).alias("l"))
    i = instruments.join(latest, "symbol", "left")
    changed = F.col("l").isNotNull() & ~F.col("market").eqNullSafe(F.col("l.market"))
    had = F.col("market_changed_on") if "market_changed_on" in instruments.columns else F.lit(None).cast("date")
    return i.withColumns({"market_changed_on": F.when(changed, F.col("l.trading_date")).otherwise(had), "market": F.when(changed, F.col("l.market")).otherwise(F.col("market"))}).drop("l")


def with_broker_status(instruments: DataFrame, quotes: DataFrame, sessions: int = 5) -> DataFrame:
    """CAPTURED or ABSENT by captures in the last sessions with data; DELISTED ends only with a priced capture."""
    days = quotes.select("trading_date").distinct()
    cutoff = days.orderBy(F.desc("trading_date")).limit(sessions).agg(F.min("trading_date").alias("cutoff"))
    recent = quotes.join(F.broadcast(cutoff), F.col("trading_date") >= F.col("cutoff")).groupBy("symbol").agg(F.coalesce(F.bool_or(F.col("last_price") > 0), F.lit(False)).alias("priced"))  # one row
    i = instruments.join(recent, "symbol", "left")
    seen = F.col("priced").isNotNull()
    status = F.when(F.col("broker_status").eqNullSafe("DELISTED"), F.when(F.coalesce("priced", F.lit(False)), "CAPTURED").otherwise("DELISTED")).otherwise(F.when(seen, "CAPTURED").otherwise("ABSENT"))
    return i.withColumns({"status_changed": ~F.col("broker_status").eqNullSafe(status), "broker_status": status}).drop("priced")


def with_primary(instruments: DataFrame, quotes: DataFrame) -> DataFrame:
    """The primary symbol of each code: superseded last, then traded, latest, most captures, name. A symbol that never
    traded isn't primary unless delisted; a superseded one never is."""
    activity = quotes.groupBy("symbol").agg(F.count("*").alias("quote_rows"), F.max("trading_date").alias("last_quote"))
    i = instruments.join(activity, "symbol", "left").fillna(0, ["quote_rows"])
    order = Window.partitionBy(F.coalesce("code", "symbol")).orderBy(F.col("superseded_by").isNotNull(), F.desc(F.col("quote_rows") > 0), F.desc_nulls_last("last_quote"), F.desc("quote_rows"), "symbol")
    first = F.row_number().over(order) == 1
    should = F.col("superseded_by").isNull() & (F.col("broker_status").eqNullSafe("DELISTED") | (first & (F.col("quote_rows") > 0)))
    return i.withColumn("is_primary", should)


def contradictions(ranked: DataFrame) -> DataFrame:
    """Primaries staler than another symbol of their code (delisted ones may be); must be empty."""
    key = F.coalesce("code", "symbol")
    p = ranked.where("is_primary and coalesce(broker_status, '') <> 'DELISTED'").select(key.alias("key"), F.col("symbol").alias("primary"), F.col("last_quote").alias("primary_quote"))
    o = ranked.where("not is_primary and last_quote is not null").select(key.alias("key"), F.col("symbol").alias("other"), F.col("last_quote").alias("other_quote"))
    return p.join(o, "key").where("primary_quote is null or other_quote > primary_quote")


def with_tv_status(instruments: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Presence in the second feed on its last day; a feed without rows changes nothing."""
    last = watchlist.agg(F.max("trading_date").alias("last_day"))
    there = watchlist.join(F.broadcast(last), F.col("trading_date") == F.col("last_day")).select("symbol").distinct().withColumn("there", F.lit(True))  # one row
    i = instruments.join(there, "symbol", "left").crossJoin(F.broadcast(last))  # one row
    had = F.col("tv_status") if "tv_status" in instruments.columns else F.lit(None).cast("string")
    return i.withColumn("tv_status", F.when(F.col("last_day").isNull(), had).otherwise(F.when(F.col("there"), "CAPTURED").otherwise("ABSENT"))).drop("there", "last_day")


def with_tradeable(instruments: DataFrame) -> DataFrame:
    return instruments.withColumn("is_tradeable", F.coalesce("is_primary", F.lit(True)) & (F.col("market") != "Auction Market") & (F.coalesce("broker_status", F.lit("")) != "DELISTED"))


def refresh(instruments: DataFrame, quotes: DataFrame, watchlist: DataFrame) -> DataFrame:
    """All rules in order: market, broker status, primary, second feed, tradeable."""
    i = with_broker_status(with_latest_market(instruments, quotes), quotes)
    return with_tradeable(with_tv_status(with_primary(i, quotes), watchlist))


def mark_matched(instruments: DataFrame, batch: DataFrame) -> DataFrame:
    """After a capture batch: its symbols are CAPTURED, unknown ones are added as UNMATCHED; DELISTED stays."""
    seen = batch.select("symbol").distinct().withColumn("_seen", F.lit(True))
    i = instruments.join(seen, "symbol", "full")
    known = F.coalesce(*(F.col(c).isNotNull() for c in ("broker_status",)))
    return i.withColumn("broker_status", F.when(F.col("broker_status") == "DELISTED", "DELISTED").when(F.col("_seen") & known, "CAPTURED").when(F.col("_seen"), "UNMATCHED").otherwise(F.col("broker_status"))).drop("_seen")


def collapse(rows: DataFrame, order: str) -> DataFrame:
    """One row a symbol, each column's latest known value."""
    cols = [c for c in rows.columns if c not in ("symbol", order)]
    return rows.groupBy("symbol").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols))


def seed(broker: DataFrame, other: DataFrame) -> DataFrame:
    """A registry from two feeds: the broker's market and code win, the other fills in a description."""
    latest = best_of(broker.select("symbol", "market", "code", "created_at"), ["symbol"], F.col("created_at")).drop("created_at")
    b = latest.withColumn("in_broker", F.lit(True))
    o = other.groupBy("symbol").agg(F.max("description").alias("description")).withColumn("in_other", F.lit(True))
    return b.join(o, "symbol", "full").fillna(False, ["in_broker", "in_other"])


def groups(instruments: DataFrame) -> DataFrame:
    """Symbols of each owner group as sorted text. Groups are sets of listed companies, so lists stay short."""
    return instruments.where("owner_group is not null").groupBy("owner_group").agg(F.count("*").alias("members"), F.array_join(F.array_sort(F.collect_list("symbol")), ", ").alias("symbols"))


def members_twice(groups_of: DataFrame) -> DataFrame:
    """Symbols mapped to several groups; must be empty."""
    return groups_of.groupBy("symbol").agg(F.countDistinct("owner_group").alias("groups")).where("groups > 1")
