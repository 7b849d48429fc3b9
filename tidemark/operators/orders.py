"""Orders as folds of their sightings; positions and fees from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import half_up

#: Columns a later sighting overwrites, and those that it can't blank out.
LATEST = ("order_status", "price", "quantity", "filled_quantity")
STICKY = ("symbol", "side", "order_value", "net_value", "trading_date")


def fold(sightings: DataFrame, carry: bool = False) -> DataFrame:
    """One row for each order. An execution is a rise of the filled quantity from one sighting to the next, one more than
    the rises in all; with ``carry`` a sighting without a figure stands for the last known one."""
    seq = Window.partitionBy("order_id").orderBy("seq")
    before = F.last("filled_quantity", ignorenulls=True).over(seq.rowsBetween(Window.unboundedPreceding, -1)) if carry else F.lag("filled_quantity").over(seq)
    rows = sightings.withColumn("_rise", F.coalesce(F.col("filled_quantity") > before, F.lit(False)).cast("int"))
    return rows.groupBy("order_id").agg(
        *(F.max_by(F.struct(c), "seq").getField(c).alias(c) for c in LATEST),
        *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in STICKY),
        (1 + F.sum("_rise")).alias("executions_observed"),
        F.count("*").alias("sighting_count"),
        F.min("seq").alias("first_seen"),
        F.max("seq").alias("last_seen"),
    )


def positions(orders: DataFrame) -> DataFrame:
    """Bought, sold, net quantity and money by symbol and day, of orders with any fill."""
    buy, sell = F.col("side") == "BUY", F.col("side") == "SELL"
    of = lambda side, c: F.sum(F.when(side, F.coalesce(c, F.lit(0))).otherwise(0))
    return (
        orders.where(F.coalesce("filled_quantity", F.lit(0)) > 0)
        .groupBy("symbol", "trading_date")
        .agg(
            of(buy, "filled_quantity").alias("bought"),
            of(sell, "filled_quantity").alias("sold"),
            (of(buy, "filled_quantity") - of(sell, "filled_quantity")).alias("net_qty"),
            (of(sell, "net_value") - of(buy, "net_value")).alias("net_pnl"),
            F.sum(F.coalesce("executions_observed", F.lit(1))).alias("executions"),
            F.count("*").alias("orders"),
        )
    )


def median_of(rows: DataFrame, column: str, cells: int = 1 << 12) -> DataFrame:
    """One row with the exact median of a column, in steps, so that no task meets all of its values.

    Values are counted by cell of an even grid first; only the cells that hold the two middle ones are then ordered.
    """
    x = F.col(column).cast("double")
    known = rows.where(x.isNotNull()).select(x.alias("x"))
    ends = known.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("n"))
    wide = F.greatest(F.col("high") - F.col("low"), F.lit(1e-300))
    placed = known.groupBy("x").agg(F.count("*").alias("many")).join(F.broadcast(ends), F.lit(True))  # one row
    placed = placed.withColumn("cell", F.least(F.floor((F.col("x") - F.col("low")) / wide * cells), F.lit(cells - 1)))
    by_cell = placed.groupBy("cell", "n").agg(F.sum("many").alias("size"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # a row for each cell
    by_cell = by_cell.withColumn("ahead", F.coalesce(F.sum("size").over(before), F.lit(0)))
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    middle = by_cell.where((F.col("ahead") <= high) & (F.col("ahead") + F.col("size") > low)).select("cell", "ahead")
    inside = Window.partitionBy("cell").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    each = placed.join(F.broadcast(middle), "cell").withColumn("ahead", F.col("ahead") + F.coalesce(F.sum("many").over(inside), F.lit(0)))  # two rows
    holds = lambda at: (F.col("ahead") <= at) & (F.col("ahead") + F.col("many") > at)
    return each.agg(((F.max(F.when(holds(low), F.col("x"))) + F.max(F.when(holds(high), F.col("x")))) / 2).alias("median"))


def fee_check(orders: DataFrame) -> DataFrame:
    """Fees for each execution against twice the median of positive ones: outliers hint at executions not seen."""
    fee = F.abs(F.col("net_value") - F.col("order_value"))
    each = orders.where("order_value is not null and net_value is not null and coalesce(filled_quantity, 0) > 0").withColumn("fee_charged", fee)
    each = each.withColumn("fee_per_execution", F.col("fee_charged") / F.greatest("executions_observed", F.lit(1)))
    median = median_of(each.where("fee_charged > 0"), "fee_per_execution").select(F.col("median").alias("median_fee"))
    out = each.crossJoin(F.broadcast(median))  # one row
    over = F.coalesce((F.col("median_fee") > 0) & (F.col("fee_per_execution") > F.col("median_fee") * 2), F.lit(False))
    return out.select("order_id", "symbol", "side", "executions_observed", "fee_charged", half_up(F.col("fee_per_execution")).alias("fee_per_execution"), half_up(F.col("median_fee")).alias("median_fee"), over.alias("executions_likely_understated"))
