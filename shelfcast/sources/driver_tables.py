"""Retail-panel inputs derived from the star-schema tables (lineitem, part, supplier,
nation, region, orders).

Mapping: item = part brand, store = supplier nation, state = region, department =
brand number mod 5, category = department pair; one panel row per (item, store, ship
date) with units = sum of quantity and price = revenue / units.  The calendar dimension
holds every ship or order date; a day with a very large order carries an event.

These functions only put the tables into the shapes the reference's operators expect
(long panel, calendar, weekly prices, wide sales matrix); all feature, split, model and
metric work happens in ``shelfcast.operators``.

Scale notes: lineitem is the only big input.  The joins to part and supplier are plain
equi-joins that Catalyst/AQE plan as sort-merge joins (or broadcast joins when the
measured side is small); nation and region are joined after the aggregation input is
reduced to (brand, nation key) so their join is against tiny tables.  The GROUP BY has
partial (map-side) aggregation, so a hot (brand, nation, day) key is combined before the
shuffle.  Money sums run through DECIMAL(15,2) so the result is exact and identical in
any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, release_scratch, scratch_read
from . import scope

# ---- fixed values for the derived calendar ----------------------------------------
BIG_ORDER_PRICE = 490000.0   # an order above this total marks the day as an event day
EVENT_NAME = "BigOrder"
EVENT_TYPE = "Commercial"
FIRST_WM_YR_WK = 11101       # week key of the first calendar week
# Region -> SNAP flag column used for the derived panel's state flags.
REGION_FLAGS = {"AMERICA": "snap_CA", "EUROPE": "snap_TX", "ASIA": "snap_WI"}
# ------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def brand_number(brand: Column) -> Column:
    return F.substring(brand, 7, 10).cast("int")


def dept_of_brand(brand: Column) -> Column:
    return F.concat(F.lit("D"), ((brand_number(brand) - 1) % 5).cast("string"))


def cat_of_dept(dept: Column) -> Column:
    return F.when(dept.isin("D0", "D1"), F.lit("C0")).otherwise(F.lit("C1"))


def _daily_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units and revenue per (brand, supplier nation key, ship date).

    lineitem is joined to part and supplier on their keys (sort-merge joins at scale,
    broadcast when AQE measures a side small; a hot key is split by AQE's skew-join
    handling since the dimension side has one row per key), then aggregated once.  The
    aggregate's map-side partial step reduces each task's lines to (brand, nation, day)
    groups before the only aggregation shuffle.  Aggregating to (brand, supplier, day)
    between the two joins was measured and rejected: that key is nearly unique per line
    in this schema, so it adds a shuffle without shrinking the second join's input."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = li.join(part, li.l_partkey == part.p_partkey).join(supp, li.l_suppkey == supp.s_suppkey)
    return (lines.groupBy("p_brand", "s_nationkey", F.to_date("l_shipdate").alias("date"))
                 .agg(F.sum("l_quantity").alias("qty"),
                      F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("rev")))


def daily_totals(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    """The (brand, nation key, day) table that panel, weekly prices, wide matrix and calendar
    derive from.  In a query scope it is materialised, so lineitem is read once per query;
    ``once`` returns the bare plan for queries that read it a single time."""
    key = ("daily", sf_dir)
    if scope.known(key) or scope.inside() and not once:
        return scope.memo(key, lambda: cut_lineage(_daily_plan(spark, sf_dir)))
    return _daily_plan(spark, sf_dir)


def panel(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    """Long panel (item_id, store_id, dept_id, cat_id, state_id, date, sales, sell_price).

    The daily grain is aggregated first on (brand, nation key, day); the 25-row nation
    and 5-row region dimensions are joined to that reduced result.
    """
    daily = daily_totals(spark, sf_dir, once)
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    dept = dept_of_brand(F.col("p_brand"))
    return (daily.join(geo, daily.s_nationkey == geo.n_nationkey)
                 .select(F.col("p_brand").alias("item_id"),
                         F.col("n_name").alias("store_id"),
                         dept.alias("dept_id"),
                         cat_of_dept(dept).alias("cat_id"),
                         F.col("r_name").alias("state_id"),
                         "date",
                         F.col("qty").cast("double").alias("sales"),
                         (F.col("rev").cast("double") / F.col("qty").cast("double")).alias("sell_price")))


def part_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with a series key that grows with the data: item = part key, store = region of
    the supplier; same columns as :func:`panel` otherwise.  Materialised once per query.

    A row a line nearly, so three exchanges of all lines at scale (supplier, group, part): the daily
    rows are written between the last two, and neither's files meet the other's on disk."""
    def build():
        li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
        region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
        geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
        home = supp.join(geo, supp.s_nationkey == geo.n_nationkey).select("s_suppkey", "r_name")
        dept = dept_of_brand(F.col("p_brand"))
        daily = (li.join(home, li.l_suppkey == home.s_suppkey)
                   .groupBy("l_partkey", "r_name", F.to_date("l_shipdate").alias("date"))
                   .agg(F.sum("l_quantity").alias("qty"), F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("rev")))
        daily = cut_lineage(daily, "zstd")
        out = daily.join(part, daily.l_partkey == part.p_partkey)
        done = cut_lineage(out.select(F.col("l_partkey").cast("string").alias("item_id"), F.col("r_name").alias("store_id"),
                                      dept.alias("dept_id"), cat_of_dept(dept).alias("cat_id"), F.col("r_name").alias("state_id"), "date",
                                      F.col("qty").cast("double").alias("sales"),
                                      (F.col("rev").cast("double") / F.col("qty").cast("double")).alias("sell_price")), "zstd")
        release_scratch(spark, scratch_read(daily))
        return done
    return scope.memo(("part_panel", sf_dir), build)


def calendar_bounds(spark: SparkSession, sf_dir: str) -> tuple:
    """First and last ship or order date, one row read once per query: from the daily totals
    where the query has them, else from the date columns."""
    def build():
        if scope.known(("daily", sf_dir)):
            ship = daily_totals(spark, sf_dir).select("date")
        else:
            ship = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"))
        order = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
        return tuple(ship.union(order).agg(F.min("date"), F.max("date")).first())
    return scope.memo(("bounds", sf_dir), build)


def calendar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last ship or order date (a calendar has no gaps),
    generated from the two bounds (one row per calendar day)."""
    lo, hi = calendar_bounds(spark, sf_dir)
    return spark.range(1).select(F.explode(F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date"))).alias("date")).where(F.col("date").isNotNull())


def raw_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar in the shape of the reference's calendar file (before S1 normalisation):
    date, wm_yr_wk, weekday, wday, month, year, d, four event fields (null when no event),
    snap_CA/TX/WI.  Day keys d_1 .. d_N number the contiguous calendar days."""
    dates = calendar_dates(spark, sf_dir)
    first = F.lit(calendar_bounds(spark, sf_dir)[0]).cast("date")
    big = (table(spark, sf_dir, "orders")
           .filter(F.col("o_totalprice") > BIG_ORDER_PRICE)
           .select(F.to_date("o_orderdate").alias("date")).distinct()
           .withColumn("big", F.lit(True)))
    idx = F.datediff(F.col("date"), first)
    m = F.month("date")
    return (dates.join(big, "date", "left")
            .select("date",
                    (F.lit(FIRST_WM_YR_WK) + F.floor(idx / 7)).cast("int").alias("wm_yr_wk"),
                    F.date_format("date", "EEEE").alias("weekday"),
                    (F.weekday("date") + 1).alias("wday"),
                    m.alias("month"), F.year("date").alias("year"),
                    F.concat(F.lit("d_"), (idx + 1).cast("string")).alias("d"),
                    F.when(F.col("big"), F.lit(EVENT_NAME)).alias("event_name_1"),
                    F.when(F.col("big"), F.lit(EVENT_TYPE)).alias("event_type_1"),
                    F.lit(None).cast("string").alias("event_name_2"),
                    F.lit(None).cast("string").alias("event_type_2"),
                    (m % 2 == 1).cast("int").alias("snap_CA"),
                    (m % 2 == 0).cast("int").alias("snap_TX"),
                    (F.dayofmonth("date") <= 15).cast("int").alias("snap_WI")))


def weekly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price table (store_id, item_id, wm_yr_wk, sell_price): revenue / units per week, from the
    daily totals (their money sums are exact decimals)."""
    daily = daily_totals(spark, sf_dir)
    first = F.lit(calendar_bounds(spark, sf_dir)[0]).cast("date")
    week = (F.lit(FIRST_WM_YR_WK) + F.floor(F.datediff("date", first) / 7)).cast("int")
    weekly = (daily.groupBy("p_brand", "s_nationkey", week.alias("wm_yr_wk"))
                   .agg(F.sum("qty").alias("qty"), F.sum("rev").alias("rev")))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (weekly.join(nation, weekly.s_nationkey == nation.n_nationkey)
                  .select(F.col("n_name").alias("store_id"), F.col("p_brand").alias("item_id"),
                          "wm_yr_wk",
                          (F.col("rev").cast("double") / F.col("qty").cast("double")).alias("sell_price")))


def long_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily units per series keyed by calendar day key ``d`` (no price, no date)."""
    p = panel(spark, sf_dir).select("item_id", "store_id", "dept_id", "cat_id", "state_id",
                                    "date", "sales")
    cal = raw_calendar(spark, sf_dir).select("date", "d")
    return p.join(cal, "date").drop("date")


def wide_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide sales matrix in the reference's input layout: one row per series with a
    composite ``id``, the five id columns and one column ``d_1 .. d_N`` per calendar day
    (0 on days without sales).  The day-column list is the schema of the output, so the
    calendar length (one number) is read to name them.  Every series gets all N day
    indices (``sequence``), the observed units are joined on (series, day), and the N
    values are gathered into one array sorted by day, so column d_i is the O(1) array
    element i-1.  A series row holds exactly N values."""
    ids = ["item_id", "store_id", "dept_id", "cat_id", "state_id"]
    daily_totals(spark, sf_dir)  # the calendar's bounds then come from it
    lo, hi = calendar_bounds(spark, sf_dir)
    n_days = (hi - lo).days + 1
    long = long_sales(spark, sf_dir).withColumn("_i", F.regexp_replace("d", "^d_", "").cast("int"))
    grid = long.select(*ids).distinct().withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(n_days))))
    dense = grid.join(long.select(*ids, "_i", "sales"), [*ids, "_i"], "left")
    per_series = (dense.groupBy(*ids)
                  .agg(F.array_sort(F.collect_list(F.struct("_i", F.coalesce("sales", F.lit(0.0)).alias("v"))))
                       .alias("_a")))
    return per_series.selectExpr("concat_ws('_', item_id, store_id, 'validation') AS id", *ids,
                                 *[f"_a[{i - 1}].v AS d_{i}" for i in range(1, n_days + 1)])


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second, denser panel from the ``events`` table: one row per (user, event type,
    day) with the number of events and the summed value (DECIMAL sum, exact)."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    return (ev.groupBy("user_id", "event_type", F.to_date("ts").alias("day"))
              .agg(F.count(F.lit(1)).cast("double").alias("n_events"),
                   F.sum(F.col("value").cast("decimal(15,2)")).cast("double").alias("value_sum")))
