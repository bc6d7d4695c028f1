"""DuckDB SQL for every registered query with an exact oracle.

The views ``lineitem part supplier nation region orders`` are the driver's parquet
tables.  Each statement recomputes the query independently from those tables.  Shared
common table expressions are kept here as text so each oracle stays readable."""

from __future__ import annotations

PANEL = """
panel AS (
  SELECT p.p_brand AS item_id, n.n_name AS store_id,
         concat('D', CAST((CAST(substr(p.p_brand, 7) AS INTEGER) - 1) % 5 AS VARCHAR)) AS dept_id,
         CASE WHEN (CAST(substr(p.p_brand, 7) AS INTEGER) - 1) % 5 IN (0, 1) THEN 'C0' ELSE 'C1' END AS cat_id,
         r.r_name AS state_id, CAST(l.l_shipdate AS DATE) AS date,
         CAST(SUM(l.l_quantity) AS DOUBLE) AS sales,
         CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) / CAST(SUM(l.l_quantity) AS DOUBLE) AS sell_price
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
       JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2, 3, 4, 5, 6
)"""

CALENDAR = """
cal_src AS (
  SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem
  UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders
),
cal_dates AS (
  SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM cal_src
),
cal_first AS (SELECT min(date) AS first_date FROM cal_dates),
big_days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_totalprice > 490000.0),
calendar AS (
  SELECT c.date,
         CAST(11101 + floor(date_diff('day', f.first_date, c.date) / 7) AS INTEGER) AS wm_yr_wk,
         dayname(c.date) AS weekday, CAST(isodow(c.date) AS INTEGER) AS wday,
         CAST(month(c.date) AS INTEGER) AS month, CAST(year(c.date) AS INTEGER) AS year,
         'd_' || CAST(date_diff('day', f.first_date, c.date) + 1 AS VARCHAR) AS d,
         CASE WHEN b.date IS NOT NULL THEN 'BigOrder' ELSE 'NoEvent' END AS event_name_1,
         CASE WHEN b.date IS NOT NULL THEN 'Commercial' ELSE 'NoEvent' END AS event_type_1,
         'NoEvent' AS event_name_2, 'NoEvent' AS event_type_2,
         CAST(month(c.date) % 2 = 1 AS INTEGER) AS snap_CA,
         CAST(month(c.date) % 2 = 0 AS INTEGER) AS snap_TX,
         CAST(day(c.date) <= 15 AS INTEGER) AS snap_WI,
         CAST(b.date IS NOT NULL AS INTEGER) AS has_event
  FROM cal_dates c CROSS JOIN cal_first f LEFT JOIN big_days b ON c.date = b.date
)"""

W = "OVER (PARTITION BY item_id, store_id ORDER BY date"


def R6(e: str) -> str:
    """Round half up at 6 decimals with plain double arithmetic, which gives the same bits in
    Spark and DuckDB (their ROUND functions treat exact halves differently)."""
    return f"(floor(({e}) * 1000000 + 0.5) / 1000000)"


def R2(e: str) -> str:
    return f"(floor(({e}) * 100 + 0.5) / 100)"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n"


ORACLES: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


register("panel_view", with_(PANEL) + "SELECT * FROM panel")

register("lag_features", with_(PANEL) + f"""
SELECT item_id, store_id, date, sales,
       lag(sales, 1) {W}) AS sales_lag_1, lag(sales, 7) {W}) AS sales_lag_7,
       lag(sales, 14) {W}) AS sales_lag_14, lag(sales, 30) {W}) AS sales_lag_30
FROM panel""")

register("rolling_mean", with_(PANEL) + f"""
SELECT item_id, store_id, date,
       {R6(f"avg(sales) {W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS sales_rmean_7,
       {R6(f"avg(sales) {W} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)")} AS sales_rmean_30
FROM panel""")

register("rolling_std", with_(PANEL) + f"""
SELECT item_id, store_id, date,
       {R6(f"stddev_samp(sales) {W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS sales_rstd_7,
       {R6(f"stddev_samp(sales) {W} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)")} AS sales_rstd_30
FROM panel""")

register("rolling_minmax", with_(PANEL) + f"""
SELECT item_id, store_id, date,
       min(sales) {W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sales_rmin_7,
       max(sales) {W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sales_rmax_7,
       min(sales) {W} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS sales_rmin_30,
       max(sales) {W} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS sales_rmax_30
FROM panel""")


# ---- feature table -------------------------------------------------------------------

SNAP_CASE = ("CASE state_id WHEN 'AMERICA' THEN snap_CA WHEN 'EUROPE' THEN snap_TX "
             "WHEN 'ASIA' THEN snap_WI ELSE 0 END")

CAL_FEATURES = """CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
       CAST(day(date) AS INTEGER) AS day_of_month, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
       CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
       CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend,
       CAST(day(date) = 1 AS INTEGER) AS is_month_start,
       CAST(date = last_day(date) AS INTEGER) AS is_month_end"""

PRICE_COLS = ("sell_price", "price_change_abs", "price_change_pct", "price_momentum_7d",
              "price_rel_to_dept")


def features_ctes(lags=(1, 7, 14, 30), windows=(7, 30), source: str = "panel") -> str:
    """CTEs f0..f3 computing the pre-null-policy feature table over ``source``."""
    lag_sql = ",\n       ".join(f"lag(sales, {L}) {W}) AS sales_lag_{L}" for L in lags)
    roll = []
    for w in windows:
        fr = f"{W} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        roll += [f"avg(sales) {fr} AS sales_rmean_{w}", f"stddev_samp(sales) {fr} AS sales_rstd_{w}",
                 f"min(sales) {fr} AS sales_rmin_{w}", f"max(sales) {fr} AS sales_rmax_{w}"]
    roll_sql = ",\n       ".join(roll)
    return f"""
f0 AS (
  SELECT s.item_id, s.store_id, s.dept_id, s.cat_id, s.state_id, s.date, s.sales,
         s.sell_price AS raw_price,
         c.wm_yr_wk, c.weekday, c.wday, c.d, c.event_name_1, c.event_type_1, c.event_name_2,
         c.event_type_2, c.snap_CA, c.snap_TX, c.snap_WI, c.has_event
  FROM {source} s LEFT JOIN calendar c ON s.date = c.date
),
f1 AS (
  SELECT * EXCLUDE (raw_price), {CAL_FEATURES},
         {SNAP_CASE} AS snap_eligible,
         last_value(raw_price IGNORE NULLS) {W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sell_price
  FROM f0
),
f2 AS (
  SELECT *, sell_price - lag(sell_price, 1) {W}) AS price_change_abs,
         (sell_price - lag(sell_price, 1) {W})) / nullif(lag(sell_price, 1) {W}), 0) AS price_change_pct,
         avg(sell_price) {W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS price_momentum_7d,
         sell_price / nullif(avg(sell_price) OVER (PARTITION BY dept_id, date), 0) AS price_rel_to_dept,
       {lag_sql},
       {roll_sql}
  FROM f1
)"""


def feature_names(lags=(1, 7, 14, 30), windows=(7, 30)) -> list[str]:
    cols = ["item_id", "store_id", "dept_id", "cat_id", "state_id", "date", "sales",
            "wm_yr_wk", "weekday", "wday", "d", "event_name_1", "event_type_1", "event_name_2",
            "event_type_2", "snap_CA", "snap_TX", "snap_WI", "has_event", "day_of_week",
            "day_of_month", "week_of_year", "month", "year", "is_weekend", "is_month_start",
            "is_month_end", "snap_eligible", *PRICE_COLS]
    cols += [f"sales_lag_{L}" for L in lags]
    for w in windows:
        cols += [f"sales_rmean_{w}", f"sales_rstd_{w}", f"sales_rmin_{w}", f"sales_rmax_{w}"]
    return cols


STRING_COLS = {"item_id", "store_id", "dept_id", "cat_id", "state_id", "weekday", "d",
               "event_name_1", "event_type_1", "event_name_2", "event_type_2", "date"}
CATEGORICAL = {"item_id", "store_id", "dept_id", "cat_id", "state_id", "weekday",
               "event_name_1", "event_type_1", "event_name_2", "event_type_2"}
DOUBLE_COLS_PREFIX = ("sales", "sell_price", "price_")


def null_policy_sql(cols, warmup: int, src: str, round_doubles=True) -> str:
    """SELECT over ``src`` applying: ffill price columns, zero-fill numerics, 'Unknown'
    for categoricals, drop the first ``warmup`` rows per series."""
    ff = [f"last_value({c} IGNORE NULLS) {W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
          if c in PRICE_COLS else c for c in cols]
    fin = []
    for c in cols:
        if c in CATEGORICAL:
            fin.append(f"coalesce({c}, 'Unknown') AS {c}")
        elif c in STRING_COLS:
            fin.append(c)
        elif c.startswith(DOUBLE_COLS_PREFIX) and round_doubles:
            fin.append(f"{R6(f'coalesce({c}, 0)')} AS {c}")
        else:
            fin.append(f"coalesce({c}, 0) AS {c}")
    return f"""
np1 AS (SELECT {', '.join(ff)} FROM {src}),
np2 AS (SELECT *, row_number() {W}) - 1 AS _rn FROM np1)
SELECT {', '.join(fin)} FROM np2 WHERE _rn >= {warmup}"""


def full_features_sql(lags=(1, 7, 14, 30), windows=(7, 30), warmup=30) -> str:
    cols = feature_names(lags, windows)
    return with_(PANEL, CALENDAR, features_ctes(lags, windows)) + ", " + \
        null_policy_sql(cols, warmup, "f2").lstrip()


register("full_features", full_features_sql())
register("entry_features", full_features_sql((1, 7), (7,), 5))

register("calendar_features", with_(CALENDAR) + f"SELECT date, {CAL_FEATURES} FROM calendar")

register("load_calendar", with_(CALENDAR) + "SELECT * FROM calendar")

register("event_flags", with_(CALENDAR) + """
SELECT date, event_name_1, event_type_1, event_name_2, event_type_2, has_event FROM calendar""")

register("state_flag_select", with_(PANEL, CALENDAR) + f"""
SELECT p.item_id, p.store_id, p.date, p.state_id, {SNAP_CASE} AS snap_eligible
FROM panel p LEFT JOIN calendar c ON p.date = c.date""")

register("price_change", with_(PANEL) + f"""
SELECT item_id, store_id, date,
       {R6(f"sell_price - lag(sell_price, 1) {W})")} AS price_change_abs,
       {R6(f"(sell_price - lag(sell_price, 1) {W})) / nullif(lag(sell_price, 1) {W}), 0)")} AS price_change_pct
FROM panel""")

register("price_momentum", with_(PANEL) + f"""
SELECT item_id, store_id, date,
       {R6(f"avg(sell_price) {W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")} AS price_momentum_7d
FROM panel""")

register("price_rel_to_dept", with_(PANEL) + f"""
SELECT item_id, store_id, date, dept_id,
       {R6("sell_price / nullif(avg(sell_price) OVER (PARTITION BY dept_id, date), 0)")} AS price_rel_to_dept
FROM panel""")

register("warmup_cut", with_(PANEL) + f"""
SELECT item_id, store_id, date, sales FROM (
  SELECT item_id, store_id, date, sales, row_number() {W}) - 1 AS rn FROM panel) WHERE rn >= 30""")

DENSE = """
spans AS (SELECT item_id, store_id, min(date) AS lo, max(date) AS hi FROM panel GROUP BY 1, 2),
dense AS (
  SELECT s.item_id, s.store_id, CAST(g.date AS DATE) AS date,
         coalesce(p.sales, 0.0) AS sales, p.sell_price
  FROM spans s, LATERAL (SELECT unnest(generate_series(s.lo, s.hi, INTERVAL 1 DAY)) AS date) g
  LEFT JOIN panel p ON p.item_id = s.item_id AND p.store_id = s.store_id AND p.date = CAST(g.date AS DATE)
)"""

register("densify_panel", with_(PANEL, DENSE) + """
SELECT item_id, store_id, date, sales, sell_price FROM dense""")

register("price_ffill", with_(PANEL, DENSE) + f"""
SELECT item_id, store_id, date,
       last_value(sell_price IGNORE NULLS) {W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sell_price
FROM dense""")

register("null_policy", with_(PANEL, DENSE) + f""",
np0 AS (
  SELECT item_id, store_id, date, sales, sell_price,
         sell_price - lag(sell_price, 1) {W}) AS price_change_abs,
         (sell_price - lag(sell_price, 1) {W})) / nullif(lag(sell_price, 1) {W}), 0) AS price_change_pct,
         lag(sales, 1) {W}) AS sales_lag_1, lag(sales, 7) {W}) AS sales_lag_7
  FROM dense
),""" + null_policy_sql(["item_id", "store_id", "date", "sales", "sell_price", "price_change_abs",
                         "price_change_pct", "sales_lag_1", "sales_lag_7"], 30, "np0").lstrip())


# ---- loading, melt, joins, sampling ----------------------------------------------------

PRICES = """
prices AS (
  SELECT n.n_name AS store_id, p.p_brand AS item_id,
         CAST(11101 + floor(date_diff('day', f.first_date, CAST(l.l_shipdate AS DATE)) / 7) AS INTEGER) AS wm_yr_wk,
         CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) / CAST(SUM(l.l_quantity) AS DOUBLE) AS sell_price
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
       JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey
       CROSS JOIN cal_first f
  GROUP BY 1, 2, 3
)"""

MELTED = """
long_sales AS (
  SELECT p.item_id, p.store_id, p.dept_id, p.cat_id, p.state_id, c.d, p.sales
  FROM panel p JOIN calendar c ON p.date = c.date
),
series AS (SELECT DISTINCT item_id, store_id, dept_id, cat_id, state_id FROM panel),
melted AS (
  SELECT s.item_id, s.store_id, s.dept_id, s.cat_id, s.state_id, c.d, coalesce(l.sales, 0.0) AS sales
  FROM series s CROSS JOIN calendar c
  LEFT JOIN long_sales l ON l.item_id = s.item_id AND l.store_id = s.store_id AND l.d = c.d
)"""

register("load_prices", with_(CALENDAR, PRICES) + "SELECT * FROM prices")

register("melt_sales", with_(PANEL, CALENDAR, MELTED) + "SELECT * FROM melted")
register("csv_sales_melt", with_(PANEL, CALENDAR, MELTED) + "SELECT * FROM melted")

register("panel_calendar_join", with_(PANEL, CALENDAR, MELTED) + """
SELECT m.*, c.* EXCLUDE (d) FROM melted m LEFT JOIN calendar c ON m.d = c.d""")

register("panel_merged", with_(PANEL, CALENDAR, MELTED, PRICES) + """
SELECT m.*, c.* EXCLUDE (d), pr.sell_price
FROM melted m LEFT JOIN calendar c ON m.d = c.d
LEFT JOIN prices pr ON pr.store_id = m.store_id AND pr.item_id = m.item_id AND pr.wm_yr_wk = c.wm_yr_wk""")

register("panel_price_join", with_(PANEL, CALENDAR, PRICES) + """
SELECT p.item_id, p.store_id, p.date, c.wm_yr_wk, pr.sell_price
FROM panel p JOIN calendar c ON p.date = c.date
LEFT JOIN prices pr ON pr.store_id = p.store_id AND pr.item_id = p.item_id AND pr.wm_yr_wk = c.wm_yr_wk""")

register("sample_series_frac", with_(PANEL, CALENDAR, MELTED) + """,
ranked AS (SELECT item_id, store_id, row_number() OVER (ORDER BY md5(item_id || '#' || store_id), item_id, store_id) AS rk
           FROM series),
k AS (SELECT CAST(round(0.2 * count(*)) AS BIGINT) AS k FROM series)
SELECT m.* FROM melted m JOIN ranked r ON m.item_id = r.item_id AND m.store_id = r.store_id
WHERE r.rk <= (SELECT k FROM k)""")

register("sample_n_series", with_(PANEL) + """,
ranked AS (SELECT item_id, store_id, row_number() OVER (ORDER BY md5(item_id || '#' || store_id), item_id, store_id) AS rk
           FROM (SELECT DISTINCT item_id, store_id FROM panel))
SELECT p.* FROM panel p JOIN ranked r ON p.item_id = r.item_id AND p.store_id = r.store_id WHERE r.rk <= 100""")

register("dropna_required", with_(PANEL) + f"""
SELECT * FROM (SELECT item_id, store_id, date, sales, sell_price, lag(sales, 7) {W}) AS sales_lag_7 FROM panel)
WHERE sales_lag_7 IS NOT NULL""")

register("filter_series", with_(PANEL) + "SELECT * FROM panel WHERE state_id = 'ASIA'")

register("time_index", with_(PANEL, CALENDAR) + """
SELECT p.item_id, p.store_id, p.date, c.d, CAST(replace(c.d, 'd_', '') AS INTEGER) AS time_idx
FROM panel p LEFT JOIN calendar c ON p.date = c.date""")

register("time_index_from_dates", with_(PANEL) + """
SELECT item_id, store_id, date, CAST(date_diff('day', (SELECT min(date) FROM panel), date) AS INTEGER) AS time_idx
FROM panel""")

register("series_counts", with_(PANEL) + """
SELECT count(*) AS n_rows, count(DISTINCT (item_id, store_id)) AS n_series,
       count(DISTINCT item_id) AS n_items, count(DISTINCT store_id) AS n_stores,
       count(DISTINCT cat_id) AS n_categories
FROM panel""")


INT_FEATURES = {"wm_yr_wk", "wday", "snap_CA", "snap_TX", "snap_WI", "has_event", "day_of_week",
                "day_of_month", "week_of_year", "month", "year", "is_weekend", "is_month_start",
                "is_month_end", "snap_eligible"}


def _narrow_sql() -> str:
    cols = [c for c in feature_names() if c in INT_FEATURES]
    np = null_policy_sql(feature_names(), 30, "f2").strip()
    head, final_select = np.rsplit("\nSELECT ", 1)
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS BIGINT) AS min_value, CAST(max({c}) AS BIGINT) AS max_value FROM feats"
        for c in cols)
    return (with_(PANEL, CALENDAR, features_ctes()) + ", " + head + ",\nfeats AS (SELECT " + final_select + ")\n"
            + f"""SELECT column_name, min_value, max_value,
       CASE WHEN min_value >= -128 AND max_value <= 127 THEN 'tinyint'
            WHEN min_value >= -32768 AND max_value <= 32767 THEN 'smallint'
            WHEN min_value >= -2147483648 AND max_value <= 2147483647 THEN 'int'
            ELSE 'bigint' END AS narrow_type
FROM ({parts})""")


register("narrow_schema_ranges", _narrow_sql())


# ---- temporal splits -------------------------------------------------------------------

def split_case(cut: str, test_days=28, embargo=1) -> str:
    return (f"CASE WHEN date < {cut} - INTERVAL {embargo} DAY THEN 'train' "
            f"WHEN date >= {cut} AND date < {cut} + INTERVAL {test_days} DAY THEN 'test' END")


register("temporal_split", with_(PANEL) + f""",
cut AS (SELECT CAST(max(date) - INTERVAL 28 DAY AS DATE) AS c FROM panel)
SELECT * FROM (
  SELECT item_id, store_id, date, sales, CAST({split_case('cut.c')} AS VARCHAR) AS split
  FROM panel CROSS JOIN cut) WHERE split IS NOT NULL""")


def folds_sql() -> str:
    return with_(PANEL.replace("panel AS (", "panel AS MATERIALIZED (")) + f""",
folds AS (SELECT i AS fold, CAST(m - INTERVAL (28 + (3 - i) * 28) DAY AS DATE) AS c
          FROM (SELECT max(date) AS m FROM panel), range(1, 4) t(i)),
labelled AS MATERIALIZED (
  SELECT CAST(f.fold AS INTEGER) AS fold, p.item_id, p.store_id, p.date, p.sales, {split_case('f.c')} AS split
  FROM panel p CROSS JOIN folds f),
kept AS (SELECT * FROM labelled WHERE split IS NOT NULL
         AND fold IN (SELECT fold FROM labelled WHERE split = 'test'))"""


register("rolling_folds", folds_sql() + "SELECT * FROM kept")

register("leakage_check", folds_sql() + """
SELECT fold, max(CASE WHEN split = 'train' THEN date END) AS train_max,
       min(CASE WHEN split = 'test' THEN date END) AS test_min,
       count(*) FILTER (WHERE split = 'train') AS n_train,
       count(*) FILTER (WHERE split = 'test') AS n_test,
       max(CASE WHEN split = 'train' THEN date END) < min(CASE WHEN split = 'test' THEN date END) AS leak_free
FROM kept GROUP BY fold""")

register("split_summary", with_(PANEL) + """
SELECT CAST(min(date) AS VARCHAR) || ' to ' || CAST(max(date) AS VARCHAR) AS date_range,
       CAST(date_diff('day', min(date), max(date)) AS INTEGER) AS total_days,
       28 AS test_days, 3 AS n_folds, 28 AS step_days, 1 AS embargo_days, 365 AS min_train_days,
       CAST(date_diff('day', min(date), max(date)) - 28 - 1 AS INTEGER) AS estimated_train_days
FROM panel""")


# ---- forecast dataset preparation -------------------------------------------------------

TIMED = """
timed AS (
  SELECT p.*, CAST(replace(c.d, 'd_', '') AS INTEGER) AS time_idx, CAST(isodow(p.date) - 1 AS INTEGER) AS day_of_week
  FROM panel p JOIN calendar c ON p.date = c.date
)"""

register("fit_validate_cut", with_(PANEL, CALENDAR, TIMED) + """
SELECT item_id, store_id, date, time_idx,
       CASE WHEN time_idx <= (SELECT max(time_idx) FROM timed) - 30 THEN 'fit' ELSE 'validate' END AS phase
FROM timed""")

INV_SOFTPLUS = "(greatest(sales, 1e-6) + ln(-(exp(-greatest(sales, 1e-6)) - 1)))"

register("group_normalize", with_(PANEL) + f""",
params AS (SELECT item_id, store_id, avg({INV_SOFTPLUS}) AS center, stddev_pop({INV_SOFTPLUS}) AS scale
           FROM panel GROUP BY 1, 2)
SELECT p.item_id, p.store_id, p.date,
       {R6(f"({INV_SOFTPLUS} - q.center) / coalesce(nullif(q.scale, 0), 1.0)")} AS target_norm,
       {R6("q.center")} AS target_center, {R6("coalesce(nullif(q.scale, 0), 1.0)")} AS target_scale
FROM panel p JOIN params q ON p.item_id = q.item_id AND p.store_id = q.store_id""")

register("window_samples", with_(PANEL, CALENDAR, TIMED) + f""",
s AS (
  SELECT item_id, store_id, date, time_idx,
         count(*) {W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS encoder_length,
         count(*) {W} ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) AS decoder_length,
         first_value(time_idx) {W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS encoder_first_idx,
         sum(sales) {W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS encoder_sales,
         last_value(time_idx) {W} ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) AS decoder_last_idx,
         sum(day_of_week) {W} ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) AS decoder_dow_sum
  FROM timed)
SELECT item_id, store_id, date, time_idx, CAST(encoder_length AS INTEGER) AS encoder_length,
       CAST(decoder_length AS INTEGER) AS decoder_length, encoder_first_idx,
       CAST(encoder_first_idx - time_idx AS INTEGER) AS encoder_first_rel, encoder_sales,
       decoder_last_idx, CAST(decoder_dow_sum AS BIGINT) AS decoder_dow_sum
FROM s WHERE encoder_length >= 14 AND decoder_length = 14""")

register("encoder_context", with_(PANEL, CALENDAR, TIMED) + f""",
cut AS (SELECT CAST(max(date) - INTERVAL 28 DAY AS DATE) AS c FROM timed),
lab AS (SELECT t.*, {split_case('cut.c')} AS split FROM timed t CROSS JOIN cut),
tr AS (SELECT * FROM lab WHERE split = 'train'),
te AS (SELECT * FROM lab WHERE split = 'test')
SELECT item_id, store_id, date, time_idx, 'context' AS part FROM tr
WHERE time_idx > (SELECT max(time_idx) FROM tr) - 30
UNION ALL SELECT item_id, store_id, date, time_idx, 'test' AS part FROM te""")


register("prediction_windows", with_(PANEL, CALENDAR, TIMED) + f""",
cut AS (SELECT CAST(max(date) - INTERVAL 28 DAY AS DATE) AS c FROM timed),
lab AS (SELECT t.*, {split_case('cut.c')} AS split FROM timed t CROSS JOIN cut),
tr AS (SELECT * FROM lab WHERE split = 'train' AND time_idx > (SELECT max(time_idx) FROM lab WHERE split = 'train') - 90),
e AS (SELECT *, row_number() OVER (PARTITION BY item_id, store_id ORDER BY date DESC) AS back FROM tr),
d AS (SELECT *, row_number() OVER (PARTITION BY item_id, store_id ORDER BY date) AS n FROM lab WHERE split = 'test'),
ea AS (SELECT item_id, store_id, CAST(count(*) AS INTEGER) AS encoder_length, min(time_idx) AS encoder_first_idx,
              sum(sales) AS encoder_sales FROM e WHERE back <= 30 GROUP BY 1, 2),
da AS (SELECT item_id, store_id, CAST(count(*) AS INTEGER) AS decoder_length, max(time_idx) AS decoder_last_idx
       FROM d WHERE n <= 14 GROUP BY 1, 2)
SELECT ea.item_id, ea.store_id, encoder_length, decoder_length, encoder_first_idx, encoder_sales, decoder_last_idx
FROM ea JOIN da ON ea.item_id = da.item_id AND ea.store_id = da.store_id""")


# ---- forecasts and metrics ---------------------------------------------------------------

BACKTEST_SPLIT = """
cutoff AS (SELECT CAST(max(date) - INTERVAL 28 DAY AS DATE) AS c FROM panel),
hist AS (SELECT p.* FROM panel p, cutoff WHERE p.date < cutoff.c),
fut AS (SELECT p.* FROM panel p, cutoff WHERE p.date >= cutoff.c AND p.date < cutoff.c + INTERVAL 28 DAY),"""

BACKTEST_MODEL = f"""
ranked AS (SELECT item_id, store_id, cat_id, date, sales,
                  row_number() OVER (PARTITION BY item_id, store_id ORDER BY date DESC) AS back,
                  sales - lag(sales, 7) {W}) AS r
           FROM hist),
last_season AS (SELECT item_id, store_id, back, sales AS base FROM ranked WHERE back <= 7),
series_last AS (SELECT item_id, store_id, any_value(cat_id) AS cat_id, arg_max(sales, date) AS last
                FROM ranked GROUP BY 1, 2),
steps AS (SELECT s.*, CAST(t.h AS INTEGER) AS horizon_step, CAST(7 - ((t.h - 1) % 7) AS BIGINT) AS back
          FROM series_last s CROSS JOIN range(1, 29) t(h)),
based AS (SELECT st.item_id, st.store_id, st.cat_id, st.horizon_step, coalesce(ls.base, st.last) AS base
          FROM steps st LEFT JOIN last_season ls
          ON st.item_id = ls.item_id AND st.store_id = ls.store_id AND st.back = ls.back),
rq AS (SELECT item_id, store_id, count(*) AS n, quantile_cont(r, 0.1) AS r10, quantile_cont(r, 0.5) AS r50,
              quantile_cont(r, 0.9) AS r90
       FROM ranked WHERE back <= 90 AND r IS NOT NULL GROUP BY 1, 2),
pooled AS (SELECT quantile_cont(r, 0.1) AS g10, quantile_cont(r, 0.5) AS g50, quantile_cont(r, 0.9) AS g90
           FROM ranked WHERE back <= 90 AND r IS NOT NULL),
forecasts AS (
  SELECT b.item_id, b.store_id, b.cat_id, b.horizon_step,
         greatest(b.base + CASE WHEN rq.n >= 14 THEN rq.r10 ELSE coalesce(pooled.g10, 0) END, 0.0) AS p10,
         greatest(b.base + CASE WHEN rq.n >= 14 THEN rq.r50 ELSE coalesce(pooled.g50, 0) END, 0.0) AS p50,
         greatest(b.base + CASE WHEN rq.n >= 14 THEN rq.r90 ELSE coalesce(pooled.g90, 0) END, 0.0) AS p90
  FROM based b LEFT JOIN rq ON b.item_id = rq.item_id AND b.store_id = rq.store_id CROSS JOIN pooled),
actuals AS (SELECT item_id, store_id, date, sales, CAST(row_number() {W}) AS INTEGER) AS horizon_step FROM fut),
fa AS (SELECT f.*, a.date, a.sales FROM forecasts f JOIN actuals a
       ON f.item_id = a.item_id AND f.store_id = a.store_id AND f.horizon_step = a.horizon_step
       WHERE a.horizon_step <= 28)"""

BACKTEST = BACKTEST_SPLIT + BACKTEST_MODEL


def pin(y: str, yhat: str, q: float) -> str:
    return f"CASE WHEN {y} - {yhat} >= 0 THEN {q} * ({y} - {yhat}) ELSE ({q} - 1.0) * ({y} - {yhat}) END"


def wql(q: float, col: str) -> str:
    return f"coalesce(2.0 * sum({pin('sales', col, q)}) / nullif(sum(abs(sales)), 0.0), 0.0)"


COV = "avg(CAST(sales >= p10 AND sales <= p90 AS DOUBLE))"

register("forecast_seasonal_quantiles", with_(PANEL, BACKTEST) + f"""
SELECT item_id, store_id, cat_id, horizon_step, {R6('p10')} AS p10, {R6('p50')} AS p50, {R6('p90')} AS p90
FROM forecasts""")

register("forecast_interval_stats", with_(PANEL, BACKTEST) + f"""
SELECT count(*) AS n_predictions, {R6('avg(p90 - p10)')} AS mean_interval_width,
       {R6('quantile_cont(p50, 0.5)')} AS median_p50 FROM forecasts""")

register("forecast_mae_coverage", with_(PANEL, BACKTEST) + f"""
SELECT count(*) AS n_evaluated, {R6('avg(abs(sales - p50))')} AS mae_p50, {R6(COV)} AS coverage FROM fa""")

register("naive_baseline_mae", with_(PANEL, BACKTEST) + f"""
SELECT count(*) AS n_evaluated, {R6('avg(abs(a.sales - s.last))')} AS naive_mae
FROM actuals a JOIN series_last s ON a.item_id = s.item_id AND a.store_id = s.store_id
WHERE a.horizon_step <= 28""")

register("wql", with_(PANEL, BACKTEST) + f"""
SELECT {R6(wql(0.1, 'p10'))} AS WQL_10, {R6(wql(0.5, 'p50'))} AS WQL_50, {R6(wql(0.9, 'p90'))} AS WQL_90 FROM fa""")

register("coverage", with_(PANEL, BACKTEST) + f"""
SELECT {R6(COV)} AS coverage_pct, {R6(f'abs({COV} - 0.8)')} AS coverage_error FROM fa""")

MASE_DEN = ("CASE WHEN n_hist <= 7 THEN 1.0 WHEN coalesce(sum_absdiff / nullif(CAST(n_diffs AS DOUBLE), 0.0), 0.0) = 0 "
            "THEN 0.000001 ELSE sum_absdiff / nullif(CAST(n_diffs AS DOUBLE), 0.0) END")

HIST_DIFFS = f"""
sdiff AS (SELECT item_id, store_id, count(*) AS n_hist, sum(d) AS sum_absdiff, count(d) AS n_diffs
          FROM (SELECT item_id, store_id, abs(sales - lag(sales, 7) {W})) AS d FROM hist) GROUP BY 1, 2)"""

register("mase_series", with_(PANEL, BACKTEST, HIST_DIFFS) + f""",
fm AS (SELECT item_id, store_id, avg(abs(sales - p50)) AS mae FROM fa GROUP BY 1, 2),
j AS (SELECT fm.item_id, fm.store_id, fm.mae, coalesce(s.n_hist, 0) AS n_hist, s.sum_absdiff,
             coalesce(s.n_diffs, 0) AS n_diffs
      FROM fm LEFT JOIN sdiff s ON fm.item_id = s.item_id AND fm.store_id = s.store_id)
SELECT item_id, store_id, {R6('mae')} AS mae, n_hist, {R6(f'mae / ({MASE_DEN})')} AS MASE FROM j""")


def report_sql(flattened: bool) -> str:
    metrics = f"""
m AS (
  SELECT CAST(grouping(cat_id, store_id) AS INTEGER) AS gid,
         CASE WHEN grouping(cat_id, store_id) = 1 THEN cat_id WHEN grouping(cat_id, store_id) = 2 THEN store_id END AS slice_value,
         {wql(0.1, 'p10')} AS WQL_10, {wql(0.5, 'p50')} AS WQL_50, {wql(0.9, 'p90')} AS WQL_90,
         {COV} AS coverage_pct, avg(abs(sales - p50)) AS mae
  FROM fa GROUP BY GROUPING SETS ((), (cat_id), (store_id))),
ss AS (SELECT DISTINCT item_id, store_id, cat_id FROM fa)"""
    if flattened:
        hist = f"""
hs AS (
  SELECT 1 AS gid, ss.cat_id AS slice_value, h.item_id, h.store_id, h.date, h.sales FROM hist h JOIN ss
    ON h.item_id = ss.item_id AND h.store_id = ss.store_id
  UNION ALL
  SELECT 2, ss.store_id, h.item_id, h.store_id, h.date, h.sales FROM hist h JOIN ss
    ON h.item_id = ss.item_id AND h.store_id = ss.store_id),
pos AS (SELECT gid, slice_value, sales,
               row_number() OVER (PARTITION BY gid, slice_value ORDER BY item_id, store_id, date) AS p FROM hs),
hd AS (SELECT a.gid, a.slice_value, abs(a.sales - b.sales) AS d FROM pos a JOIN pos b
       ON a.gid = b.gid AND a.slice_value = b.slice_value AND a.p = b.p + 7),
hagg AS (SELECT c.gid, c.slice_value, c.n_hist, coalesce(d.sum_absdiff, 0.0) AS sum_absdiff, coalesce(d.n_diffs, 0) AS n_diffs
         FROM (SELECT gid, slice_value, count(*) AS n_hist FROM hs GROUP BY 1, 2) c
         LEFT JOIN (SELECT gid, slice_value, sum(d) AS sum_absdiff, count(d) AS n_diffs FROM hd GROUP BY 1, 2) d
         ON c.gid = d.gid AND c.slice_value = d.slice_value)"""
    else:
        hist = HIST_DIFFS + """,
hagg AS (
  SELECT CAST(grouping(ss.cat_id, ss.store_id) AS INTEGER) AS gid,
         CASE WHEN grouping(ss.cat_id, ss.store_id) = 1 THEN ss.cat_id ELSE ss.store_id END AS slice_value,
         sum(n_hist) AS n_hist, sum(sum_absdiff) AS sum_absdiff, sum(n_diffs) AS n_diffs
  FROM sdiff s JOIN ss ON s.item_id = ss.item_id AND s.store_id = ss.store_id
  GROUP BY GROUPING SETS ((ss.cat_id), (ss.store_id)))"""
    return with_(PANEL, BACKTEST, metrics, hist) + f""",
sliced AS (
  SELECT m.gid, m.slice_value, WQL_10, WQL_50, WQL_90, coverage_pct,
         mae / (CASE WHEN coalesce(n_hist, 0) <= 7 THEN 1.0
                     WHEN coalesce(sum_absdiff / nullif(CAST(n_diffs AS DOUBLE), 0.0), 0.0) = 0 THEN 0.000001
                     ELSE sum_absdiff / nullif(CAST(n_diffs AS DOUBLE), 0.0) END) AS MASE
  FROM m LEFT JOIN hagg h ON m.gid = h.gid AND m.slice_value = h.slice_value WHERE m.gid <> 3),
allrows AS (
  SELECT * FROM sliced
  UNION ALL SELECT gid, slice_value, WQL_10, WQL_50, WQL_90, coverage_pct,
                   (SELECT avg(MASE) FROM sliced WHERE gid = 1) AS MASE FROM m WHERE gid = 3)
SELECT CASE gid WHEN 3 THEN 'global' WHEN 1 THEN 'category' ELSE 'store' END AS slice_type, slice_value,
       {R6('WQL_10')} AS WQL_10, {R6('WQL_50')} AS WQL_50, {R6('WQL_90')} AS WQL_90,
       {R6('coverage_pct')} AS coverage_pct, {R6('abs(coverage_pct - 0.8)')} AS coverage_error,
       {R6('MASE')} AS MASE,
       CASE WHEN abs(coverage_pct - 0.8) < 0.05 THEN 'OK' ELSE 'DRIFT' END AS calibration
FROM allrows"""


register("eval_report", report_sql(False))
register("mase_by_slice", report_sql(True))


# ---- causal ------------------------------------------------------------------------------

FOLD = "CAST(CAST('0x' || substr(md5(item_id || '|' || store_id), 1, 8) AS BIGINT) % 3 AS INTEGER)"

CAUSAL = f"""
cin AS (SELECT item_id, store_id, date, cat_id, day_of_week, has_event, sales, sell_price,
               price_change_pct, price_rel_to_dept, {FOLD} AS fold FROM f2),
bf0 AS (SELECT day_of_week, has_event, cat_id, fold, sum(sales) AS sy, sum(sell_price) AS st, count(*) AS n
        FROM cin GROUP BY ALL),
e0 AS (SELECT b.day_of_week, b.has_event, b.cat_id, b.fold,
              (t.Sy - b.sy) / nullif(t.N - b.n, 0) AS my0, (t.St - b.st) / nullif(t.N - b.n, 0) AS mt0
       FROM bf0 b JOIN (SELECT day_of_week, has_event, cat_id, sum(sy) AS Sy, sum(st) AS St, sum(n) AS N
                        FROM bf0 GROUP BY ALL) t
       ON b.day_of_week = t.day_of_week AND b.has_event = t.has_event AND b.cat_id = t.cat_id),
bf1 AS (SELECT day_of_week, has_event, fold, sum(sales) AS sy, sum(sell_price) AS st, count(*) AS n
        FROM cin GROUP BY ALL),
e1 AS (SELECT b.day_of_week, b.has_event, b.fold,
              (t.Sy - b.sy) / nullif(t.N - b.n, 0) AS my1, (t.St - b.st) / nullif(t.N - b.n, 0) AS mt1
       FROM bf1 b JOIN (SELECT day_of_week, has_event, sum(sy) AS Sy, sum(st) AS St, sum(n) AS N
                        FROM bf1 GROUP BY ALL) t
       ON b.day_of_week = t.day_of_week AND b.has_event = t.has_event),
bf2 AS (SELECT fold, sum(sales) AS sy, sum(sell_price) AS st, count(*) AS n FROM cin GROUP BY ALL),
e2 AS (SELECT b.fold, (t.Sy - b.sy) / nullif(t.N - b.n, 0) AS my2, (t.St - b.st) / nullif(t.N - b.n, 0) AS mt2
       FROM bf2 b, (SELECT sum(sy) AS Sy, sum(st) AS St, sum(n) AS N FROM bf2) t),
res AS (
  SELECT c.*, coalesce(my0, my1, my2) AS m_y, coalesce(mt0, mt1, mt2) AS m_t,
         c.sales - coalesce(my0, my1, my2) AS r_y, c.sell_price - coalesce(mt0, mt1, mt2) AS r_t
  FROM cin c
  LEFT JOIN e0 ON c.day_of_week = e0.day_of_week AND c.has_event = e0.has_event AND c.cat_id = e0.cat_id AND c.fold = e0.fold
  LEFT JOIN e1 ON c.day_of_week = e1.day_of_week AND c.has_event = e1.has_event AND c.fold = e1.fold
  LEFT JOIN e2 ON c.fold = e2.fold)"""


def normal_p(z: str) -> str:
    x = f"(abs({z}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + 0.3275911 * {x}))"
    poly = (f"({t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * "
            f"(-1.453152027 + {t} * 1.061405429)))))")
    return f"(1.0 - (1.0 - {poly} * exp(-{x} * {x})))"


def seg_effects_sql(seg: list[str], src: str = "res", name: str = "fx") -> str:
    keys = ", ".join(seg)
    on = " AND ".join(f"r.{c} = s.{c}" for c in seg) or "TRUE"
    sel = ", ".join(f"s.{c}" for c in seg)
    grp = f"GROUP BY {keys}" if seg else ""
    se = "sqrt(m.meat * CASE WHEN s.n > 2 THEN s.n / (s.n - 2.0) END) / nullif(s.n * s.vx, 0.0)"
    return f"""
{name}_s1 AS (SELECT {keys + ',' if seg else ''} count(*) AS n, avg(r_t) AS mx, avg(r_y) AS my, var_pop(r_t) AS vx,
                avg(sell_price) AS mean_t, avg(sales) AS mean_y, covar_pop(r_y, r_t) / nullif(var_pop(r_t), 0.0) AS effect
         FROM {src} {grp}),
{name}_s2 AS (SELECT {sel + ',' if seg else ''} sum((r.r_t - s.mx) * (r.r_t - s.mx)
                * ((r.r_y - s.my) - s.effect * (r.r_t - s.mx)) * ((r.r_y - s.my) - s.effect * (r.r_t - s.mx))) AS meat
         FROM {src} r JOIN {name}_s1 s ON {on} {('GROUP BY ' + sel) if seg else ''}),
{name} AS (
  SELECT {sel + ',' if seg else ''} s.n, s.effect, {se} AS se,
         s.effect - 1.959963984540054 * ({se}) AS ci_lower, s.effect + 1.959963984540054 * ({se}) AS ci_upper,
         s.effect * (s.mean_t / nullif(s.mean_y, 0.0)) AS tau,
         {normal_p(f's.effect / nullif({se}, 0.0)')} AS p_value
  FROM {name}_s1 s JOIN {name}_s2 m ON {' AND '.join(f's.{c} = m.{c}' for c in seg) or 'TRUE'})"""


CAUSAL_HEAD = with_(PANEL, CALENDAR, features_ctes(), CAUSAL)

register("dml_folds", with_(PANEL) + f"SELECT DISTINCT item_id, store_id, {FOLD} AS fold FROM panel")

register("dml_residuals", CAUSAL_HEAD + f"""
SELECT item_id, store_id, date, fold, {R6('m_y')} AS m_y, {R6('m_t')} AS m_t, {R6('r_y')} AS r_y, {R6('r_t')} AS r_t
FROM res""")

FX_OUT = (f"n, {R6('effect')} AS effect, {R6('se')} AS se, {R6('ci_lower')} AS ci_lower, "
          f"{R6('ci_upper')} AS ci_upper, {R6('tau')} AS tau, {R6('p_value')} AS p_value, "
          "CASE WHEN ci_lower > 0 OR ci_upper < 0 THEN 0.001 ELSE 0.5 END AS p_value_rule")

register("dml_segment_cate", CAUSAL_HEAD + ", " + seg_effects_sql(["cat_id"]).lstrip() + f"""
SELECT cat_id, {FX_OUT} FROM fx""")

register("dml_ate", CAUSAL_HEAD + ", " + seg_effects_sql(["cat_id"]).lstrip() + f""",
rows AS (SELECT fx.effect, fx.ci_lower, fx.ci_upper FROM res r JOIN fx ON r.cat_id = fx.cat_id),
a AS (SELECT avg(effect) AS ATE, avg(ci_lower) AS ci_lower, avg(ci_upper) AS ci_upper, count(*) AS n FROM rows)
SELECT {R6('ATE')} AS ATE, {R6('ci_lower')} AS ci_lower, {R6('ci_upper')} AS ci_upper, n,
       CASE WHEN ci_lower > 0 OR ci_upper < 0 THEN 0.001 ELSE 0.5 END AS p_value,
       (CASE WHEN ci_lower > 0 OR ci_upper < 0 THEN 0.001 ELSE 0.5 END) < 0.05 AS significant
FROM a""")

SERIES_FX = seg_effects_sql(["item_id", "store_id", "cat_id"], "res", "sfx").lstrip() + """,
elast AS (SELECT item_id, store_id, cat_id, tau, effect, n FROM sfx WHERE tau IS NOT NULL)"""

register("series_elasticity", CAUSAL_HEAD + ", " + SERIES_FX + f"""
SELECT item_id, store_id, cat_id, {R6('tau')} AS tau, {R6('effect')} AS effect, n FROM elast""")

register("dml_linear_cate", CAUSAL_HEAD + f""",
s AS (SELECT sum(r_t * r_t) AS a00, sum(r_t * r_t * price_rel_to_dept) AS a01,
             sum(r_t * price_rel_to_dept * r_t * price_rel_to_dept) AS a11,
             sum(r_t * r_y) AS b0, sum(r_t * price_rel_to_dept * r_y) AS b1 FROM res)
SELECT {R6('(a11 * b0 - a01 * b1) / (a00 * a11 - a01 * a01)')} AS b0,
       {R6('(a00 * b1 - a01 * b0) / (a00 * a11 - a01 * a01)')} AS b1 FROM s""")

BIN = CAUSAL.replace("sum(sell_price) AS st", "sum(treated) AS st").replace(
    "c.sell_price - coalesce(mt0, mt1, mt2) AS r_t", "c.treated - coalesce(mt0, mt1, mt2) AS r_t").replace(
    "price_change_pct, price_rel_to_dept, " + FOLD + " AS fold FROM f2)",
    "price_change_pct, price_rel_to_dept, " + FOLD + " AS fold, CAST(price_change_pct < 0 AS DOUBLE) AS treated "
    "FROM f2 WHERE price_change_pct IS NOT NULL)")

register("dml_binary_ate", with_(PANEL, CALENDAR, features_ctes(), BIN) + ", "
         + seg_effects_sql([], "res", "bfx").replace("avg(sell_price) AS mean_t", "avg(treated) AS mean_t").lstrip() + f"""
SELECT {R6('effect')} AS point_estimate, {R6('se')} AS se, {R6('ci_lower')} AS ci_lower,
       {R6('ci_upper')} AS ci_upper, {R6('p_value')} AS p_value, n FROM bfx""")

register("standardize", with_(PANEL) + f"""
SELECT item_id, store_id, date,
       {R6('(sales - (SELECT avg(sales) FROM panel)) / coalesce(nullif((SELECT stddev_pop(sales) FROM panel), 0.0), 1.0)')} AS sales,
       {R6('(sell_price - (SELECT avg(sell_price) FROM panel)) / coalesce(nullif((SELECT stddev_pop(sell_price) FROM panel), 0.0), 1.0)')} AS sell_price
FROM panel""")

register("ordinal_encode", with_(PANEL) + """,
hist AS (SELECT * FROM panel WHERE date < (SELECT CAST(max(date) - INTERVAL 28 DAY AS DATE) FROM panel)),
dic AS (SELECT item_id, CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_id_code
        FROM (SELECT DISTINCT item_id FROM hist))
SELECT p.item_id, p.store_id, p.date, coalesce(d.item_id_code, -1) AS item_id_code
FROM panel p LEFT JOIN dic d ON p.item_id = d.item_id""")


# ---- prescriptive and what-if --------------------------------------------------------------

PRESC_HEAD = with_(PANEL, CALENDAR, features_ctes(), CAUSAL, BACKTEST) + ", " + SERIES_FX + """,
cat_tau AS (SELECT cat_id, avg(tau) AS cat_tau FROM elast WHERE cat_id IS NOT NULL GROUP BY cat_id),
resolved AS (
  SELECT f.*, coalesce(e.tau, c.cat_tau, (SELECT avg(tau) FROM elast)) AS tau,
         CASE WHEN e.tau IS NOT NULL THEN 'series' WHEN c.cat_tau IS NOT NULL THEN 'category' ELSE 'global' END AS tau_source
  FROM forecasts f LEFT JOIN elast e ON f.item_id = e.item_id AND f.store_id = e.store_id
  LEFT JOIN cat_tau c ON f.cat_id = c.cat_id),
presc AS (SELECT *, p10 * (CASE WHEN tau IS NULL THEN NULL ELSE greatest(0.0, 1.0 + tau * -0.1) END) AS final_p10, p50 * (CASE WHEN tau IS NULL THEN NULL ELSE greatest(0.0, 1.0 + tau * -0.1) END) AS final_p50,
                 p90 * (CASE WHEN tau IS NULL THEN NULL ELSE greatest(0.0, 1.0 + tau * -0.1) END) AS final_p90 FROM resolved)"""

register("tau_by_category", CAUSAL_HEAD + ", " + SERIES_FX + f"""
SELECT cat_id, {R6('avg(tau)')} AS cat_tau FROM elast WHERE cat_id IS NOT NULL GROUP BY cat_id""")

register("elasticity_fallback", PRESC_HEAD + f"""
SELECT item_id, store_id, cat_id, horizon_step, {R6('tau')} AS tau, tau_source FROM resolved""")

register("prescriptive_forecast", PRESC_HEAD + f"""
SELECT item_id, store_id, cat_id, horizon_step, {R6('p10')} AS p10, {R6('p50')} AS p50, {R6('p90')} AS p90,
       {R6('tau')} AS tau, {R6('final_p10')} AS final_p10, {R6('final_p50')} AS final_p50, {R6('final_p90')} AS final_p90
FROM presc""")

register("whatif_grid", PRESC_HEAD + f""",
g AS (SELECT r.*, CAST(t.k AS DOUBLE) / 100.0 AS delta_p FROM resolved r CROSS JOIN range(-30, 31) t(k))
SELECT item_id, store_id, horizon_step, {R6('delta_p')} AS delta_p,
       {R6('p10 * (CASE WHEN tau IS NULL THEN NULL ELSE greatest(0.0, 1.0 + tau * delta_p) END)')} AS final_p10,
       {R6('p50 * (CASE WHEN tau IS NULL THEN NULL ELSE greatest(0.0, 1.0 + tau * delta_p) END)')} AS final_p50,
       {R6('p90 * (CASE WHEN tau IS NULL THEN NULL ELSE greatest(0.0, 1.0 + tau * delta_p) END)')} AS final_p90
FROM g""")

register("whatif_summary", PRESC_HEAD + f""",
per AS (SELECT item_id, store_id, any_value(cat_id) AS cat_id, sum(p50) AS base_volume, min(p10) AS min_p10
        FROM forecasts GROUP BY 1, 2),
bp AS (SELECT item_id, store_id, arg_max(sell_price, date) AS base_price FROM hist GROUP BY 1, 2),
pr AS (SELECT p.*, coalesce(e.tau, c.cat_tau, (SELECT avg(tau) FROM elast)) AS tau, e.tau AS own_tau, b.base_price
       FROM per p LEFT JOIN elast e ON p.item_id = e.item_id AND p.store_id = e.store_id
       LEFT JOIN cat_tau c ON p.cat_id = c.cat_id
       LEFT JOIN bp b ON p.item_id = b.item_id AND p.store_id = b.store_id),
g AS (SELECT pr.*, CAST(t.k AS DOUBLE) / 100.0 AS delta_p, (CASE WHEN tau IS NULL THEN NULL ELSE greatest(0.0, 1.0 + tau * (CAST(t.k AS DOUBLE) / 100.0)) END) AS m
      FROM pr CROSS JOIN range(-30, 31) t(k))
SELECT item_id, store_id, {R6('delta_p')} AS delta_p, {R6('tau')} AS tau, {R6('base_price')} AS base_price,
       {R6('base_price * (1 + delta_p)')} AS new_price, {R2('base_volume')} AS base_volume,
       {R2('base_volume * m')} AS new_volume, {R2('base_volume * base_price')} AS base_revenue,
       {R2('base_volume * m * base_price * (1 + delta_p)')} AS new_revenue,
       {R2('base_volume * m * base_price * (1 + delta_p) - base_volume * base_price')} AS revenue_impact,
       {R6('min_p10 * m')} AS min_downside,
       CASE WHEN min_p10 * m < 10 THEN 'High' WHEN min_p10 * m < 30 THEN 'Medium' ELSE 'Low' END AS stockout_risk,
       CASE WHEN coalesce(own_tau, 0.0) < -1.5 THEN 'Highly Elastic' ELSE 'Inelastic' END AS elasticity_label
FROM g""")

register("safety_stock", PRESC_HEAD + f"""
SELECT item_id, store_id, horizon_step, {R6('final_p90')} AS target_stock FROM presc""")

register("fan_chart_points", PRESC_HEAD + f""",
keys AS (SELECT DISTINCT item_id, store_id FROM presc),
hb AS (SELECT h.item_id, h.store_id, h.sales, row_number() OVER (PARTITION BY h.item_id, h.store_id ORDER BY h.date DESC) AS b
       FROM hist h JOIN keys k ON h.item_id = k.item_id AND h.store_id = k.store_id),
hh AS (SELECT * FROM hb WHERE b <= 30),
lines AS (SELECT item_id, store_id, horizon_step AS step, 'final_p10' AS kind, final_p10 AS value FROM presc
          UNION ALL SELECT item_id, store_id, horizon_step, 'final_p50', final_p50 FROM presc
          UNION ALL SELECT item_id, store_id, horizon_step, 'final_p90', final_p90 FROM presc
          UNION ALL SELECT item_id, store_id, 0, k.kind, sales FROM hh, (VALUES ('final_p10'), ('final_p50'), ('final_p90')) k(kind) WHERE b = 1
          UNION ALL SELECT item_id, store_id, CAST(-b AS INTEGER), 'history', sales FROM hh)
SELECT item_id, store_id, CAST(step AS INTEGER) AS step, kind, {R6('value')} AS value FROM lines""")

register("sink_roundtrip", with_(PANEL) + f"""
SELECT item_id, store_id, date, sales,
       coalesce({split_case("(SELECT CAST(max(date) - INTERVAL 28 DAY AS DATE) FROM panel)")}, 'none') AS split
FROM panel""")

_AUDIT_COLS = ["item_id", "store_id", "date", "sales", "sell_price", "sales_lag_1", "sales_lag_7",
               "sales_lag_14", "sales_lag_30"]

register("null_audit", with_(PANEL, DENSE) + f""",
d AS (SELECT item_id, store_id, date, sales, sell_price, lag(sales, 1) {W}) AS sales_lag_1,
             lag(sales, 7) {W}) AS sales_lag_7, lag(sales, 14) {W}) AS sales_lag_14,
             lag(sales, 30) {W}) AS sales_lag_30 FROM dense)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(*) AS n_rows FROM d"
    for c in _AUDIT_COLS))

EW = "OVER (PARTITION BY event_type, user_id ORDER BY day"

register("events_panel_features", f"""
WITH ep AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS DOUBLE) AS n_events,
         CAST(sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS value_sum
  FROM events GROUP BY 1, 2, 3)
SELECT user_id, event_type, day, n_events, {R6('value_sum')} AS value_sum,
       lag(n_events, 1) {EW}) AS n_events_lag_1, lag(n_events, 7) {EW}) AS n_events_lag_7,
       {R6(f"avg(n_events) {EW} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS n_events_rmean_7,
       {R6(f"stddev_samp(n_events) {EW} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS n_events_rstd_7,
       max(n_events) {EW} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS n_events_rmax_7
FROM ep""")

register("drop_counts", with_(PANEL) + f""",
w AS (SELECT row_number() {W}) - 1 AS rn, lag(sales, 7) {W}) AS l7 FROM panel)
SELECT 'warmup' AS step, (SELECT count(*) FROM panel) AS rows_before,
       (SELECT count(*) FROM w WHERE rn >= 30) AS rows_after,
       (SELECT count(*) FROM panel) - (SELECT count(*) FROM w WHERE rn >= 30) AS rows_dropped
UNION ALL
SELECT 'dropna', (SELECT count(*) FROM panel), (SELECT count(*) FROM w WHERE l7 IS NOT NULL),
       (SELECT count(*) FROM panel) - (SELECT count(*) FROM w WHERE l7 IS NOT NULL)""")


def _forecast_run_sql() -> str:
    np_ = null_policy_sql(feature_names(), 30, "f2").strip()
    head, final_select = np_.rsplit("\nSELECT ", 1)
    return (with_(PANEL, CALENDAR, features_ctes()) + ", " + head + ",\nfeats AS (SELECT " + final_select + "),"
            + """
timed AS (SELECT item_id, store_id, cat_id, date, sales, CAST(replace(d, 'd_', '') AS INTEGER) AS time_idx FROM feats),
cut AS (SELECT max(time_idx) - 28 AS c FROM timed),
hist AS (SELECT t.* FROM timed t, cut WHERE t.time_idx <= cut.c),
fut AS (SELECT t.* FROM timed t, cut WHERE t.time_idx > cut.c),""" + BACKTEST_MODEL + f"""
SELECT (SELECT count(*) FROM forecasts) AS n_predictions, count(*) AS n_evaluated,
       {R6('avg(abs(sales - p50))')} AS mae_p50, {R6(COV)} AS coverage,
       (SELECT {R6('avg(p90 - p10)')} FROM forecasts) AS mean_interval_width,
       (SELECT {R6('quantile_cont(p50, 0.5)')} FROM forecasts) AS median_p50
FROM fa""")


register("forecast_run_report", _forecast_run_sql())


# ---- the same queries on the (part, region) panel ------------------------------------------------

PART_PANEL = """
panel AS (
  SELECT CAST(l.l_partkey AS VARCHAR) AS item_id, r.r_name AS store_id,
         concat('D', CAST((CAST(substr(p.p_brand, 7) AS INTEGER) - 1) % 5 AS VARCHAR)) AS dept_id,
         CASE WHEN (CAST(substr(p.p_brand, 7) AS INTEGER) - 1) % 5 IN (0, 1) THEN 'C0' ELSE 'C1' END AS cat_id,
         r.r_name AS state_id, CAST(l.l_shipdate AS DATE) AS date,
         CAST(SUM(l.l_quantity) AS DOUBLE) AS sales,
         CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) / CAST(SUM(l.l_quantity) AS DOUBLE) AS sell_price
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
       JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2, 3, 4, 5, 6
)"""

for _name in ("panel_view", "entry_features", "forecast_seasonal_quantiles", "series_elasticity", "prescriptive_forecast",
              "whatif_summary"):
    register(f"part_{_name}", ORACLES[_name].replace(PANEL.strip(), PART_PANEL.strip()))

from . import model_oracles  # noqa: E402,F401  registers its statements here
