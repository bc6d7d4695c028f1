"""DuckDB SQL for the queries of ``model_queries`` (see ``oracle_sql``)."""

from __future__ import annotations

from .oracle_sql import CAUSAL_HEAD, ORACLES, PANEL, R6, W, register, with_

_LINEAR = CAUSAL_HEAD + f""",
lr AS (SELECT * FROM res WHERE r_y IS NOT NULL AND r_t IS NOT NULL AND price_rel_to_dept IS NOT NULL),
s AS (SELECT sum(r_t * r_t) AS a00, sum(r_t * r_t * price_rel_to_dept) AS a01,
             sum(r_t * price_rel_to_dept * r_t * price_rel_to_dept) AS a11,
             sum(r_t * r_y) AS b0, sum(r_t * price_rel_to_dept * r_y) AS b1, count(*) AS n FROM lr),
b AS (SELECT *, a00 * a11 - a01 * a01 AS d, (a11 * b0 - a01 * b1) / (a00 * a11 - a01 * a01) AS c0,
             (a00 * b1 - a01 * b0) / (a00 * a11 - a01 * a01) AS c1 FROM s),
e AS (SELECT r_t, price_rel_to_dept AS x, r_y - c0 * r_t - c1 * r_t * price_rel_to_dept AS e FROM lr, b),
m AS (SELECT sum(e * e * r_t * r_t) AS m00, sum(e * e * r_t * r_t * x) AS m01, sum(e * e * r_t * r_t * x * x) AS m11 FROM e),
u AS (SELECT item_id, store_id, date, c0 + c1 * price_rel_to_dept AS effect, (a11 - a01 * price_rel_to_dept) / d AS u0,
             (a00 * price_rel_to_dept - a01) / d AS u1, n FROM res, b),
v AS (SELECT *, sqrt((u0 * u0 * m00 + 2 * u0 * u1 * m01 + u1 * u1 * m11) * n / (n - 2.0)) AS se FROM u, m)
SELECT item_id, store_id, date, {R6('effect')} AS effect, {R6('se')} AS se,
       {R6('effect - 1.959963984540054 * se')} AS ci_lower, {R6('effect + 1.959963984540054 * se')} AS ci_upper FROM v"""
register("dml_linear_rows", _LINEAR)
register("dml_linear_saved", _LINEAR)

register("sample_slices", ORACLES["window_samples"])

register("fold_backtest", with_(PANEL.replace("panel AS (", "panel AS MATERIALIZED (")) + f""",
folds AS (SELECT CAST(i AS INTEGER) AS fold, CAST(m - INTERVAL (28 + (3 - i) * 28) DAY AS DATE) AS c
          FROM (SELECT max(date) AS m FROM panel), range(1, 4) t(i)),
r AS (SELECT item_id, store_id, date, sales, sales - lag(sales, 7) {W}) AS r FROM panel),
t AS (SELECT f.fold, r.*, row_number() OVER (PARTITION BY f.fold, item_id, store_id ORDER BY date DESC) AS back
      FROM r JOIN folds f ON r.date < f.c - INTERVAL 1 DAY),
s AS (SELECT fold, item_id, store_id, arg_max(sales, date) AS last, count(r) FILTER (WHERE back <= 90) AS n,
             quantile_cont(r, 0.1) FILTER (WHERE back <= 90) AS q10, quantile_cont(r, 0.5) FILTER (WHERE back <= 90) AS q50,
             quantile_cont(r, 0.9) FILTER (WHERE back <= 90) AS q90 FROM t GROUP BY ALL),
a AS (SELECT f.fold, p.item_id, p.store_id, p.sales AS y, row_number() OVER (PARTITION BY f.fold, p.item_id, p.store_id ORDER BY p.date) AS h
      FROM panel p JOIN folds f ON p.date >= f.c AND p.date < f.c + INTERVAL 28 DAY),
b AS (SELECT a.fold, a.item_id, a.store_id, a.y, coalesce(t.sales, s.last) AS base,
             CASE WHEN n >= 14 THEN q10 ELSE 0 END AS q10, CASE WHEN n >= 14 THEN q50 ELSE 0 END AS q50,
             CASE WHEN n >= 14 THEN q90 ELSE 0 END AS q90
      FROM a JOIN s USING (fold, item_id, store_id)
      LEFT JOIN t ON t.fold = a.fold AND t.item_id = a.item_id AND t.store_id = a.store_id AND t.back = 7 - (a.h - 1) % 7
      WHERE a.h <= 28),
p AS (SELECT fold, item_id, store_id, y, greatest(base + q10, 0) AS p10, greatest(base + q50, 0) AS p50, greatest(base + q90, 0) AS p90 FROM b)
SELECT fold, count(*) AS n_rows, count(DISTINCT item_id || '|' || store_id) AS n_series, {R6('avg(abs(y - p50))')} AS mae,
       {R6('avg(p50 - y)')} AS bias, {R6('avg(CAST(y >= p10 AND y <= p90 AS DOUBLE))')} AS coverage,
       {R6('''2 * sum(greatest(0.1 * (y - p10), -0.9 * (y - p10)) + greatest(0.5 * (y - p50), -0.5 * (y - p50))
                 + greatest(0.9 * (y - p90), -0.1 * (y - p90))) / 3 / sum(abs(y))''')} AS wql
FROM p GROUP BY fold""")

register("best_model_per_series", with_(PANEL.replace("panel AS (", "panel AS MATERIALIZED (")) + """,
c AS (SELECT CAST(max(date) - INTERVAL 28 DAY AS DATE) AS c FROM panel),
h AS (SELECT item_id, store_id, date, sales, row_number() OVER (PARTITION BY item_id, store_id ORDER BY date DESC) AS back
      FROM panel, c WHERE date < c.c),
s AS (SELECT item_id, store_id, arg_min(sales, back) AS last, avg(sales) FILTER (WHERE back <= 90) AS mean,
             arg_max(sales, back) FILTER (WHERE back <= 90) AS first, max(back) FILTER (WHERE back <= 90) AS n FROM h GROUP BY ALL),
v AS (SELECT item_id, store_id, sales AS y, row_number() OVER (PARTITION BY item_id, store_id ORDER BY date) AS step
      FROM panel, c WHERE date >= c.c AND date < c.c + INTERVAL 28 DAY),
e AS (SELECT s.item_id, s.store_id, v.y, v.step, s.last, s.mean, coalesce(h.sales, s.last) AS seasonal,
             s.last + coalesce((s.last - s.first) / nullif(s.n - 1, 0), 0) * v.step AS drift
      FROM s LEFT JOIN v ON s.item_id = v.item_id AND s.store_id = v.store_id AND v.step <= 28
      LEFT JOIN h ON h.item_id = s.item_id AND h.store_id = s.store_id AND h.back = 7 - (v.step - 1) % 7),
m AS (SELECT item_id, store_id, count(y) AS n_val, avg(abs(y - greatest(drift, 0))) AS drift, avg(abs(y - greatest(mean, 0))) AS mean,
             avg(abs(y - greatest(last, 0))) AS naive, avg(abs(y - greatest(seasonal, 0))) AS seasonal FROM e GROUP BY ALL)
SELECT item_id, store_id, CASE WHEN n_val = 0 THEN 'naive' WHEN drift <= least(mean, naive, seasonal) THEN 'drift'
            WHEN mean <= least(naive, seasonal) THEN 'mean' WHEN naive <= seasonal THEN 'naive' ELSE 'seasonal' END AS model,
       """ + R6("least(drift, mean, naive, seasonal)") + " AS val_mae, " + R6("naive") + " AS naive_mae, n_val FROM m")

register("growable_dictionary", """
WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS customer, min(CAST(o_orderdate AS DATE)) AS first FROM orders GROUP BY 1)
SELECT customer, CAST(row_number() OVER (ORDER BY first >= DATE '1994-01-01', customer) - 1 AS INTEGER) AS customer_code FROM o""")

register("stable_narrowing", """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_partkey AS BIGINT) AS l_partkey
FROM lineitem""")
