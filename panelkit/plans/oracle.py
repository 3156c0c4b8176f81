"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark plans: window functions, ASOF JOIN and
plain aggregates over the pre-registered driver views.
"""

OM = """(SELECT strftime(o_orderdate, '%Y-%m') AS year_month, COUNT(*) AS n_orders,
        CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_value
        FROM orders GROUP BY 1)"""

LM = """(SELECT strftime(l_shipdate, '%Y-%m') AS year_month, COUNT(*) AS n_lines,
        SUM(l_quantity) AS qty,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS ship_value,
        CAST(SUM(CAST(l_discount AS DECIMAL(18,4))) AS DOUBLE) / COUNT(l_discount) AS avg_discount,
        CAST(SUM(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) / COUNT(l_tax) AS avg_tax
        FROM lineitem GROUP BY 1)"""

NP = """(SELECT c_nationkey AS nation_key, strftime(o_orderdate, '%Y-%m') AS year_month, COUNT(*) AS n_orders,
        CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_value
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

DEC = """(WITH d AS (SELECT c_custkey, CAST(NTILE(10) OVER (ORDER BY c_acctbal, c_custkey) AS INTEGER) AS decile FROM customer),
             y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
                          SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1, 2)
         SELECT decile, year, CAST(SUM(total) AS DOUBLE) / COUNT(*) AS income
         FROM y JOIN d ON o_custkey = c_custkey GROUP BY 1, 2)"""

RATE = """(SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
          CAST(SUM(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) / COUNT(l_tax) * 100 AS rate
          FROM lineitem GROUP BY 1)"""

LMC = ["n_lines", "qty", "ship_value", "avg_discount", "avg_tax"]


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def _pearson_sql(src: str, cols, digits=6, a_name=None):
    parts = []
    for a, b in _pairs(cols):
        parts.append(f"SELECT '{a}' AS a, '{b}' AS b, ROUND(CASE WHEN stddev_pop({a}) * stddev_pop({b}) = 0 THEN NULL "
                     f"ELSE covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END, {digits}) AS r FROM {src}")
    return " UNION ALL ".join(parts)


def _ranked(src, cols):
    rk = ", ".join(f"rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in cols)
    return f"(SELECT {rk} FROM {src} WHERE {' AND '.join(c + ' IS NOT NULL' for c in cols)})"


SQL = {}

SQL["macro_merge"] = f"""
SELECT l.year_month, l.n_lines, l.qty, l.ship_value, l.avg_discount, l.avg_tax, o.n_orders, o.order_value,
       'ALL' AS geo_name, 'orders+lineitem' AS source_note
FROM {LM} l LEFT JOIN {OM} o USING (year_month)"""

SQL["structural_missing"] = "WITH p AS (SELECT l.*, o.n_orders, o.order_value, o.year_month IS NULL AS absent FROM " + LM + \
    " l LEFT JOIN " + OM + " o USING (year_month))\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT(*) FILTER (WHERE {c} IS NULL) AS total, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL AND {'absent' if c in ('n_orders', 'order_value') else 'false'}) AS structural, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) - COUNT(*) FILTER (WHERE {c} IS NULL AND {'absent' if c in ('n_orders', 'order_value') else 'false'}) AS accidental FROM p"
        for c in LMC + ["n_orders", "order_value"])

SQL["asof_day_end"] = """
WITH b AS (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events),
spine AS (SELECT t.event_type, CAST(g.d AS DATE) AS day
          FROM (SELECT DISTINCT event_type FROM events) t, b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)),
ev AS (SELECT event_type, ts, arg_max(value, event_id) AS value, MAX(event_id) AS event_id FROM events GROUP BY 1, 2)
SELECT s.event_type, strftime(s.day, '%Y-%m-%d') AS day, e.value, e.event_id
FROM spine s ASOF LEFT JOIN ev e ON s.event_type = e.event_type AND CAST(s.day + INTERVAL 1 DAY AS TIMESTAMP) > e.ts"""

SQL["asof_month_end_status"] = """
WITH ev AS (SELECT c_nationkey AS nation_key, o_orderdate AS ts, arg_max(o_totalprice, o_orderkey) AS o_totalprice,
                   MAX(o_orderkey) AS o_orderkey
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
b AS (SELECT MIN(date_trunc('month', o_orderdate)) AS lo, MAX(date_trunc('month', o_orderdate)) AS hi FROM orders),
spine AS (SELECT n_nationkey AS nation_key, CAST(g.m AS DATE) AS month
          FROM nation, b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 MONTH) g(m))
SELECT s.nation_key, strftime(s.month, '%Y-%m') AS year_month, e.o_totalprice, e.o_orderkey
FROM spine s ASOF LEFT JOIN ev e ON s.nation_key = e.nation_key AND CAST(last_day(s.month) AS TIMESTAMP) >= e.ts"""

SQL["keep_last"] = """
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice, o_orderstatus FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1"""

SQL["keep_first"] = """
SELECT doc_id, lang, source, n_chars FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"""

SQL["dup_report"] = """
SELECT lang, CAST(SUM(n) AS BIGINT) AS n_docs, COUNT(*) AS distinct_texts, CAST(SUM(n - 1) AS BIGINT) AS duplicates
FROM (SELECT lang, text, COUNT(*) AS n FROM documents GROUP BY 1, 2) GROUP BY 1"""

SQL["latest_n"] = f"""
SELECT nation_key, year_month, n_orders, order_value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY nation_key ORDER BY year_month DESC) AS rn FROM {NP}) WHERE rn <= 12"""

SQL["latest_periods"] = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_year, o_totalprice FROM orders
WHERE year(o_orderdate) IN (SELECT DISTINCT year(o_orderdate) AS y FROM orders ORDER BY y DESC LIMIT 5)"""

SQL["lag_features"] = f"""
SELECT * FROM (
  SELECT year_month, n_orders, order_value,
         LAG(n_orders, 1) OVER w AS n_orders_lag1, LAG(n_orders, 3) OVER w AS n_orders_lag3,
         LAG(order_value, 1) OVER w AS order_value_lag1
  FROM {OM} WINDOW w AS (ORDER BY year_month))
WHERE n_orders_lag1 IS NOT NULL AND n_orders_lag3 IS NOT NULL AND order_value_lag1 IS NOT NULL"""

SQL["running_max_drop"] = f"""
WITH p AS (SELECT *, MAX(order_value) OVER (PARTITION BY nation_key ORDER BY year_month
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rmax FROM {NP}),
f AS (SELECT nation_key, MIN(CASE WHEN n_orders >= 10 THEN year_month END) AS first_rise,
             MIN(CASE WHEN order_value < rmax THEN year_month END) AS first_drop FROM p GROUP BY 1),
k AS (SELECT nation_key, year_month AS peak_year_month, order_value AS peak_order_value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY nation_key ORDER BY order_value DESC, year_month) AS rn FROM p)
      WHERE rn = 1)
SELECT * FROM f JOIN k USING (nation_key)"""

SQL["index100"] = f"""
SELECT nation_key, year_month, order_value,
       ROUND(order_value / FIRST_VALUE(order_value) OVER (PARTITION BY nation_key ORDER BY year_month) * 100, 4) AS order_value_index
FROM {NP}"""

SQL["base_period_index"] = f"""
SELECT decile, year, income,
       ROUND(income / MAX(CASE WHEN year = 1996 THEN income END) OVER (PARTITION BY decile) * 100, 4) AS income_index
FROM {DEC}"""

SQL["price_level"] = f"""
SELECT year, rate,
       ROUND(PRODUCT(CASE WHEN year = 1995 THEN 1.0 ELSE 1 + rate / 100 END)
             OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS price_level
FROM {RATE} WHERE year >= 1995"""

SQL["gap_check"] = """
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, strftime(prev_day, '%Y-%m-%d') AS prev_day,
       CAST(day - prev_day AS INTEGER) AS gap FROM (
  SELECT user_id, day, LAG(day) OVER (PARTITION BY user_id ORDER BY day) AS prev_day
  FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events))
WHERE prev_day IS NOT NULL AND day - prev_day <> 1"""

SQL["chrono_split"] = f"""
SELECT nation_key, split, COUNT(*) AS n_rows FROM (
  SELECT nation_key, CASE WHEN ROW_NUMBER() OVER (PARTITION BY nation_key ORDER BY year_month)
                              <= FLOOR(COUNT(*) OVER (PARTITION BY nation_key) * 0.8) THEN 'train' ELSE 'test' END AS split
  FROM {NP}) GROUP BY 1, 2"""

SQL["latest_row"] = """
WITH n AS (SELECT event_type, event_id AS latest_event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS latest_ts,
                  value AS latest_value FROM (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
           WHERE rn = 1),
m AS (SELECT event_type, event_id AS max_event_id, value AS max_value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value DESC, ts, event_id) AS rn FROM events) WHERE rn = 1)
SELECT * FROM n JOIN m USING (event_type)"""

SQL["profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, COUNT({c}) AS count, CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({c}) AS mean, ROUND(STDDEV_SAMP({c}), 4) AS std, "
    f"MIN({c}) AS min, MAX({c}) AS max, ROUND(QUANTILE_CONT({c}, 0.5), 4) AS median FROM lineitem"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])

SQL["describe"] = """
SELECT l_returnflag, COUNT(l_extendedprice) AS count,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_extendedprice) AS mean,
       ROUND(STDDEV_SAMP(l_extendedprice), 4) AS std, ROUND(MIN(l_extendedprice), 4) AS min,
       ROUND(QUANTILE_CONT(l_extendedprice, 0.25), 4) AS p25, ROUND(QUANTILE_CONT(l_extendedprice, 0.5), 4) AS p50,
       ROUND(QUANTILE_CONT(l_extendedprice, 0.75), 4) AS p75, ROUND(MAX(l_extendedprice), 4) AS max
FROM lineitem GROUP BY 1"""

SQL["value_counts"] = """
SELECT label, count, CAST(ROW_NUMBER() OVER (ORDER BY CASE label WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 END NULLS LAST,
                                        count DESC, label) AS INTEGER) AS order_rank
FROM (SELECT COALESCE(o_orderpriority, 'unknown') AS label, COUNT(*) AS count FROM orders GROUP BY 1)"""

SQL["conditional_counts"] = """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, COUNT(*) AS row_count, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) AS mean_value,
       COUNT(*) FILTER (WHERE value > 100) AS high_count,
       COUNT(*) FILTER (WHERE value <= 100 AND value >= 10) AS mid_count,
       COUNT(*) FILTER (WHERE value < 10) AS low_count
FROM events GROUP BY 1, 2"""

SQL["coverage"] = """
SELECT o_orderstatus, COALESCE(MIN(ym) || ' to ' || MAX(ym), 'no rows') AS coverage, COUNT(*) AS rows,
       COUNT(DISTINCT ym) AS distinct_periods, COUNT(DISTINCT ym) = COUNT(*) AS unique_periods
FROM (SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m') AS ym FROM orders) GROUP BY 1"""

SQL["pearson"] = _pearson_sql(LM, LMC)
SQL["spearman"] = _pearson_sql(_ranked(LM, LMC), LMC)
SQL["corr_gap"] = f"""
WITH p AS ({_pearson_sql(LM, LMC, digits=17)}), s AS ({_pearson_sql(_ranked(LM, LMC), LMC, digits=17)})
SELECT a, b, ROUND(p.r, 6) AS pearson, ROUND(s.r, 6) AS spearman, ROUND(p.r - s.r, 6) AS gap
FROM p JOIN s USING (a, b) WHERE ABS(p.r - s.r) > 0.05"""

_LAGGED = f"""(SELECT l.*, LAG(o.n_orders, 1) OVER (ORDER BY year_month) AS n_orders_lag1,
               LAG(o.n_orders, 3) OVER (ORDER BY year_month) AS n_orders_lag3
               FROM {OM} o JOIN {LM} l USING (year_month))"""
SQL["lagged_corr"] = " UNION ALL ".join(
    f"SELECT {n} AS lag, '{y}' AS b_name, ROUND(covar_pop(n_orders_lag{n}, {y}) / (stddev_pop(n_orders_lag{n}) * stddev_pop({y})), 6) AS r "
    f"FROM (SELECT * FROM {_LAGGED} WHERE n_orders_lag{n} IS NOT NULL AND {' AND '.join(c + ' IS NOT NULL' for c in LMC)})"
    for n in (1, 3) for y in LMC).replace("AS b_name", "AS y")

SQL["histogram"] = """
WITH b AS (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi FROM orders),
x AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE LEAST(FLOOR((o_totalprice - lo) / (hi - lo) * 12) + 1, 12) END AS INTEGER) AS bin, lo, hi
      FROM orders, b WHERE o_totalprice IS NOT NULL)
SELECT bin, COUNT(*) AS count, ROUND(lo + (bin - 1) * (hi - lo) / 12, 4) AS bin_lo, ROUND(lo + bin * (hi - lo) / 12, 4) AS bin_hi
FROM x GROUP BY bin, lo, hi"""

SQL["sigma_outliers"] = """
WITH s AS (SELECT event_type, AVG(value) - 3 * STDDEV_SAMP(value) AS lower, AVG(value) + 3 * STDDEV_SAMP(value) AS upper
           FROM events WHERE value IS NOT NULL GROUP BY 1)
SELECT event_type, 'value' AS column, ROUND(lower, 4) AS lower, ROUND(upper, 4) AS upper,
       COUNT(*) FILTER (WHERE value < lower OR value > upper) AS outliers
FROM events JOIN s USING (event_type) WHERE value IS NOT NULL GROUP BY event_type, lower, upper"""

_NAIVE = f"""(SELECT year_month, order_value AS y_true, lag1 AS naive_last, (lag1 + lag2 + lag3) / 3 AS naive_mean3 FROM (
   SELECT year_month, order_value, LAG(order_value, 1) OVER w AS lag1, LAG(order_value, 2) OVER w AS lag2,
          LAG(order_value, 3) OVER w AS lag3 FROM {OM} WINDOW w AS (ORDER BY year_month))
   WHERE lag1 IS NOT NULL AND lag2 IS NOT NULL AND lag3 IS NOT NULL)"""
_LONG = f"""(SELECT year_month, y_true, 'naive_last' AS model, naive_last AS y_pred FROM {_NAIVE}
            UNION ALL SELECT year_month, y_true, 'naive_mean3', naive_mean3 FROM {_NAIVE})"""

SQL["reg_metrics"] = f"""
WITH m AS (SELECT model, ROUND(AVG(ABS(y_pred - y_true)), 3) AS mae, ROUND(SQRT(AVG((y_pred - y_true) ^ 2)), 3) AS rmse,
                  ROUND(1 - SUM((y_pred - y_true) ^ 2) / NULLIF(VAR_POP(y_true) * COUNT(y_true), 0), 3) AS r2,
                  COUNT(*) AS n_rows FROM {_LONG} GROUP BY 1),
b AS (SELECT * FROM m WHERE model = 'naive_last')
SELECT m.*, ROUND(b.mae - m.mae, 3) AS mae_improvement, ROUND(b.rmse - m.rmse, 3) AS rmse_improvement,
       ROUND(m.r2 - b.r2, 3) AS r2_improvement FROM m LEFT JOIN b ON true"""

SQL["pivot_year"] = f"""
WITH d AS (SELECT * FROM {DEC})
SELECT x.decile, 'y' || y.year AS column, d.income
FROM (SELECT DISTINCT decile FROM d) x CROSS JOIN (SELECT DISTINCT year FROM d) y LEFT JOIN d ON d.decile = x.decile AND d.year = y.year"""

SQL["unpivot_predictions"] = f"""
SELECT year_month, model, y_true, ROUND(y_pred, 4) AS y_pred, ROUND(y_pred - y_true, 4) AS residual,
       ROUND(ABS(y_pred - y_true), 4) AS absolute_error,
       CAST(year(CAST(year_month || '-01' AS DATE)) AS VARCHAR) || 'Q' || CAST(quarter(CAST(year_month || '-01' AS DATE)) AS VARCHAR) AS quarter
FROM {_LONG}"""

SQL["intersect_periods"] = f"SELECT year_month, o.n_orders, l.n_lines FROM {OM} o JOIN {LM} l USING (year_month)"

SQL["any_column_search"] = "SELECT * FROM part WHERE " + " OR ".join(
    f"COALESCE(regexp_matches(CAST({c} AS VARCHAR), '(?i)ring|brand#1[0-2]$|economy'), false)"
    for c in ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])

SQL["typed_filters"] = """
SELECT o_orderkey, o_custkey, o_totalprice, NOT (o_totalprice BETWEEN 60000 AND 250000) AS implausible
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'F' AND lower(c_mktsegment) = 'building' AND o_totalprice BETWEEN 50000 AND 300000
  AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""

SQL["date_parse"] = """
SELECT o_orderkey, upper(strftime(o_orderdate, '%Y %b')) AS month_label,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
       strftime(o_orderdate, '%Y-%m-%d') AS dayfirst_date, strftime(o_orderdate, '%Y-%m-%d') AS two_digit_date,
       strftime(o_orderdate, '%Y-%m') AS year_month, strftime(o_orderdate, '%Y-%m-%d') AS stamp_date,
       o_totalprice AS price
FROM orders"""

SQL["fiscal_period"] = """
WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n_orders FROM orders GROUP BY 1),
l AS (SELECT year, n_orders, 'short_dash' AS layout, CAST(year AS VARCHAR) || '-' || lpad(CAST((year + 1) % 100 AS VARCHAR), 2, '0') AS label FROM y
      UNION ALL SELECT year, n_orders, 'short_slash', CAST(year AS VARCHAR) || '/' || lpad(CAST((year + 1) % 100 AS VARCHAR), 2, '0') FROM y
      UNION ALL SELECT year, n_orders, 'long_dash', CAST(year AS VARCHAR) || '-' || CAST(year + 1 AS VARCHAR) FROM y
      UNION ALL SELECT year, n_orders, 'single', CAST(year AS VARCHAR) FROM y)
SELECT year, n_orders, layout, label,
       CAST(CASE WHEN layout = 'single' THEN year ELSE year + 1 END AS VARCHAR) || '-03' AS period_end,
       year AS period_start
FROM l"""

LEVEL = f"""(SELECT year, ROUND(PRODUCT(CASE WHEN year = 1995 THEN 1.0 ELSE 1 + rate / 100 END)
             OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS price_level
             FROM {RATE} WHERE year >= 1995)"""

SQL["real_income"] = f"""
WITH r AS (SELECT d.decile, d.year, l.price_level, d.income / l.price_level AS real_income
           FROM {DEC} d LEFT JOIN {LEVEL} l USING (year))
SELECT decile, year, price_level,
       ROUND(real_income / MAX(CASE WHEN year = 1995 THEN real_income END) OVER (PARTITION BY decile) * 100, 1) AS real_index
FROM r"""

SQL["real_change"] = f"""
WITH r AS (SELECT d.decile, d.year, d.income / l.price_level AS real_income
           FROM {DEC} d LEFT JOIN {LEVEL} l USING (year) WHERE d.year IN (1995, 2000))
SELECT decile, ROUND(MAX(CASE WHEN year = 1995 THEN real_income END), 2) AS start_real,
       ROUND(MAX(CASE WHEN year = 2000 THEN real_income END), 2) AS end_real,
       ROUND((MAX(CASE WHEN year = 2000 THEN real_income END) / MAX(CASE WHEN year = 1995 THEN real_income END) - 1) * 100, 1)
         AS real_change_pct
FROM r GROUP BY 1"""

PRICE = """(SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(p_retailprice) AS price
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)"""

SQL["pressure_gap"] = f"""
WITH yrs AS (SELECT year FROM {PRICE} INTERSECT SELECT year FROM {DEC}),
b AS (SELECT MIN(year) AS y0, MAX(year) AS y1 FROM yrs),
p AS (SELECT MAX(CASE WHEN year = y0 THEN price END) AS p0, MAX(CASE WHEN year = y1 THEN price END) AS p1 FROM {PRICE}, b),
i AS (SELECT decile, y0, y1, MAX(CASE WHEN year = y0 THEN income END) AS i0, MAX(CASE WHEN year = y1 THEN income END) AS i1
      FROM {DEC}, b GROUP BY decile, y0, y1)
SELECT decile, y0 AS base_year, y1 AS end_year, ROUND(p1 / p0 * 100, 1) AS price_index, ROUND(i1 / i0 * 100, 1) AS income_index,
       ROUND(p1 / p0 * 100 - i1 / i0 * 100, 1) AS gap, ROUND(p1 / p0 * 100 - 100, 2) AS price_growth,
       ROUND(i1 / i0 * 100 - 100, 2) AS income_growth
FROM i, p"""

SQL["turning_points"] = f"""
WITH s AS (SELECT year_month, n_orders, order_value,
                  MAX(order_value) OVER (ORDER BY year_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rmax
           FROM {OM})
SELECT MIN(CASE WHEN n_orders > (SELECT n_orders FROM s ORDER BY year_month LIMIT 1) THEN year_month END) AS first_rise,
       (SELECT year_month FROM s ORDER BY order_value DESC, year_month LIMIT 1) AS peak_month,
       MAX(order_value) AS peak_value,
       MIN(CASE WHEN order_value < rmax THEN year_month END) AS first_cut
FROM s"""

SQL["burden"] = f"""
WITH c AS (SELECT ROUND(order_value / n_orders * 0.75 * 0.01, 0) AS extra_annual_cost
           FROM {OM} ORDER BY year_month DESC LIMIT 1),
s AS (SELECT decile, income, extra_annual_cost, ROUND(extra_annual_cost / income * 100, 2) AS burden_share
      FROM {DEC}, c WHERE year = 2000)
SELECT decile, income, extra_annual_cost, burden_share,
       ROUND((SELECT MAX(CASE WHEN decile = 1 THEN burden_share END) / MAX(CASE WHEN decile = 10 THEN burden_share END) FROM s), 4)
         AS extremes_ratio
FROM s"""

_LEX = [
    ("tion", 1.0, "w"), ("ble", 0.5, "w"), ("sch", 1.5, "w"), ("ung", 1.0, "w"), ("que", 0.75, "w"),
    ("ción", 1.25, "w"), ("thr", 0.5, "w"), ("crisis", 2.0, "w"), ("higher", 1.0, "w"), ("pressure", 1.5, "w"),
    ("eau", 1.0, "r"), ("ment", 0.5, "r"), ("ier", 0.75, "r"), ("ist", 1.0, "r"), ("ein", 0.5, "r"),
    ("ado", 1.25, "r"), ("aux", 0.5, "r"), ("ease", 1.5, "r"), ("relief", 2.0, "r"), ("lower", 1.0, "r"),
]
_FIX = [("â€™", "'"), ("â€˜", "'"), ("â€œ", '"'), ("â€\u009d", '"'), ("â€“", "-"), ("â€”", "-"),
        ("â€¦", "..."), ("Â£", "£"), ("Â ", " "), ("Ã©", "é")]


def _q(s):
    return "'" + s.replace("'", "''") + "'"


def _repaired(col):
    e = f"COALESCE({col}, '')"
    for a, b in _FIX:
        e = f"replace({e}, {_q(a)}, {_q(b)})"
    return f"lower(trim({e}))"


def _score_sql(src, id_cols):
    w = " + ".join(f"CASE WHEN contains(t, {_q(p)}) THEN {wt} ELSE 0.0 END" for p, wt, k in _LEX if k == "w")
    r = " + ".join(f"CASE WHEN contains(t, {_q(p)}) THEN {wt} ELSE 0.0 END" for p, wt, k in _LEX if k == "r")
    wn = " + ".join(f"CASE WHEN contains(t, {_q(p)}) THEN 1 ELSE 0 END" for p, wt, k in _LEX if k == "w")
    rn = " + ".join(f"CASE WHEN contains(t, {_q(p)}) THEN 1 ELSE 0 END" for p, wt, k in _LEX if k == "r")
    return f"""(SELECT {id_cols}, W, R, worsening_hits, relief_hits, W / (W + R + 1) AS worsening, R / (W + R + 1) AS relief,
       (W - R) / (W + R + 1) AS score, (R - W) / (W + R + 1) AS net,
       CASE WHEN (W - R) / (W + R + 1) > 0.1 THEN 'worsening' WHEN (W - R) / (W + R + 1) < -0.1 THEN 'relief'
            ELSE 'neutral' END AS label
   FROM (SELECT {id_cols}, CAST({w} AS DOUBLE) AS W, CAST({r} AS DOUBLE) AS R, CAST({wn} AS INTEGER) AS worsening_hits,
                CAST({rn} AS INTEGER) AS relief_hits
         FROM (SELECT {id_cols}, {_repaired('text')} AS t FROM {src})))"""


SQL["lexicon_score"] = f"""
SELECT doc_id, worsening_hits, relief_hits, W, R, ROUND(worsening, 6) AS worsening, ROUND(relief, 6) AS relief,
       ROUND(score, 6) AS score, ROUND(net, 6) AS net, label FROM {_score_sql('documents', 'doc_id')}"""

SQL["text_panel"] = f"""
WITH clean AS (SELECT doc_id, text, source FROM (
   SELECT *, ROW_NUMBER() OVER (PARTITION BY regexp_replace(text, '^\\s+|\\s+$', '', 'g') ORDER BY doc_id) AS rn FROM documents
   WHERE COALESCE(trim(text), '') <> '') WHERE rn = 1)
SELECT strftime(make_date(2024, CAST(doc_id % 12 + 1 AS INTEGER), 1), '%Y-%m') AS month, source, COUNT(*) AS n_docs,
       ROUND(AVG(worsening), 6) AS avg_worsening, ROUND(AVG(relief), 6) AS avg_relief, ROUND(AVG(score), 6) AS avg_score,
       ROUND(AVG(net), 6) AS avg_net, COUNT(*) FILTER (WHERE label = 'worsening') AS worsening_count,
       COUNT(*) FILTER (WHERE label = 'relief') AS relief_count, COUNT(*) FILTER (WHERE label = 'neutral') AS neutral_count
FROM {_score_sql('clean', 'doc_id, source')} GROUP BY 1, 2"""

SQL["phrase_audit"] = """
SELECT d.doc_id, COUNT(b.item_id) AS hit_count,
       (length(trim(COALESCE(d.text, ''))) > 0 AND COUNT(b.item_id) = 0) AS passes
FROM documents d LEFT JOIN benchmark b ON length(b.text) > 0 AND contains(d.text, b.text)
GROUP BY d.doc_id, d.text"""

_KIND = """CASE WHEN contains(lower(substr(p, 1, 1000)), '<html') OR contains(lower(substr(p, 1, 1000)), '<!doctype html') THEN 'html'
     WHEN starts_with(p, 'PK') THEN 'excel'
     WHEN contains(p, ',') AND contains(p, chr(10)) THEN 'delimited' ELSE 'other' END"""
SQL["payload_kind"] = f"""
SELECT 'pages' AS source, page_id AS id, {_KIND.replace('p,', 'html,').replace('(p)', '(html)')} AS kind FROM pages
UNION ALL
SELECT 'documents', doc_id, {_KIND.replace('p,', 'text,')} FROM documents"""

SQL["extract_links"] = """
WITH m AS (SELECT page_id, 'primary' AS rule, replace(UNNEST(l), '&amp;', '&') AS raw, generate_subscripts(l, 1) AS i
           FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages)),
f AS (SELECT page_id, 'fallback' AS rule, replace(UNNEST(l), '&amp;', '&') AS raw, generate_subscripts(l, 1) AS i
      FROM (SELECT page_id, regexp_extract_all(html, 'src="([^"]+)"', 1) AS l FROM pages)
      WHERE page_id NOT IN (SELECT page_id FROM m)),
a AS (SELECT page_id, rule, raw, MIN(i) AS first_i FROM (SELECT * FROM m UNION ALL SELECT * FROM f) GROUP BY 1, 2, 3)
SELECT page_id, CAST(ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY first_i) AS INTEGER) AS pos,
       raw AS link, rule FROM a"""

SQL["latest_snapshot"] = """
SELECT host, page_id, url FROM (
  SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) AS host,
         ROW_NUMBER() OVER (PARTITION BY lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1))
           ORDER BY COALESCE(TRY_CAST(regexp_extract(url, '/(\\d+)(?:[?#]|$)', 1) AS BIGINT), 0) DESC,
                    CASE WHEN starts_with(lower(url), 'https:') THEN 2 ELSE 1 END DESC,
                    CASE WHEN starts_with(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)), 'www.') THEN 1 ELSE 0 END DESC,
                    lower(url) DESC) AS rn
  FROM pages) WHERE rn = 1"""

_OLS = f"""(SELECT regr_intercept(order_value / 1000000.0, n_orders) AS a, regr_slope(order_value / 1000000.0, n_orders) AS b,
           AVG(n_orders) AS mx, MIN(n_orders) AS lo, MAX(n_orders) AS hi FROM {OM})"""

SQL["ols"] = f"""
SELECT 'intercept' AS term, ROUND(a, 4) AS estimate FROM {_OLS}
UNION ALL SELECT 'n_orders', ROUND(b, 4) FROM {_OLS}"""

SQL["scenario"] = f"""
SELECT 'linear' AS model, ROUND(a + b * mx, 4) AS mean_baseline, ROUND(a + b * (mx + 1), 4) AS mean_scenario,
       ROUND(b, 4) AS mean_delta, ROUND(b / (a + b * mx) * 100, 4) AS pct_change, n AS n_rows
FROM {_OLS}, (SELECT COUNT(*) AS n FROM {OM})"""

SQL["scenario_range"] = f"""
SELECT 'n_orders' AS feature, MIN(n_orders) AS observed_min, MAX(n_orders) AS observed_max,
       CAST(MAX(n_orders) + 25.0 AS DOUBLE) AS shocked_max, MAX(n_orders) + 25.0 > MAX(n_orders) AS out_of_range,
       COUNT(*) FILTER (WHERE n_orders + 25.0 > (SELECT MAX(n_orders) FROM {OM})) AS rows_out_of_range
FROM {OM}"""

SQL["scenario_grid"] = f"""
SELECT CAST(g.x AS BIGINT) AS n_orders, ROUND(a + b * g.x, 4) AS prediction
FROM {_OLS}, generate_series(CAST(lo AS BIGINT), CAST(hi AS BIGINT)) g(x)"""

SQL["clean_release"] = f"""
SELECT year_month, order_value / n_orders AS value, 'ALL' AS geo_name, 'orders release' AS source_note
FROM {OM} ORDER BY year_month DESC LIMIT 60"""

SQL["month_end_rate"] = f"""
WITH daily AS (SELECT CAST(l_shipdate AS DATE) AS d,
                      ROUND(CAST(SUM(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) / COUNT(l_tax) * 100, 4) AS rate
               FROM lineitem GROUP BY 1),
m AS (SELECT year_month, CAST(year_month || '-01' AS DATE) AS month FROM {LM})
SELECT m.year_month, (SELECT rate FROM daily WHERE d <= last_day(m.month) ORDER BY d DESC LIMIT 1) AS rate FROM m"""

SQL["price_release"] = """
WITH daily AS (SELECT n_name AS region, CAST(o_orderdate AS DATE) AS d,
                      CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS p
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
last AS (SELECT region, strftime(d, '%Y-%m') AS year_month, p / 1000 AS index, p AS average_price,
                ROW_NUMBER() OVER (PARTITION BY region, strftime(d, '%Y-%m') ORDER BY d DESC) AS rn FROM daily)
SELECT region, year_month, index, average_price FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY region ORDER BY year_month DESC) AS k FROM last WHERE rn = 1) WHERE k <= 60"""

SQL["income_release"] = f"""
SELECT decile, income AS income_value, CAST(year + 1 AS VARCHAR) || '-03' AS year_month
FROM {DEC} WHERE year IN (SELECT DISTINCT year FROM {DEC} ORDER BY year DESC LIMIT 5)"""

SQL["top_customers"] = """
SELECT o_custkey, order_value, n_orders, order_value / n_orders AS mean_order FROM (
  SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_value, COUNT(*) AS n_orders
  FROM orders GROUP BY 1) ORDER BY order_value DESC, o_custkey LIMIT 10"""

SQL["month_growth"] = f"""
SELECT year_month, ROUND((order_value / NULLIF(LAG(order_value) OVER (ORDER BY year_month), 0) - 1) * 100, 4) AS growth_pct,
       NOT (n_orders BETWEEN 100 AND 100000) AS count_outside_band
FROM {OM}"""

SQL["phrase_hits"] = """
SELECT b.item_id, COUNT(d.doc_id) AS doc_count
FROM benchmark b LEFT JOIN documents d ON length(b.text) > 0 AND contains(d.text, b.text)
GROUP BY b.item_id"""

SQL["contract_report"] = f"""
SELECT 'monthly_macro' AS dataset, COUNT(*) AS rows,
       CASE WHEN COUNT(*) = 0 THEN 'no rows' ELSE MIN(year_month) || ' to ' || MAX(year_month) END AS coverage,
       COUNT(*) FILTER (WHERE TRY_STRPTIME(year_month, '%Y-%m') IS NULL OR length(year_month) <> 7) AS bad_months,
       COUNT(*) - COUNT(DISTINCT year_month) AS duplicates
FROM {LM} l LEFT JOIN {OM} o USING (year_month)"""

SQL["income_long_release"] = SQL["income_release"]

_PRICE = "o_orderkey, o_custkey, o_orderpriority, o_totalprice"
SQL["rank_orders"] = f"SELECT {_PRICE}, ROW_NUMBER() OVER (ORDER BY o_totalprice, o_orderkey) AS price_rank FROM orders"
SQL["rank_by_priority"] = f"""
SELECT {_PRICE}, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS price_rank FROM orders"""
SQL["split_orders"] = """
SELECT o_orderkey, o_totalprice,
       CASE WHEN ROW_NUMBER() OVER (ORDER BY o_orderkey) <= FLOOR(COUNT(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) <= FLOOR(COUNT(*) OVER (PARTITION BY o_orderpriority) * 0.8)
            THEN 'train' ELSE 'test' END AS priority_split
FROM orders"""
SQL["lag_orders"] = """
SELECT o_orderkey, o_orderpriority, o_totalprice, LAG(o_totalprice) OVER w AS o_totalprice_lag1, LAG(o_totalprice, 2) OVER w AS o_totalprice_lag2
FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey)"""
SQL["running_max_orders"] = """
SELECT o_orderkey, o_orderpriority, o_totalprice, MAX(o_totalprice) OVER (ORDER BY o_orderkey) AS whole_max,
       MAX(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS priority_max FROM orders"""

SQL["rate_layouts"] = """
WITH daily AS (SELECT CAST(l_shipdate AS DATE) AS d, ROUND(SUM(CAST(l_tax AS DECIMAL(18,4)))::DOUBLE / COUNT(*) * 100, 4) AS r FROM lineitem GROUP BY 1),
ends AS (SELECT strftime(d, '%Y-%m') AS year_month, max(d) AS d FROM daily GROUP BY 1)
SELECT layout, year_month, CASE WHEN day(d) % 7 <> 0 THEN r END AS rate FROM ends JOIN daily USING (d), (VALUES ('old'), ('new')) v(layout)"""

SQL["contract_violations"] = """
SELECT 'duplicate_keys' AS "check", COUNT(*) - COUNT(DISTINCT l_orderkey) AS n FROM lineitem UNION ALL
SELECT 'unique_keys', COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem UNION ALL
SELECT 'bad_months', COUNT(*) FILTER (WHERE l_linenumber = 7 OR l_shipdate IS NULL) FROM lineitem UNION ALL
SELECT 'not_constant', COUNT(*) FILTER (WHERE l_returnflag <> 'A') FROM lineitem UNION ALL
SELECT 'not_allowed', COUNT(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) FROM orders UNION ALL
SELECT * FROM (SELECT 'missing_over_limit', COUNT(*) FILTER (WHERE l_linenumber = 3 OR l_tax IS NULL) AS n FROM lineitem) WHERE n > 10"""

SQL["column_tools"] = """
SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_totalprice AS price_text, CAST(o_orderkey % 10 AS INTEGER) AS tenth,
       'Bulk_' || o_orderpriority AS code, (o_orderkey % 1000) / 8.0::DOUBLE AS share, NULL::INTEGER AS bad, 'D' || (o_orderkey % 10) AS tenth_label,
       '£' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS whole_label, printf('%.1f%%', CAST(round(CAST((o_orderkey % 1000) / 8.0 AS DECIMAL(18,3)), 1) AS DOUBLE)) AS share_label,
       lower('Bulk_' || o_orderpriority) AS low, contains(o_orderpriority, 'URGENT') AS urgent, substr(o_orderpriority, 1, 1) AS digit,
       true AS bulk, o_orderpriority LIKE '%LOW' AS ends,
       'Bulk ' || replace(lower(o_orderpriority), ' s', ' S') AS title, CAST(round(CAST((o_orderkey % 1000) / 8.0 AS DECIMAL(18,3)), 1) AS DOUBLE) AS rounded,
       strftime(last_day(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS month_end, CAST(year(o_orderdate) AS INTEGER) AS year,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS iso
FROM orders"""

SQL["row_tools"] = """
WITH m AS (
SELECT 'eq' AS measure, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS value FROM orders UNION ALL
SELECT 'between', COUNT(*) FILTER (WHERE o_totalprice BETWEEN 1000 AND 50000) FROM orders UNION ALL
SELECT 'not_missing', COUNT(*) FILTER (WHERE o_orderstatus <> 'O') FROM orders UNION ALL
SELECT 'implausible', COUNT(*) FILTER (WHERE o_totalprice NOT BETWEEN 1000 AND 50000) FROM orders UNION ALL
SELECT 'threshold', COUNT(*) FILTER (WHERE o_totalprice > 100000) FROM orders UNION ALL
SELECT 'shared_keys', COUNT(DISTINCT o_custkey) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) UNION ALL
SELECT 'distinct_rows', COUNT(DISTINCT (o_orderstatus, o_orderpriority)) FROM orders UNION ALL
SELECT 'distinct_values', COUNT(DISTINCT o_orderpriority) FROM orders)
SELECT measure, value::DOUBLE AS value FROM m UNION ALL
SELECT 'min_' || o_orderpriority, round(MIN(o_totalprice) * 100)::DOUBLE FROM orders GROUP BY o_orderpriority UNION ALL
SELECT 'max_' || o_orderpriority, round(MAX(o_totalprice) * 100)::DOUBLE FROM orders GROUP BY o_orderpriority UNION ALL
SELECT 'mean_' || o_orderstatus, round(AVG(o_custkey), 6) FROM orders GROUP BY o_orderstatus"""

SQL["label_scores"] = """
SELECT event_id, event_id % 21 / 10.0::DOUBLE - 1 AS score,
       CASE WHEN event_id % 21 / 10.0::DOUBLE - 1 >= 0.5 THEN 'positive' WHEN event_id % 21 / 10.0::DOUBLE - 1 <= -0.5 THEN 'negative' ELSE 'neutral' END AS label
FROM events"""

SQL["sorted_ranks"] = """
SELECT 'time' AS sort, c_custkey, ROW_NUMBER() OVER (ORDER BY CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END NULLS LAST, c_custkey) AS position FROM customer
UNION ALL SELECT 'derived', c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey % 7, c_custkey) FROM customer"""

# least squares by the normal equations of two centred features
_MULTI = f"""
m AS (SELECT year_month, ship_value / 1e6 AS y, n_orders::DOUBLE AS x1, avg_discount * 100 AS x2 FROM {LM} JOIN {OM} USING (year_month)),
s AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY year_month) <= FLOOR(COUNT(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split FROM m),
c AS (SELECT covar_pop(x1, x1) AS a, covar_pop(x1, x2) AS b, covar_pop(x2, x2) AS d, covar_pop(x1, y) AS p, covar_pop(x2, y) AS q,
             avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM s WHERE split = 'train'),
w AS (SELECT (p * d - q * b) / (a * d - b * b) AS w1, (q * a - p * b) / (a * d - b * b) AS w2, m1, m2, my FROM c),
f AS (SELECT *, my - w1 * m1 - w2 * m2 AS w0 FROM w),
e AS (SELECT split, y, y - (w0 + w1 * x1 + w2 * x2) AS e FROM s, f),
g AS (SELECT split, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / (var_pop(y) * count(*)) AS r2 FROM e GROUP BY split)"""
SQL["ols_multi"] = f"""
WITH {_MULTI}
SELECT 'intercept' AS name, 'estimate' AS what, round(w0, 3) AS value FROM f UNION ALL SELECT 'x1', 'estimate', round(w1, 3) FROM f
UNION ALL SELECT 'x2', 'estimate', round(w2, 3) FROM f UNION ALL SELECT split, 'mae', round(mae, 3) FROM g
UNION ALL SELECT split, 'rmse', round(rmse, 3) FROM g UNION ALL SELECT split, 'r2', round(r2, 3) FROM g"""
SQL["frozen_evaluation"] = SQL["reg_metrics"]

SQL["preview"] = "SELECT least(count(*), 5) AS n_rows, CAST(0 AS BIGINT) AS n_foreign FROM orders"

SQL["frozen_values"] = """
SELECT o_orderstatus, ROUND(AVG(o_totalprice), 2) = ROUND(x, 2) AS reproduced, ROUND(AVG(o_totalprice) + 0.01, 2) = ROUND(x, 2) AS shifted_reproduced
FROM orders JOIN (SELECT o_orderstatus, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS x FROM orders GROUP BY 1) USING (o_orderstatus)
GROUP BY o_orderstatus, x"""

SQL["null_keys"] = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE o_orderpriority END AS p, o_totalprice, year(o_orderdate) AS y FROM orders),
s AS (SELECT p, AVG(o_totalprice) - STDDEV_SAMP(o_totalprice) AS lo, AVG(o_totalprice) + STDDEV_SAMP(o_totalprice) AS hi FROM o GROUP BY 1),
g AS (SELECT p, COUNT(*) AS n, QUANTILE_CONT(o_totalprice, 0.25) AS p25, QUANTILE_CONT(o_totalprice, 0.5) AS p50 FROM o GROUP BY 1)
SELECT p, 'train' AS what, FLOOR(n * 0.8)::DOUBLE AS value FROM g
UNION ALL SELECT p, 'lagged', greatest(n - 2, 0)::DOUBLE FROM g WHERE n > 2
UNION ALL SELECT p, 'ranked', n::DOUBLE FROM g
UNION ALL SELECT p, 'binned', n::DOUBLE FROM g
UNION ALL SELECT p, 'latest', COUNT(*)::DOUBLE FROM (SELECT p, DENSE_RANK() OVER (PARTITION BY p ORDER BY y DESC) AS r FROM o) WHERE r <= 2 GROUP BY 1
UNION ALL SELECT p, 'p25', ROUND(p25, 4) FROM g
UNION ALL SELECT p, 'median', ROUND(p50, 4) FROM g
UNION ALL SELECT p, 'outliers', COUNT(*) FILTER (WHERE o_totalprice < lo OR o_totalprice > hi)::DOUBLE FROM o JOIN s USING (p) GROUP BY 1"""

SQL["refresh_orders"] = """
SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 7 = 0 THEN date_trunc('month', o_orderdate) + INTERVAL 1 MONTH ELSE o_orderdate END, '%Y-%m') AS year_month,
       CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS rev
FROM orders"""

SQL["checked_orders"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 77 = 0 THEN NULL ELSE o_totalprice END AS price,
       CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 77 = 0 THEN 'rejected' ELSE 'kept' END AS status
FROM orders"""

SQL["release_files"] = SQL["clean_release"]

SQL["mixed_layouts"] = f"SELECT x.*, CAST(1 AS BIGINT) AS rejected_files FROM ({SQL['price_release']}) x"

SQL["observed_log"] = f"""
WITH m AS (SELECT year_month, ROW_NUMBER() OVER (ORDER BY year_month DESC) AS rn FROM {OM}),
p AS (SELECT c_nationkey AS k, CAST(o_orderdate AS DATE) AS day FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
pm AS (SELECT k, strftime(day, '%Y-%m') AS ym, ROW_NUMBER() OVER (PARTITION BY k ORDER BY strftime(day, '%Y-%m') DESC) AS rn
       FROM (SELECT k, MAX(day) AS day FROM p WHERE day(day) <> 13 GROUP BY k, strftime(day, '%Y-%m')))
SELECT 'orders' AS dataset, 2 * COUNT(*) AS rows_in, CAST(0 AS BIGINT) AS unparsable, COUNT(*) AS duplicates, COUNT(*) FILTER (WHERE rn <= 60) AS rows_out,
       MIN(year_month) FILTER (WHERE rn <= 60) || ' to ' || MAX(year_month) AS coverage FROM m
UNION ALL
SELECT 'prices', (SELECT COUNT(*) FROM p), (SELECT COUNT(*) FROM p WHERE day(day) = 13), (SELECT COUNT(*) FROM p WHERE day(day) <> 13) - COUNT(*),
       COUNT(*) FILTER (WHERE rn <= 60), MIN(ym) FILTER (WHERE rn <= 60) || ' to ' || MAX(ym) FROM pm"""

SQL["scored_texts"] = """
SELECT doc_id, ROUND(c, 6) AS compound, CASE WHEN c >= 0 THEN 'positive' WHEN c <= -0.05 THEN 'negative' ELSE 'neutral' END AS label
FROM (SELECT doc_id, ((length(t) - length(replace(t, 'a', ''))) - (length(t) - length(replace(t, 'e', ''))))::DOUBLE / (length(t) + 1) AS c
      FROM (SELECT doc_id, COALESCE(text, '') AS t FROM documents))"""

SQL["forest_nodes"] = f"""
WITH n AS (SELECT greatest(COUNT(*) - 3, 0) AS n FROM {OM})
SELECT what, CASE what WHEN 'importances' THEN 3 WHEN 'refused' THEN 1 WHEN 'trees' THEN 200 ELSE n END AS n,
       CASE what WHEN 'importances' THEN 3 WHEN 'refused' THEN 1 WHEN 'trees' THEN 200 ELSE n END AS n_equal
FROM n, (VALUES ('nodes'), ('loaded'), ('importances'), ('refused'), ('trees')) v(what)"""

SQL["quantile_sketches"] = """
WITH b AS (SELECT o_orderpriority, ceil(ln(o_totalprice) / ln(1.02::DOUBLE)) AS bin, COUNT(*) AS n FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1, 2),
c AS (SELECT *, SUM(n) OVER (PARTITION BY o_orderpriority ORDER BY bin) AS upto, SUM(n) OVER (PARTITION BY o_orderpriority) AS n_all FROM b)
SELECT o_orderpriority, q, CAST(MAX(n_all) AS BIGINT) AS n, ROUND(pow(1.02::DOUBLE, MIN(bin)) * (2 / 2.02::DOUBLE), 4) AS estimate, true AS close
FROM c, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (0.99::DOUBLE)) v(q) WHERE upto >= ceil(q * n_all) GROUP BY 1, 2"""

SQL["distinct_sketches"] = "SELECT o_orderpriority, COUNT(DISTINCT o_custkey) AS customers, true AS close FROM orders GROUP BY 1"

SQL["sink_round_trip"] = """
SELECT 'orders' AS source, o_orderkey AS id, o_totalprice AS value, CAST(NULL AS VARCHAR) AS name FROM orders
WHERE o_orderstatus = 'F' AND o_orderkey BETWEEN 1000 AND 20000
UNION ALL SELECT 'nations', n_nationkey, NULL, n_name FROM nation"""
