"""Independent SQL (DuckDB dialect) for every query of the catalogue.

The raw feeds are re-derived here from the benchmark tables with the same
rules as ``bindings`` but written as plain SQL (window ``row_number`` instead
of aggregate-based dedup, three separate island queries instead of the single
window pass, direct product-level sums, ...), so agreement means the Spark
plans compute what the rules say, not merely what the Spark code does.
"""

from __future__ import annotations

import re


def _key(x: str, pattern: str) -> str:
    e = f"regexp_extract(trim({x}), '{pattern}', 1)"
    return f"(CASE WHEN {e} <> '' THEN TRY_CAST({e} AS BIGINT) END)"


def key_pos(x: str) -> str:
    return _key(x, r"^CN-0*([0-9]+)$")


def key_erp(x: str) -> str:
    return _key(x, r"^ERP-[A-Z]+-[A-Z]+-0*([0-9]+)-[A-Z]$")


def key_handle(x: str) -> str:
    return _key(x, r"-0*([0-9]+)$")


def parse_stock(x: str) -> str:
    t = f"upper(trim({x}))"
    return (
        f"(CASE WHEN {t} IS NULL OR {t} IN ('N/A', 'NA', 'NULL', '') THEN NULL "
        rf"WHEN regexp_matches({t}, '^[+-]?[0-9]+(\.[0-9]*)?$') "
        f"THEN TRY_CAST(regexp_extract({t}, '^([+-]?[0-9]+)', 1) AS INTEGER) END)"
    )


def rhu(x: str, d: int) -> str:
    s = 10**d
    return f"(floor(CAST({x} AS DOUBLE) * CAST({s} AS DOUBLE) + 0.5) / CAST({s} AS DOUBLE))"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


ERP_SKU = "printf('ERP-PROV-MX-%03d-A', {})"

_MARGIN = f"""{money('sum(amount)')} AS revenue, {money('sum(cost_total)')} AS cogs, {money('sum(margin)')} AS margin,
    CAST(sum(units) AS BIGINT) AS units, count(*) AS lines, count(*) FILTER (cost IS NULL) AS lines_without_cost,
    count(*) FILTER (amount IS NULL) AS lines_without_rate"""

CTES: dict[str, str] = {
    "ccy": """
        SELECT n_nationkey AS nationkey, n_name AS nation, r_name AS region,
               CASE r_name WHEN 'AMERICA' THEN 'USD' WHEN 'EUROPE' THEN 'EUR'
                           WHEN 'MIDDLE EAST' THEN 'GBP' ELSE 'MXN' END AS currency
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "pos_raw": f"""
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS doc_id,
               l_shipdate AS ts,
               printf('T%04d', l_suppkey) AS store_id,
               CASE WHEN l_linenumber = 3 THEN '  ' || printf('CN-%05d', l_partkey) || ' '
                    ELSE printf('CN-%05d', l_partkey) END AS sku,
               CAST(l_quantity AS INTEGER) AS units,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS amount,
               k.currency,
               CASE WHEN l_returnflag = 'A' THEN 'I'
                    WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'I'
                    WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'T'
                    WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'E'
                    WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'P' END AS doc_type
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
             LEFT JOIN ccy k ON s_nationkey = k.nationkey""",
    "online_raw": """
        SELECT 'W' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(coalesce(l_linenumber, 0) AS VARCHAR) AS order_id, o_orderdate AS ts,
               CASE WHEN l_partkey IS NOT NULL THEN printf('item-%03d', l_partkey) END AS handle,
               CAST(l_quantity AS INTEGER) AS units,
               CASE WHEN l_orderkey IS NULL THEN CAST(o_totalprice AS DECIMAL(18,4))
                    ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) END AS amount,
               k.currency
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
             LEFT JOIN customer ON o_custkey = c_custkey
             LEFT JOIN ccy k ON c_nationkey = k.nationkey""",
    "cutoffs": """
        SELECT max(d) AS sales_cutoff FROM (
            SELECT CAST(ts AS DATE) AS d FROM pos_raw
            UNION ALL SELECT CAST(ts AS DATE) FROM online_raw)""",
    "win": """
        SELECT sales_cutoff AS c,
               CAST(date_trunc('month', sales_cutoff) - INTERVAL 5 MONTH AS DATE) AS s6,
               CAST(date_trunc('month', sales_cutoff) - INTERVAL 11 MONTH AS DATE) AS s12
        FROM cutoffs""",
    "fx_months": """
        SELECT CAST(date_trunc('month', day) AS DATE) AS month, status,
               sum(CAST(CAST(price AS DECIMAL(18,2)) * 100 AS BIGINT)) % 100 AS usd, count(*) % 100 AS eur
        FROM (SELECT o_orderdate AS day, o_orderstatus AS status, o_totalprice AS price FROM orders
              UNION ALL SELECT l_shipdate, l_linestatus, l_extendedprice FROM lineitem)
        WHERE day IS NOT NULL GROUP BY ALL""",
    "fx_quotes": """
        SELECT month, CASE status WHEN 'O' THEN ' USD ' ELSE 'USD' END AS currency, 17 + usd / 100.0 AS rate FROM fx_months
        UNION ALL
        SELECT month, CASE status WHEN 'O' THEN ' eur ' ELSE 'eur' END AS currency, 20 + eur / 100.0 AS rate FROM fx_months""",
    "fx_raw": """
        SELECT * FROM (
            SELECT CAST(unnest(generate_series(CAST(month AS TIMESTAMP), CAST(last_day(month) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date,
                   currency, rate
            FROM fx_quotes)
        WHERE dayofweek(date) <> 0""",
    "fx_rates": """
        SELECT date, upper(trim(currency)) AS currency, min(CAST(rate AS DECIMAL(9,4))) AS rate FROM fx_raw
        GROUP BY date, upper(trim(currency))""",
    "fx": """
        SELECT date, currency, rate FROM fx_rates
        UNION ALL
        SELECT DISTINCT date, 'MXN' AS currency, CAST(1 AS DECIMAL(9,4)) AS rate FROM fx_rates""",
    "pos_dedup": """
        SELECT doc_id, ts, store_id, sku, units, amount, currency, doc_type FROM (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts NULLS FIRST, store_id NULLS FIRST,
                   sku NULLS FIRST, units NULLS FIRST, amount NULLS FIRST, currency NULLS FIRST,
                   doc_type NULLS FIRST) AS rn
            FROM pos_raw) WHERE rn = 1 OR doc_id IS NULL""",
    "pos_base": f"""
        SELECT doc_id, ts AS local_ts, CAST(ts AS DATE) AS date, store_id,
               {key_pos('sku')} AS product_key, doc_type,
               CASE WHEN doc_type IN ('I') THEN 1 WHEN doc_type IN ('E') THEN -1 ELSE 0 END AS sign,
               units, CAST(amount AS DECIMAL(28,8)) AS amount, upper(trim(currency)) AS currency
        FROM pos_dedup""",
    "pos_fact": """
        SELECT b.doc_id, 'physical' AS channel, b.date, b.local_ts, b.store_id, b.product_key, b.doc_type,
               b.sign <> 0 AS is_revenue, b.sign * b.units AS units,
               CAST(CAST(b.sign * b.amount AS DECIMAL(28,8)) *
                    CASE WHEN b.currency = 'MXN' THEN CAST(1 AS DECIMAL(9,4)) ELSE x.rate END AS DECIMAL(28,8)) AS amount,
               b.currency, CAST(b.sign * b.amount AS DECIMAL(28,8)) AS amount_src
        FROM pos_base b LEFT JOIN fx x ON b.date = x.date AND b.currency = x.currency""",
    "online_dedup": """
        SELECT order_id, ts, handle, units, amount, currency FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts NULLS FIRST, handle NULLS FIRST,
                   units NULLS FIRST, amount NULLS FIRST, currency NULLS FIRST) AS rn
            FROM online_raw) WHERE rn = 1 OR order_id IS NULL""",
    "online_fact": f"""
        SELECT o.order_id AS doc_id, 'online' AS channel, CAST(o.ts AS DATE) AS date, o.ts AS local_ts,
               'ONLINE' AS store_id, {key_handle('o.handle')} AS product_key, 'WEB' AS doc_type,
               true AS is_revenue, o.units,
               CAST(CAST(o.amount AS DECIMAL(28,8)) *
                    CASE WHEN upper(trim(o.currency)) = 'MXN' THEN CAST(1 AS DECIMAL(9,4)) ELSE x.rate END AS DECIMAL(28,8)) AS amount,
               upper(trim(o.currency)) AS currency, CAST(o.amount AS DECIMAL(28,8)) AS amount_src
        FROM online_dedup o LEFT JOIN fx x
             ON CAST(o.ts AS DATE) = x.date AND upper(trim(o.currency)) = x.currency""",
    "sales": """
        SELECT doc_id, channel, date, local_ts, store_id, product_key, doc_type, is_revenue, units, amount, currency, amount_src FROM pos_fact
        UNION ALL
        SELECT doc_id, channel, date, local_ts, store_id, product_key, doc_type, is_revenue, units, amount, currency, amount_src FROM online_fact""",
    "catalog_versions": f"""
        SELECT p_partkey, {ERP_SKU.format('p_partkey')} AS sku_erp, p_name AS name, p_type AS category, i,
               strftime(DATE '1996-01-01' + CAST(500 * i AS INTEGER), '%Y-%m-%d') AS valid_from,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) * (CAST(20 + i AS DECIMAL(4,0)) * 0.1) AS DECIMAL(18,3)) AS cost,
               'SUP-' || CAST(i AS VARCHAR) AS supplier
        FROM part, range(5) AS r(i)""",
    "cost_dedup": f"""
        SELECT product_key, valid_from, cost, supplier FROM (
            SELECT {key_erp('sku_erp')} AS product_key, CAST(valid_from AS DATE) AS valid_from, cost, supplier,
                   row_number() OVER (PARTITION BY {key_erp('sku_erp')}, CAST(valid_from AS DATE)
                                      ORDER BY cost NULLS FIRST, supplier NULLS FIRST) AS rn
            FROM catalog_versions) WHERE rn = 1""",
    "cost_dim": """
        SELECT product_key, valid_from, cost, supplier,
               coalesce(CAST(lead(valid_from) OVER (PARTITION BY product_key ORDER BY valid_from) - 1 AS DATE),
                        DATE '9999-12-31') AS valid_to
        FROM cost_dedup""",
    "products_base": f"""
        SELECT product_key, sku_erp, name, category FROM (
            SELECT {key_erp('sku_erp')} AS product_key, sku_erp, name, category,
                   row_number() OVER (PARTITION BY {key_erp('sku_erp')}
                                      ORDER BY sku_erp NULLS FIRST, name NULLS FIRST, category NULLS FIRST) AS rn
            FROM (SELECT {ERP_SKU.format('p_partkey')} AS sku_erp, p_name AS name, p_type AS category FROM part))
        WHERE rn = 1 AND product_key IS NOT NULL""",
    "mappings_raw": f"""
        SELECT CASE WHEN p_size < 48 THEN printf('CN-%05d', p_partkey) END AS sku_pos,
               CASE WHEN p_size > 2 THEN {ERP_SKU.format('p_partkey')} END AS sku_erp,
               lower(regexp_replace(trim(p_name), ' +', '-', 'g')) || '-' ||
                   printf('%03d', CASE WHEN p_brand = 'Brand#7' THEN CAST(p_size AS BIGINT) ELSE p_partkey END) AS handle
        FROM part""",
    "aliases": f"""
        SELECT product_key, sku_pos_mapped, handle FROM (
            SELECT {key_pos('sku_pos')} AS product_key, sku_pos AS sku_pos_mapped, handle,
                   row_number() OVER (PARTITION BY {key_pos('sku_pos')}
                                      ORDER BY sku_pos NULLS FIRST, handle NULLS FIRST) AS rn
            FROM mappings_raw)
        WHERE rn = 1 AND product_key IS NOT NULL""",
    "products": """
        SELECT p.product_key, p.sku_erp, coalesce(a.sku_pos_mapped, printf('CN-%05d', p.product_key)) AS sku_pos,
               a.handle, p.name, p.category, a.sku_pos_mapped IS NOT NULL AS has_explicit_mapping
        FROM products_base p LEFT JOIN aliases a ON p.product_key = a.product_key""",
    "mapping_keys": f"""
        SELECT sku_pos, sku_erp, handle, {key_pos('sku_pos')} AS key_pos, {key_erp('sku_erp')} AS key_erp,
               {key_handle('handle')} AS key_handle
        FROM mappings_raw""",
    "mapping_flags": """
        SELECT *, (key_pos IS NULL OR (key_erp IS NOT NULL AND key_erp <> key_pos)
                   OR (key_handle IS NOT NULL AND key_handle <> key_pos)) AS discrepant
        FROM mapping_keys""",
    "stores_raw": """
        SELECT printf('T%04d', s_suppkey) AS store_id, k.nation AS city, k.region, 'UTC' AS timezone
        FROM supplier LEFT JOIN ccy k ON s_nationkey = k.nationkey
        UNION ALL
        SELECT printf('U%04d', c_custkey) AS store_id, k.nation AS city, k.region, 'UTC' AS timezone
        FROM customer LEFT JOIN ccy k ON c_nationkey = k.nationkey""",
    "stores": """
        SELECT store_id, city, region, timezone, 'physical' AS channel FROM (
            SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY city NULLS FIRST, region NULLS FIRST,
                                         timezone NULLS FIRST) AS rn
            FROM stores_raw) WHERE rn = 1
        UNION ALL SELECT 'ONLINE', 'N/A', 'digital', 'America/Mexico_City', 'online'""",
    "ev": "SELECT user_id, event_id % 3 + 1 AS product, CAST(ts AS DATE) AS date, event_type FROM events",
    "ev_daily": """
        SELECT user_id, product, date, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS errors,
               sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchases
        FROM ev GROUP BY user_id, product, date""",
    "ev_grid": """
        SELECT user_id, product,
               CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT user_id, product, min(date) AS lo, max(date) AS hi FROM ev GROUP BY user_id, product)""",
    "shelf_raw": f"""
        SELECT g.date, printf('U%04d', g.user_id) AS store_id, {ERP_SKU.format('g.product')} AS sku_erp,
               CASE WHEN d.errors = 1 THEN 'N/A' ELSE CAST(coalesce(d.purchases, 0) AS VARCHAR) END AS stock
        FROM ev_grid g LEFT JOIN ev_daily d ON g.user_id = d.user_id AND g.product = d.product AND g.date = d.date""",
    "dispatch_raw": f"""
        SELECT CAST(l_shipdate AS DATE) AS date, printf('T%04d', l_suppkey) AS store_id,
               {ERP_SKU.format('l_partkey')} AS sku_erp,
               CASE WHEN l_tax = 0 THEN 'N/A'
                    ELSE CAST((l_partkey * 7 + dayofyear(l_shipdate)) % 50 AS VARCHAR) END AS stock
        FROM lineitem""",
    "snapshots_raw": "SELECT * FROM shelf_raw UNION ALL SELECT * FROM dispatch_raw",
    "readings": f"""
        SELECT date, store_id, {key_erp('sku_erp')} AS product_key, {parse_stock('stock')} AS units,
               {parse_stock('stock')} IS NOT NULL AS reading_valid
        FROM snapshots_raw""",
    "inventory": """
        SELECT date, store_id, product_key, units, reading_valid FROM (
            SELECT *, row_number() OVER (PARTITION BY date, store_id, product_key
                                         ORDER BY (NOT reading_valid), units NULLS FIRST) AS rn
            FROM readings) WHERE rn = 1 OR date IS NULL OR store_id IS NULL OR product_key IS NULL""",
    "valued": """
        SELECT i.date, i.store_id, i.product_key, i.units, i.reading_valid, c.cost,
               CAST(i.units * c.cost AS DECIMAL(28,8)) AS value
        FROM inventory i LEFT JOIN cost_dim c
             ON i.product_key = c.product_key AND i.date >= c.valid_from AND i.date <= c.valid_to""",
    "costed": """
        SELECT s.*, c.cost, CAST(s.units * c.cost AS DECIMAL(28,8)) AS cost_total,
               CAST(s.amount - CAST(s.units * c.cost AS DECIMAL(28,8)) AS DECIMAL(28,8)) AS margin
        FROM sales s LEFT JOIN cost_dim c
             ON s.product_key = c.product_key AND s.date >= c.valid_from AND s.date <= c.valid_to""",
    # ---------------------------------------------------------------- turnover
    "t_cogs": """
        SELECT product_key, sum(cost_total) AS cogs, CAST(sum(units) AS BIGINT) AS units_sold
        FROM costed, win
        WHERE channel = 'physical' AND is_revenue AND date >= s6 AND date <= c
        GROUP BY product_key""",
    "t_daily": """
        SELECT product_key, date, sum(value) AS v, sum(units) AS u
        FROM valued, win WHERE reading_valid AND date >= s6 AND date <= c
        GROUP BY product_key, date""",
    "t_mean": f"""
        SELECT product_key, {div('sum(v)', 'count(v)')} AS mean_inventory_value,
               {div('sum(u)', 'count(u)')} AS mean_inventory_units, count(*) AS days_with_reading
        FROM t_daily GROUP BY product_key""",
    "turnover_all": f"""
        SELECT g.product_key, p.sku_pos, p.sku_erp, p.name, p.category, g.units_sold,
               {money('g.cogs')} AS cogs, m.mean_inventory_value, m.mean_inventory_units,
               {rhu(div('g.cogs', 'm.mean_inventory_value'), 3)} AS turnover,
               {rhu(div('g.units_sold', 'm.mean_inventory_units'), 3)} AS turnover_units,
               m.days_with_reading,
               (SELECT s6 FROM win) AS window_start, (SELECT c FROM win) AS window_end
        FROM t_cogs g JOIN t_mean m ON g.product_key = m.product_key
             JOIN products p ON g.product_key = p.product_key""",
    "turnover_top": f"""
        SELECT product_key, sku_pos, sku_erp, name, category, units_sold, cogs, mean_inventory_value,
               mean_inventory_units, turnover, turnover_units,
               {rhu(div('datediff(' + "'day'" + ', window_start, window_end) + 1', 'turnover'), 1)} AS days_of_inventory,
               days_with_reading, window_start, window_end
        FROM turnover_all ORDER BY turnover DESC NULLS LAST, product_key ASC LIMIT 10""",
    # ---------------------------------------------------------------- stock-outs
    "sq": """
        SELECT c, CAST(date_trunc('quarter', c) AS DATE) AS qs,
               CAST(year(c) AS VARCHAR) || '-Q' || CAST(quarter(c) AS VARCHAR) AS ql
        FROM (SELECT max(CAST(ts AS DATE)) AS c FROM events)""",
    "period": """
        SELECT i.*, datediff('day', sq.qs, i.date) AS day
        FROM inventory i, sq WHERE i.date >= sq.qs AND i.date <= sq.c""",
    "isl_breaks": """
        SELECT store_id, product_key, date, day - row_number() OVER (PARTITION BY store_id, product_key ORDER BY date) AS isl
        FROM period WHERE reading_valid AND units = 0""",
    "ordv": """
        SELECT *, count(CASE WHEN reading_valid THEN 1 END) OVER (
                      PARTITION BY store_id, product_key ORDER BY date ROWS UNBOUNDED PRECEDING) AS valid_axis
        FROM period""",
    "isl_bridged": """
        SELECT store_id, product_key, date, valid_axis - row_number() OVER (PARTITION BY store_id, product_key ORDER BY date) AS isl
        FROM ordv WHERE reading_valid AND units = 0""",
    "isl_as_zero": """
        SELECT store_id, product_key, date, day - row_number() OVER (PARTITION BY store_id, product_key ORDER BY date) AS isl
        FROM period WHERE units = 0 OR NOT reading_valid""",
    "runs_breaks": """
        SELECT store_id, product_key, min(date) AS run_start, max(date) AS run_end, count(*) AS days
        FROM isl_breaks GROUP BY store_id, product_key, isl HAVING count(*) > 3""",
    "runs_bridged": """
        SELECT store_id, product_key, count(*) AS days
        FROM isl_bridged GROUP BY store_id, product_key, isl HAVING count(*) > 3""",
    "runs_as_zero": """
        SELECT store_id, product_key, count(*) AS days
        FROM isl_as_zero GROUP BY store_id, product_key, isl HAVING count(*) > 3""",
    "hist": """
        SELECT *, datediff('day', DATE '1970-01-01', date) AS day,
               count(CASE WHEN reading_valid THEN 1 END) OVER w AS valid_axis,
               count(CASE WHEN reading_valid AND units = 0 THEN 1 END) OVER w AS zeros,
               count(CASE WHEN units = 0 OR NOT reading_valid THEN 1 END) OVER w AS maybe_zeros
        FROM inventory WHERE date IS NOT NULL AND store_id IS NOT NULL AND product_key IS NOT NULL
        WINDOW w AS (PARTITION BY store_id, product_key ORDER BY date ROWS UNBOUNDED PRECEDING)""",
    "streak_detail": """
        SELECT r.store_id, s.city, s.region, r.product_key, p.sku_pos, p.name, p.category,
               r.run_start AS stockout_start, r.run_end AS stockout_end, r.days AS consecutive_days,
               (SELECT ql FROM sq) AS quarter
        FROM runs_breaks r JOIN products p ON r.product_key = p.product_key
             JOIN stores s ON r.store_id = s.store_id""",
    # ---------------------------------------------------------------- growth
    "monthly": f"""
        SELECT channel, strftime(date, '%Y-%m') AS month, {money('sum(amount)')} AS revenue,
               CAST(sum(units) AS BIGINT) AS units, count(DISTINCT doc_id) AS documents
        FROM sales, win WHERE is_revenue AND date >= s12 AND date <= c
        GROUP BY channel, strftime(date, '%Y-%m')""",
    "growth_lag": """
        SELECT *, lag(revenue) OVER (PARTITION BY channel ORDER BY month) AS prev_revenue FROM monthly""",
    "growth": f"""
        SELECT channel, month, revenue, units, documents, prev_revenue,
               {rhu(div('CAST(100 AS DOUBLE) * (revenue - prev_revenue)', 'prev_revenue'), 2)} AS growth_pct,
               {rhu(div('revenue', 'documents'), 2)} AS avg_ticket
        FROM growth_lag""",
    # ---------------------------------------------------------------- margin
    "m_base": "SELECT costed.* FROM costed, win WHERE is_revenue AND date >= s12 AND date <= c",
    "m_product": f"""
        SELECT *, {rhu(div('CAST(100 AS DOUBLE) * margin', 'revenue'), 2)} AS margin_pct
        FROM (SELECT product_key, {_MARGIN} FROM m_base GROUP BY product_key)
        WHERE margin < 0""",
    "m_fine": f"""
        SELECT *, {rhu(div('CAST(100 AS DOUBLE) * margin', 'revenue'), 2)} AS margin_pct
        FROM (SELECT product_key, store_id, channel, {_MARGIN} FROM m_base GROUP BY product_key, store_id, channel)""",
}


def _check(name: str, severity: str, failed: str, total: str, limit: float, source: str, what: str) -> str:
    return f"""
        SELECT '{name}' AS "check", '{severity}' AS severity,
               f * 100 <= CAST({limit} AS DECIMAL(9,4)) * t AS ok,
               f AS failed, t AS total,
               coalesce({rhu(div('f * 100', 't'), 4)}, 0.0) AS pct,
               CAST({limit} AS DOUBLE) AS limit_pct, f || ' of ' || t || ' {what}' AS detail
        FROM (SELECT CAST(coalesce({failed}, 0) AS BIGINT) AS f, CAST(coalesce({total}, 0) AS BIGINT) AS t FROM {source})"""


_SALES_SRC = "(SELECT s.*, k.product_key IS NOT NULL AS known FROM sales s LEFT JOIN (SELECT DISTINCT product_key FROM products) k ON s.product_key = k.product_key)"

CHECKS = {
    "check_mapping": _check(
        "mapping_consistent", "error", "sum(CASE WHEN discrepant THEN 1 ELSE 0 END)", "count(*)", 0.0, "mapping_flags",
        "mapping rows contradict the derived key",
    ),
    "check_orphan_sales": _check(
        "sales_have_product", "error", "sum(CASE WHEN NOT known THEN 1 ELSE 0 END)", "count(*)", 0.5, _SALES_SRC,
        "lines have no catalogue product",
    ),
    "check_missing_fx": _check(
        "amounts_converted", "error", "sum(CASE WHEN amount IS NULL THEN 1 ELSE 0 END)", "count(*)", 0.0, _SALES_SRC,
        "lines have no rate",
    ),
    "check_sign": _check(
        "sign_coherent", "error",
        "sum(CASE WHEN (units > 0 AND amount < 0) OR (units < 0 AND amount > 0) THEN 1 ELSE 0 END)",
        "count(*)", 0.0, "sales", "lines have units and amount of opposite sign",
    ),
    "check_orphan_store": _check(
        "sales_have_store", "error", "sum(CASE WHEN k.store_id IS NULL THEN 1 ELSE 0 END)", "count(*)", 0.0,
        "sales s LEFT JOIN (SELECT DISTINCT store_id FROM stores) k ON s.store_id = k.store_id",
        "lines have no known store",
    ),
    "check_unknown_doc_types": _check(
        "document_types_known", "warning",
        "sum(CASE WHEN doc_type IS NULL OR doc_type NOT IN ('I', 'E', 'P', 'T', 'N') THEN 1 ELSE 0 END)",
        "count(*)", 0.0, "pos_raw", "documents have an unknown type",
    ),
    "check_cost_covered": _check(
        "cost_covered", "warning", "sum(CASE WHEN is_revenue AND product_key IS NOT NULL AND cost IS NULL THEN 1 ELSE 0 END)",
        "count(*)", 0.0, "costed", "lines have no cost on their day",
    ),
    "check_invalid_readings": _check(
        "readings_valid", "warning", "sum(CASE WHEN NOT reading_valid THEN 1 ELSE 0 END)", "count(*)", 5.0, "inventory",
        "readings are unknown",
    ),
    "check_grain_unique": _check(
        "grain_unique", "error", "sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)", "count(*)", 0.0,
        "(SELECT date, store_id, product_key, count(*) AS n FROM readings GROUP BY date, store_id, product_key)",
        "grain keys repeat",
    ),
    "check_non_negative": _check(
        "stock_not_negative", "error", "sum(CASE WHEN units < 0 THEN 1 ELSE 0 END)", "count(*)", 0.0, "inventory",
        "readings are below zero",
    ),
    "check_revenue_positive": _check(
        "monthly_revenue_positive", "error", "sum(CASE WHEN revenue <= 0 THEN 1 ELSE 0 END)", "count(*)", 0.0, "growth",
        "channel-months have no revenue",
    ),
    "check_turnover_valid": _check(
        "turnover_valid", "error", "sum(CASE WHEN turnover IS NULL OR turnover <= 0 THEN 1 ELSE 0 END)", "count(*)",
        0.0, "turnover_top", "products have no turnover",
    ),
}

CTES["quality_report"] = (
    "\nUNION ALL\n".join(
        f"SELECT *, (SELECT sales_cutoff FROM cutoffs) AS cutoff FROM ({sql})" for sql in CHECKS.values()
    )
)

_FACT_OUT = """doc_id, channel, date, store_id, product_key, doc_type, is_revenue, units,
    CAST(amount AS DOUBLE) AS amount, currency, CAST(amount_src AS DOUBLE) AS amount_src"""

FINAL: dict[str, str] = {
    "csv_strict_roundtrip": "SELECT doc_id, ts, store_id, sku, units, CAST(amount AS DOUBLE) AS amount, currency, doc_type FROM pos_raw",
    "csv_rejected_rows": """
        SELECT doc_id, CASE WHEN doc_id LIKE '%-4' THEN 'malformed'
                            WHEN CAST(split_part(doc_id, '-', 1) AS BIGINT) % 50 = 0 THEN 'no store_id' ELSE 'accepted' END AS reason,
               count(*) AS rows
        FROM pos_raw GROUP BY ALL""",
    "fx_csv_dimension": "SELECT date, currency, CAST(rate AS DOUBLE) AS rate FROM fx",
    "parquet_projected": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "json_explode_snapshots": "SELECT strftime(date, '%Y-%m-%d') AS date, store_id, sku_erp, stock FROM snapshots_raw",
    "json_document_stores": "SELECT store_id, city, region, timezone FROM stores_raw",
    "json_document_mappings": "SELECT sku_pos, sku_erp, handle FROM mappings_raw",
    "json_multiline_catalog": "SELECT sku_erp, name, category, valid_from, CAST(cost AS DOUBLE) AS cost, supplier FROM catalog_versions",
    "json_document_ranges": """
        SELECT 'stores' AS "array", store_id AS id, concat_ws('|', city, region, timezone) AS detail FROM stores_raw
        UNION ALL SELECT 'mappings', handle, concat_ws('|', sku_pos, sku_erp) FROM mappings_raw
        UNION ALL SELECT 'catalog', sku_erp, concat_ws('|', name, category, valid_from, CAST(cost AS VARCHAR), supplier) FROM catalog_versions
        UNION ALL SELECT 'snapshots', store_id, concat_ws('|', strftime(date, '%Y-%m-%d'), sku_erp, stock) FROM snapshots_raw""",
    "json_explode_nested_costs": "SELECT sku_erp, name, category, valid_from, CAST(cost AS DOUBLE) AS cost, supplier FROM catalog_versions",
    "lineage_stamp": "SELECT doc_id, store_id, sku, 'pos:lineitem' AS _source FROM pos_raw",
    "partitioned_parquet_roundtrip": f"""
        SELECT {_FACT_OUT}, strftime(date, '%Y-%m') AS month FROM sales
        WHERE strftime(date, '%Y-%m') >= (SELECT strftime(s12, '%Y-%m') FROM win)""",
    "csv_export_roundtrip": "SELECT * FROM growth",
    "key_extract_pos": f"SELECT DISTINCT sku, {key_pos('sku')} AS product_key FROM pos_raw",
    "key_extract_erp": f"SELECT DISTINCT sku_erp, {key_erp('sku_erp')} AS product_key FROM snapshots_raw",
    "key_extract_handle": f"""
        SELECT DISTINCT handle, {key_handle('handle')} AS product_key
        FROM (SELECT handle FROM online_raw UNION ALL SELECT handle FROM mappings_raw)""",
    "mapping_discrepancies": "SELECT sku_pos, sku_erp, handle, key_pos, key_erp, key_handle FROM mapping_flags WHERE discrepant",
    "dim_store_with_online": "SELECT * FROM stores",
    "dim_product_alias_fallback": "SELECT * FROM products",
    "scd2_intervals": "SELECT product_key, valid_from, valid_to, CAST(cost AS DOUBLE) AS cost, supplier FROM cost_dim",
    "scd2_spliced": """
        SELECT product_key, valid_from,
               coalesce(CAST(lead(valid_from) OVER (PARTITION BY product_key ORDER BY valid_from) - 1 AS DATE), DATE '9999-12-31') AS valid_to,
               CAST(cost AS DOUBLE) AS cost, supplier
        FROM (SELECT product_key, valid_from, supplier,
                     CASE WHEN product_key % 3 = 0 AND supplier = 'SUP-2' THEN cost * 2 ELSE cost END AS cost
              FROM cost_dedup WHERE supplier <> CASE WHEN product_key % 3 = 0 THEN 'SUP-1' ELSE 'SUP-4' END)""",
    "fx_dimension_identity": "SELECT date, currency, CAST(rate AS DOUBLE) AS rate FROM fx",
    "calendar_days": """
        SELECT date, CAST(year(date) AS INTEGER) AS year, strftime(date, '%Y-%m') AS month,
               CAST(year(date) AS VARCHAR) || '-Q' || CAST(quarter(date) AS VARCHAR) AS quarter
        FROM (SELECT CAST(unnest(generate_series(CAST(min(CAST(l_shipdate AS DATE)) AS TIMESTAMP),
                                                 CAST(max(CAST(l_shipdate AS DATE)) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
              FROM lineitem)""",
    "document_sign_totals": f"""
        SELECT doc_type, count(*) AS lines, CAST(sum(CASE WHEN is_revenue THEN 1 ELSE 0 END) AS BIGINT) AS revenue_lines,
               CAST(sum(units) AS BIGINT) AS units, {money('sum(amount_src)')} AS amount_src
        FROM pos_fact GROUP BY doc_type""",
    "sales_fact_pos": f"SELECT {_FACT_OUT} FROM pos_fact",
    "dedup_by_document": """
        SELECT d.doc_id, c.copies, CAST(d.ts AS DATE) AS date, d.store_id, d.sku, d.units,
               CAST(d.amount AS DOUBLE) AS amount, d.currency, d.doc_type
        FROM pos_dedup d JOIN (SELECT doc_id, count(*) AS copies FROM pos_raw GROUP BY doc_id HAVING count(*) > 1) c
             ON d.doc_id = c.doc_id""",
    "sales_fact_online_fx": f"SELECT {_FACT_OUT} FROM online_fact",
    "sales_unified_by_channel": f"""
        SELECT channel, currency, count(*) AS lines, CAST(sum(units) AS BIGINT) AS units,
               {money('sum(amount)')} AS amount, {money('sum(amount_src)')} AS amount_src,
               CAST(sum(CASE WHEN amount IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS lines_without_rate
        FROM sales GROUP BY channel, currency""",
    "inventory_readings": "SELECT * FROM inventory",
    "dedup_by_grain": """
        SELECT i.date, i.store_id, i.product_key, c.copies, i.units, i.reading_valid
        FROM inventory i JOIN (SELECT date, store_id, product_key, count(*) AS copies FROM readings
                               GROUP BY date, store_id, product_key HAVING count(*) > 1) c
             ON i.date = c.date AND i.store_id = c.store_id AND i.product_key = c.product_key""",
    "inventory_valued_asof": """
        SELECT date, store_id, product_key, units, reading_valid, CAST(cost AS DOUBLE) AS cost,
               CAST(value AS DOUBLE) AS value FROM valued""",
    "sales_costed_asof": """
        SELECT doc_id, channel, date, product_key, is_revenue, units, CAST(amount AS DOUBLE) AS amount,
               CAST(cost AS DOUBLE) AS cost, CAST(cost_total AS DOUBLE) AS cost_total, CAST(margin AS DOUBLE) AS margin
        FROM costed""",
    "sales_costed_asof_window": """
        SELECT doc_id, channel, date, product_key, is_revenue, units, CAST(amount AS DOUBLE) AS amount,
               CAST(cost AS DOUBLE) AS cost, CAST(cost_total AS DOUBLE) AS cost_total, CAST(margin AS DOUBLE) AS margin
        FROM costed""",
    "sales_costed_bucketed": """
        SELECT doc_id, channel, date, product_key, is_revenue, units, CAST(amount AS DOUBLE) AS amount,
               CAST(cost AS DOUBLE) AS cost, CAST(cost_total AS DOUBLE) AS cost_total, CAST(margin AS DOUBLE) AS margin
        FROM costed""",
    "inventory_valued_bucketed": """
        SELECT date, store_id, product_key, units, reading_valid, CAST(cost AS DOUBLE) AS cost,
               CAST(value AS DOUBLE) AS value FROM valued""",
    "sales_incremental": """
        SELECT doc_id, channel, date, product_key, is_revenue, units, CAST(amount AS DOUBLE) AS amount,
               CAST(cost AS DOUBLE) AS cost, CAST(cost_total AS DOUBLE) AS cost_total, CAST(margin AS DOUBLE) AS margin
        FROM costed""",
    "cutoff_date": "SELECT sales_cutoff AS cutoff FROM cutoffs",
    "cutoff_from_footers": """
        SELECT (SELECT max(date) FROM sales) AS sales_cutoff, (SELECT max(date) FROM inventory) AS stock_cutoff""",
    "month_window_bounds": """
        SELECT sales_cutoff AS cutoff, n AS months,
               CAST(date_trunc('month', sales_cutoff) - to_months(n - 1) AS DATE) AS window_start,
               sales_cutoff AS window_end
        FROM cutoffs, (VALUES (1), (3), (6), (12)) AS v(n)""",
    "quarter_window_bounds": """
        SELECT 'sales' AS source, sales_cutoff AS cutoff, CAST(date_trunc('quarter', sales_cutoff) AS DATE) AS quarter_start,
               CAST(year(sales_cutoff) AS VARCHAR) || '-Q' || CAST(quarter(sales_cutoff) AS VARCHAR) AS quarter
        FROM cutoffs
        UNION ALL
        SELECT 'stock', c, qs, ql FROM sq""",
    "inventory_turnover_topn": "SELECT * FROM turnover_top",
    "stockout_streaks": "SELECT * FROM streak_detail",
    "stockout_by_store": """
        SELECT store_id, city, region, quarter, count(*) AS stockouts, count(DISTINCT product_key) AS products_affected,
               CAST(sum(consecutive_days) AS BIGINT) AS stockout_days, max(consecutive_days) AS longest_stockout
        FROM streak_detail GROUP BY store_id, city, region, quarter""",
    "zero_days_by_store": f"""
        SELECT z.store_id, zero_days, observed_days, products_with_zero,
               {rhu('CAST(100 AS DOUBLE) * (CAST(1 AS DOUBLE) - ' + div('zero_days', 'observed_days') + ')', 2)} AS availability_pct,
               s.city, s.region, (SELECT ql FROM sq) AS quarter
        FROM (SELECT store_id,
                     CAST(sum(CASE WHEN reading_valid AND units = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_days,
                     CAST(sum(CASE WHEN reading_valid THEN 1 ELSE 0 END) AS BIGINT) AS observed_days,
                     count(DISTINCT CASE WHEN reading_valid AND units = 0 THEN product_key END) AS products_with_zero
              FROM period GROUP BY store_id) z
        JOIN stores s ON z.store_id = s.store_id""",
    "streaks_unknown_breaks": "SELECT store_id, product_key, days FROM runs_breaks",
    "streaks_unknown_bridged": "SELECT store_id, product_key, days FROM runs_bridged",
    "streaks_unknown_as_zero": "SELECT store_id, product_key, days FROM runs_as_zero",
    "streak_sensitivity": """
        SELECT v.scenario, CAST(coalesce(r.runs, 0) AS BIGINT) AS runs, CAST(coalesce(r.stores, 0) AS BIGINT) AS stores
        FROM (VALUES ('unknown_breaks'), ('unknown_bridged'), ('unknown_as_zero')) AS v(scenario)
        LEFT JOIN (
            SELECT scenario, count(*) AS runs, count(DISTINCT store_id) AS stores FROM (
                SELECT 'unknown_breaks' AS scenario, store_id FROM runs_breaks
                UNION ALL SELECT 'unknown_bridged', store_id FROM runs_bridged
                UNION ALL SELECT 'unknown_as_zero', store_id FROM runs_as_zero)
            GROUP BY scenario) r ON v.scenario = r.scenario""",
    "streaks_history": """
        SELECT scenario, store_id, product_key, count(*) AS days FROM (
            SELECT 'unknown_breaks' AS scenario, store_id, product_key, day - zeros AS isl FROM hist WHERE reading_valid AND units = 0
            UNION ALL SELECT 'unknown_bridged', store_id, product_key, valid_axis - zeros FROM hist WHERE reading_valid AND units = 0
            UNION ALL SELECT 'unknown_as_zero', store_id, product_key, day - maybe_zeros FROM hist WHERE units = 0 OR NOT reading_valid)
        GROUP BY scenario, store_id, product_key, isl HAVING count(*) > 3""",
    "mom_growth_by_channel": "SELECT * FROM growth",
    "negative_margin_product": """
        SELECT m.product_key, p.sku_pos, p.sku_erp, p.name, p.category, m.units, m.revenue, m.cogs, m.margin, m.margin_pct,
               m.lines, m.lines_without_cost, m.lines_without_rate
        FROM m_product m JOIN products p ON m.product_key = p.product_key""",
    "negative_margin_product_store": """
        SELECT f.product_key, p.sku_pos, p.name, p.category, f.store_id, s.city, s.region, f.channel,
               f.units, f.revenue, f.cogs, f.margin, f.margin_pct,
               f.lines, f.lines_without_cost, f.lines_without_rate
        FROM m_fine f JOIN products p ON f.product_key = p.product_key
             JOIN stores s ON f.store_id = s.store_id
        WHERE f.margin < 0 OR f.product_key IN (SELECT product_key FROM m_product)""",
    **CHECKS,
    "checks_from_footers": f"{CHECKS['check_invalid_readings']}\nUNION ALL\n{CHECKS['check_non_negative']}",
    "quality_report": "SELECT * FROM quality_report",
    "quality_gate": "SELECT * FROM quality_report WHERE NOT ok AND severity = 'error'",
    "layered_negative_margin_product": """
        SELECT m.product_key, p.sku_pos, p.sku_erp, p.name, p.category, m.units, m.revenue, m.cogs, m.margin, m.margin_pct,
               m.lines, m.lines_without_cost, m.lines_without_rate
        FROM m_product m JOIN products p ON m.product_key = p.product_key""",
}


def _deps(sql: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{re.escape(n)}\b", sql)]


def assemble(final_sql: str) -> str:
    """Prefix ``final_sql`` with the CTEs it needs, dependencies first."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple[str, ...] = ()) -> None:
        if name in seen:
            return
        for d in _deps(CTES[name]):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        seen.add(name)
        order.append(name)

    for n in _deps(final_sql):
        visit(n)
    if not order:
        return final_sql.strip()
    body = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in order)
    return f"WITH {body}\n{final_sql.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: assemble(sql) for name, sql in FINAL.items()}
