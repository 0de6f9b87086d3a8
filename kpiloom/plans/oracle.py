"""SQL twins of the registered queries, for a second engine on the same tables.

``TABLES`` are named subqueries with the names they build on; ``ORACLE`` maps a query name to
one full statement. Rounding goes through decimal on both sides, so ties agree.
"""

from __future__ import annotations


def r(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def ratio(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0))"


def pct(top: str, bottom: str, digits: int = 2) -> str:
    return r(f"{ratio(top, bottom)} * 100", digits)


def did(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def text(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def n_if(condition: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0) AS BIGINT)"


#: name -> (names it uses, SQL)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "stg_products": (
        (),
        """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
       p_partkey % 10 AS supplier_id,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.60 AS DECIMAL(10,2)) AS cost,
       CAST(p_retailprice AS DECIMAL(10,2)) AS list_price,
       CAST((p_partkey * 37) % 300 AS INTEGER) AS current_stock_level, 100 AS reorder_point,
       CAST(5 + p_partkey % 26 AS INTEGER) AS lead_time_days, p_partkey % 20 <> 0 AS is_active
FROM part""",
    ),
    "stg_customers": (
        (),
        """
SELECT c_custkey AS customer_id, c_name AS customer_name, lower(c_mktsegment) AS segment,
       n_name AS country, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "stg_suppliers": (
        (),
        """
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS country, r_name AS region, s_acctbal >= 0 AS is_active
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "stg_gl_accounts": (
        (),
        """
SELECT gl_account_id, 'Account ' || lower(gl_account_id) AS account_name, account_type,
       account_type = 'Asset' AS is_balance_sheet, true AS is_active
FROM (SELECT DISTINCT o_orderpriority AS gl_account_id,
             CASE WHEN left(o_orderpriority, 1) IN ('1', '4') THEN 'Revenue'
                  WHEN left(o_orderpriority, 1) IN ('2', '5') THEN 'Expense' ELSE 'Asset' END AS account_type
      FROM orders)""",
    ),
    "lines": (
        (),
        """
SELECT order_id, line_number, product_id, supplier_id, quantity, list_price,
       CAST(list_price - order_amount AS DECIMAL(12,2)) AS discount_amount, order_amount, tax_amount,
       CAST(0 AS DECIMAL(12,2)) AS shipping_amount,
       CAST(order_amount + tax_amount AS DECIMAL(12,2)) AS total_amount,
       CAST(list_price * 0.60 AS DECIMAL(12,2)) AS cost_amount, shipping_status
FROM (SELECT *, CAST(order_amount * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS tax_amount
      FROM (SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id, l_suppkey AS supplier_id,
                   CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS list_price, l_tax,
                   CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2))
                     AS order_amount,
                   CASE WHEN l_linestatus = 'F' THEN 'shipped' ELSE 'processing' END AS shipping_status
            FROM lineitem))""",
    ),
    "heads": (
        (),
        """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date, CAST(o_orderdate AS DATE) AS date,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'cancelled' WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'O' THEN 'shipped' WHEN o_orderstatus = 'P' THEN 'pending'
            ELSE lower(o_orderstatus) END AS order_status,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'refunded' WHEN o_orderstatus = 'F' THEN 'paid'
            ELSE 'pending' END AS payment_status
FROM orders""",
    ),
    "stg_orders": (("lines", "heads"), "SELECT * FROM lines JOIN heads USING (order_id)"),
    "totals": (
        ("stg_orders",),
        """
SELECT order_id, customer_id, date, order_status, count(*) AS order_count, sum(order_amount) AS order_amount,
       sum(total_amount) AS total_amount, sum(cost_amount) AS cost_amount
FROM stg_orders GROUP BY ALL""",
    ),
    "sales": (
        ("stg_orders",),
        """
SELECT product_id, date, count(*) AS order_count, sum(quantity) AS quantity, sum(total_amount) AS revenue,
       sum(cost_amount) AS cost
FROM stg_orders GROUP BY ALL""",
    ),
    "category_sales": (
        ("sales", "stg_products"),
        "SELECT category, date, sum(quantity) AS quantity FROM sales JOIN stg_products USING (product_id) GROUP BY ALL",
    ),
    "stg_sessions": (
        (),
        """
SELECT user_id, CAST(ts AS DATE) - 8217 AS date, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_order,
       max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS has_cart
FROM events GROUP BY ALL""",
    ),
    "stg_deliveries": (
        (),
        """
SELECT *, CASE WHEN delivery_date > promised_date THEN 'delayed' WHEN l_linestatus = 'F' THEN 'delivered'
               ELSE 'in_transit' END AS delivery_status,
       CAST(((2 * CAST(total_cost * 100 AS BIGINT) + quantity_ordered) // (2 * quantity_ordered)) / 100.0 AS DECIMAL(12,2))
         AS unit_cost
FROM (SELECT *, order_date + 30 AS promised_date
      FROM (SELECT l_orderkey * 8 + l_linenumber AS delivery_id, l_orderkey AS po_id, l_suppkey AS supplier_id,
                   l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity_ordered,
                   CAST(l_quantity AS INTEGER) AS quantity_delivered,
                   CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS quantity_rejected,
                   CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.60 AS DECIMAL(12,2)) AS total_cost,
                   CAST(l_shipdate AS DATE) AS delivery_date,
                   CAST(l_shipdate AS DATE) - CAST(1 + (l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 45 AS INTEGER)
                     AS order_date,
                   l_returnflag <> 'R' AS is_quality_pass, l_linestatus
            FROM lineitem))""",
    ),
    "fact_deliveries": (
        ("stg_deliveries",),
        f"""
SELECT delivery_id, po_id, supplier_id, product_id, {did('order_date')} AS order_date_id,
       {did('delivery_date')} AS delivery_date_id, {did('promised_date')} AS promised_date_id, order_date, delivery_date,
       quantity_ordered, quantity_delivered, quantity_rejected, unit_cost, total_cost,
       CAST(date_diff('day', order_date, delivery_date) AS INTEGER) AS lead_time_days,
       delivery_date <= promised_date AS is_on_time, is_quality_pass, delivery_status
FROM stg_deliveries""",
    ),
    "fact_transactions": (
        (),
        f"""
SELECT transaction_id, {did('date')} AS transaction_date_id, date, gl_account_id, debit_amount, credit_amount,
       CAST(debit_amount - credit_amount AS DECIMAL(15,2)) AS net_amount, transaction_type,
       'order ' || transaction_id AS description, CAST(transaction_id AS VARCHAR) AS reference_id, 'USD' AS currency_code,
       CAST(1 AS DECIMAL(10,6)) AS exchange_rate, false AS is_intercompany, is_reconciled
FROM (SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS gl_account_id,
             CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_totalprice END AS DECIMAL(15,2)) AS debit_amount,
             CAST(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END AS DECIMAL(15,2)) AS credit_amount,
             CASE WHEN o_orderstatus = 'O' THEN 'payment' WHEN o_orderstatus = 'F' THEN 'invoice'
                  ELSE 'journal_entry' END AS transaction_type,
             o_orderstatus = 'F' AS is_reconciled
      FROM orders)""",
    ),
    "account_months": (
        (),
        """
SELECT o_orderpriority AS gl_account_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS order_count,
       sum(CAST(o_totalprice AS DECIMAL(15,2))) AS amount
FROM orders GROUP BY ALL""",
    ),
    "fact_budget_actuals": (
        ("account_months",),
        f"""
SELECT budget_id, gl_account_id, {did('date')} AS date_id, date, budget_amount, actual_amount,
       CAST(actual_amount - budget_amount AS DECIMAL(15,2)) AS variance_amount,
       {pct('actual_amount - budget_amount', 'budget_amount')} AS variance_pct, budget_type, budget_version
FROM (SELECT CAST({did('month')} AS BIGINT) * 10 + CAST(left(gl_account_id, 1) AS INTEGER) AS budget_id, gl_account_id,
             month AS date, CAST(order_count * 225000 AS DECIMAL(15,2)) AS budget_amount, 'Monthly' AS budget_type,
             1 AS budget_version
      FROM account_months WHERE month(month) <> 12) b
FULL JOIN (SELECT gl_account_id, month AS date, CAST(amount AS DECIMAL(15,2)) AS actual_amount
           FROM account_months WHERE month(month) <> 1) a USING (gl_account_id, date)""",
    ),
    "dim_suppliers": (
        ("stg_suppliers", "fact_deliveries"),
        f"""
SELECT supplier_id, supplier_name, country, region, on_time_delivery_pct, quality_score, lead_time_days, is_active
FROM stg_suppliers LEFT JOIN
  (SELECT supplier_id, {pct('sum(CASE WHEN is_on_time THEN 1 ELSE 0 END)', 'count(is_on_time)')} AS on_time_delivery_pct,
          {pct('sum(CASE WHEN is_quality_pass THEN 1 ELSE 0 END)', 'count(is_quality_pass)')} AS quality_score,
          CAST(round_even(avg(lead_time_days), 0) AS INTEGER) AS lead_time_days
   FROM fact_deliveries GROUP BY supplier_id) USING (supplier_id)""",
    ),
    "ecommerce": (
        ("totals", "stg_sessions", "stg_products"),
        f"""
SELECT {did('date')} AS date_id, date, {big('coalesce(orders, 0)')} AS total_orders,
       {big('coalesce(customers, 0)')} AS total_customers, {dbl('coalesce(revenue, 0)')} AS total_revenue,
       {dbl('coalesce(cost, 0)')} AS total_cost, {dbl('coalesce(profit, 0)')} AS gross_profit,
       coalesce({r(ratio('revenue', 'orders'), 2)}, 0) AS average_order_value, conversion_rate, cart_abandonment_rate,
       coalesce({r(ratio('cost', '(SELECT sum(current_stock_level * cost) FROM stg_products)'), 6)}, 0) AS inventory_turnover
FROM (SELECT date, sum(order_count) AS orders, count(DISTINCT customer_id) AS customers, sum(total_amount) AS revenue,
             sum(cost_amount) AS cost, sum(order_amount - cost_amount) AS profit
      FROM totals GROUP BY date)
FULL JOIN (SELECT date, {pct('sum(has_order)', 'count(*)')} AS conversion_rate,
                  {pct('sum(CASE WHEN has_cart = 1 AND has_order = 0 THEN 1 ELSE 0 END)', 'sum(has_cart)')} AS cart_abandonment_rate
           FROM stg_sessions GROUP BY date) USING (date)""",
    ),
    "supply_chain": (
        ("fact_deliveries",),
        f"""
SELECT {did('delivery_date')} AS date_id, delivery_date AS date, count(delivery_id) AS total_deliveries,
       {n_if('is_on_time')} AS on_time_deliveries,
       {pct('sum(CASE WHEN is_on_time THEN 1 ELSE 0 END)', 'count(is_on_time)')} AS on_time_delivery_pct,
       {dbl('sum(total_cost)')} AS total_procurement_cost, {r('avg(lead_time_days)', 2)} AS average_lead_time_days,
       {pct('sum(CASE WHEN is_quality_pass THEN 1 ELSE 0 END)', 'count(is_quality_pass)')} AS supplier_quality_score
FROM fact_deliveries GROUP BY delivery_date""",
    ),
    "financial": (
        ("fact_transactions", "fact_budget_actuals", "totals"),
        f"""
SELECT {did('date')} AS date_id, date, {dbl('revenue')} AS total_revenue, {dbl('expense')} AS total_expense,
       {dbl('revenue - expense')} AS net_income, {dbl('variance')} AS budget_variance,
       {dbl('sum(revenue - expense) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING)')} AS cash_position, gross_margin_pct,
       {pct('revenue - expense', 'revenue')} AS operating_margin_pct
FROM (SELECT date, coalesce(revenue, 0) AS revenue, coalesce(expense, 0) AS expense, coalesce(variance, 0) AS variance,
             gross_margin_pct
      FROM (SELECT date, sum(debit_amount) AS revenue, sum(credit_amount) AS expense FROM fact_transactions GROUP BY date)
      FULL JOIN (SELECT date, sum(variance_amount) AS variance FROM fact_budget_actuals GROUP BY date) USING (date)
      FULL JOIN (SELECT date, {pct('sum(order_amount - cost_amount)', 'sum(order_amount)')} AS gross_margin_pct
                 FROM totals GROUP BY date) USING (date))""",
    ),
    "unified": (
        ("totals", "fact_deliveries", "stg_suppliers", "stg_products"),
        f"""
SELECT {did('date')} AS date_id, date,
       coalesce({r(ratio('revenue', '(SELECT count(*) FROM stg_suppliers WHERE is_active)'), 2)}, 0) AS revenue_per_supplier,
       coalesce({r(ratio('profit', '(SELECT count(*) FROM stg_products)'), 2)}, 0) AS profit_per_product,
       coalesce(cycle_days, 0) AS order_to_cash_cycle_days,
       {r(ratio('(SELECT sum(current_stock_level * cost) FROM stg_products)', 'revenue'), 4)} AS inventory_to_sales_ratio,
       coalesce(cycle_days, 0) AS cash_conversion_cycle_days
FROM (SELECT date, sum(total_amount) AS revenue, sum(order_amount - cost_amount) AS profit FROM totals GROUP BY date)
FULL JOIN (SELECT order_date AS date, CAST({r('avg(lead_time_days)', 0)} AS INTEGER) AS cycle_days
           FROM fact_deliveries GROUP BY order_date) USING (date)""",
    ),
    "cash_days": (
        ("totals", "fact_transactions"),
        f"""
SELECT date, {dbl('coalesce(i, 0)')} AS inflow, {dbl('coalesce(o, 0)')} AS outflow,
       {dbl('coalesce(i, 0) - coalesce(o, 0)')} AS net_flow
FROM (SELECT date, sum(total_amount) AS i FROM totals WHERE order_status <> 'cancelled' GROUP BY date)
FULL JOIN (SELECT date, sum(credit_amount) AS o FROM fact_transactions
           WHERE transaction_type IN ('payment', 'expense') GROUP BY date) USING (date)""",
    ),
}


def _scored(series: str, sigma: str = "2.0") -> str:
    """Rows of a metric frame with points, mean, sd, z and verdict from the 30 rows before."""
    frame = "(PARTITION BY domain, metric, entity ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
    return f"""
SELECT domain, metric, entity, date, value, points, CASE WHEN points >= 3 THEN m ELSE 0 END AS mean,
       CASE WHEN points >= 3 THEN s ELSE 0 END AS sd,
       CASE WHEN points < 3 THEN 0 WHEN lo = hi AND value <> lo THEN NULL WHEN lo = hi THEN 0 ELSE (value - m) / s END AS z,
       CASE WHEN points < 3 THEN false WHEN lo = hi THEN value <> lo ELSE abs((value - m) / s) > {sigma} END AS is_anomaly
FROM (SELECT *, CASE WHEN lo = hi THEN lo ELSE raw_mean END AS m, CASE WHEN lo = hi THEN 0 ELSE raw_sd END AS s
      FROM (SELECT *, count(value) OVER w AS points, min(value) OVER w AS lo, max(value) OVER w AS hi,
                   avg(value) OVER w AS raw_mean, stddev_pop(value) OVER w AS raw_sd
            FROM ({series}) WINDOW w AS {frame}))"""


def _fenced(series: str) -> str:
    frame = "(PARTITION BY domain, metric, entity ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
    return f"""
SELECT domain, metric, entity, date, value, CASE WHEN points >= 4 THEN q1 - 1.5 * (q3 - q1) ELSE 0 END AS lower_fence,
       CASE WHEN points >= 4 THEN q3 + 1.5 * (q3 - q1) END AS upper_fence,
       CASE WHEN points >= 4 THEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) ELSE false END AS is_anomaly
FROM (SELECT *, count(value) OVER w AS points, quantile_cont(value, 0.25) OVER w AS q1, quantile_cont(value, 0.75) OVER w AS q3
      FROM ({series}) WINDOW w AS {frame})"""


def _metric(table: str, domain: str, name: str, value: str) -> str:
    return (
        f"SELECT '{domain}' AS domain, '{name}' AS metric, '' AS entity, date, CAST({value} AS DOUBLE) AS value "
        f"FROM {table} WHERE {value} IS NOT NULL"
    )


def _last_days(table: str, entity: str, rows: int = 90) -> str:
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {entity} ORDER BY date DESC) - 1 AS age FROM {table} "
        f"QUALIFY row_number() OVER (PARTITION BY {entity} ORDER BY date DESC) <= {rows}"
    )


def _fit(table: str, entity: str, value: str) -> str:
    v = f"CAST({value} AS DOUBLE)"
    return (
        f"SELECT {entity}, count(*) AS points, regr_slope({v}, -age) AS slope, regr_intercept({v}, -age) AS level, "
        f"regr_r2({v}, -age) AS r2 FROM ({_last_days(table, entity)}) GROUP BY {entity} HAVING count(*) >= 14"
    )


DEVIATION = "abs((value - mean) / nullif(mean, 0) * 100)"
CRITICAL = "(is_anomaly AND (z IS NULL OR abs(z) > 3))"
HORIZON = "CROSS JOIN (SELECT CAST(unnest(range(1, 31)) AS INTEGER) AS day)"

ALERT_METRICS = " UNION ALL ".join(
    (
        _metric("ecommerce", "ecommerce", "revenue", "total_revenue"),
        _metric("ecommerce", "ecommerce", "conversion_rate", "conversion_rate"),
        _metric("ecommerce", "ecommerce", "orders", "total_orders"),
        _metric("supply_chain", "supply_chain", "on_time_delivery_pct", "on_time_delivery_pct"),
    )
)
ALL_METRICS = " UNION ALL ".join(
    (
        _metric("ecommerce", "ecommerce", "revenue", "total_revenue"),
        _metric("ecommerce", "ecommerce", "orders", "total_orders"),
        _metric("ecommerce", "ecommerce", "conversion_rate", "conversion_rate"),
        _metric("supply_chain", "supply_chain", "on_time_delivery_pct", "on_time_delivery_pct"),
        _metric("supply_chain", "supply_chain", "lead_time_days", "average_lead_time_days"),
        _metric("financial", "financial", "net_income", "net_income"),
        _metric("financial", "financial", "expense", "total_expense"),
    )
)
TABLES["budget_alerts"] = (
    ("fact_budget_actuals",),
    f"""
SELECT 'fin_budget_' || gl_account_id || '_' || date AS alert_id,
       CASE WHEN abs(variance_pct) > 20 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, 'financial' AS domain,
       'budget_variance' AS metric, gl_account_id, date, variance_pct, {dbl('variance_amount')} AS variance_amount,
       'Investigate budget variance of ' || format('{{:.1f}}', {r('variance_pct', 1)})
         || '%. Review actual spending patterns.' AS recommendation
FROM fact_budget_actuals WHERE abs(variance_pct) > 10""",
)
TABLES["alerts"] = (
    ("ecommerce", "supply_chain", "budget_alerts"),
    f"""
SELECT CASE metric WHEN 'on_time_delivery_pct' THEN 'sc_delivery_' WHEN 'revenue' THEN 'ecom_revenue_'
            WHEN 'conversion_rate' THEN 'ecom_conv_' ELSE 'ecom_orders_' END || date AS alert_id,
       CASE WHEN metric = 'on_time_delivery_pct' THEN 'CRITICAL' WHEN metric = 'conversion_rate' THEN 'WARNING'
            WHEN {CRITICAL} THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
       domain, metric, date, value AS current_value, {r('mean', 4)} AS expected_value, {r(DEVIATION, 4)} AS deviation_pct
FROM ({_scored(ALERT_METRICS, "CASE WHEN metric = 'on_time_delivery_pct' THEN 1.5 ELSE 2.0 END")})
WHERE is_anomaly AND (metric <> 'on_time_delivery_pct' OR value < mean)
UNION ALL
SELECT alert_id, severity, domain, metric, date, variance_pct, 0, abs(variance_pct) FROM budget_alerts""",
)
TABLES["verdicts"] = (
    ("ecommerce", "supply_chain", "financial"),
    f"""
SELECT domain, metric, entity, date, value AS current_value, {r('mean', 4)} AS expected_value, {r('z', 6)} AS z_score, is_anomaly
FROM ({_scored(ALL_METRICS)})""",
)


def _check(source: str, table: str, failures: dict[str, str]) -> str:
    """One row per condition with its number of failing rows."""
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, CASE WHEN {n_if(condition)} > 0 THEN 'FAILED' ELSE 'PASSED' END "
        f"AS status, count(*) AS record_count, {n_if(condition)} AS failed_count FROM {source}"
        for name, condition in failures.items()
    )


def _orphans(child: str, key: str, parent: str, parent_key: str, table: str) -> str:
    return _check(
        f"(SELECT {key} FROM {child} WHERE {key} IS NOT NULL)",
        table,
        {f"orphan_{key}": f"{key} NOT IN (SELECT {parent_key} FROM {parent})"},
    )


def _outside(column: str, *domain: str) -> str:
    return f"{column} NOT IN ({', '.join(repr(v) for v in domain)})"


CHECKS_ORDERS = " UNION ALL ".join(
    (
        _check("lines", "stg_orders", {"null_order_id": "order_id IS NULL", "negative_amounts": "total_amount < 0"}),
        _check("heads", "stg_orders", {"null_customer_id": "customer_id IS NULL"}),
    )
)
CHECKS_DELIVERIES = _check("stg_deliveries", "stg_deliveries", {"over_deliveries": "quantity_delivered > quantity_ordered"})
CHECKS_TRANSACTIONS = _check(
    "fact_transactions", "stg_transactions", {"zero_amounts": "debit_amount + credit_amount = 0"}
)
CHECKS_KEYS = " UNION ALL ".join(
    (
        _orphans("lines", "order_id", "heads", "order_id", "stg_orders"),
        _orphans("lines", "product_id", "stg_products", "product_id", "stg_orders"),
        _orphans("lines", "supplier_id", "stg_suppliers", "supplier_id", "stg_orders"),
        _orphans("heads", "customer_id", "stg_customers", "customer_id", "stg_orders"),
        _orphans("fact_transactions", "gl_account_id", "stg_gl_accounts", "gl_account_id", "stg_transactions"),
    )
)
CHECKS_RANGES = " UNION ALL ".join(
    (
        _check(
            "stg_products",
            "dim_products",
            {
                "lead_time_not_positive": "lead_time_days <= 0",
                "cost_above_list_price": "cost > list_price",
                "stock_negative": "current_stock_level < 0",
                "brand_number_not_a_number": "try_cast(regexp_extract(subcategory, '#(.*)$', 1) AS INTEGER) IS NULL",
            },
        ),
        _check(
            "lines",
            "stg_orders",
            {
                "quantity_not_positive": "quantity <= 0",
                "sold_below_cost": "order_amount < cost_amount",
                "discount_above_price": "discount_amount > list_price",
            },
        ),
        _check(
            "fact_deliveries",
            "fact_deliveries",
            {
                "lead_time_not_positive": "lead_time_days <= 0",
                "late_delivery": "NOT is_on_time",
                "rejected_above_delivered": "quantity_rejected > quantity_delivered",
            },
        ),
    )
)
CHECKS_ENUMS = " UNION ALL ".join(
    (
        _check(
            "heads",
            "stg_orders",
            {
                "order_status_not_in_domain": _outside(
                    "order_status", "pending", "shipped", "delivered", "cancelled", "returned"
                ),
                "payment_status_not_in_domain": _outside("payment_status", "pending", "paid", "failed", "refunded"),
            },
        ),
        _check(
            "stg_deliveries",
            "stg_deliveries",
            {
                "delivery_status_not_in_domain": _outside(
                    "delivery_status", "pending", "in_transit", "delivered", "delayed", "cancelled"
                )
            },
        ),
        _check(
            "fact_transactions",
            "stg_transactions",
            {
                "transaction_type_not_in_domain": _outside(
                    "transaction_type", "journal_entry", "invoice", "payment", "credit_memo", "debit_memo"
                )
            },
        ),
        _check("stg_customers", "stg_customers", {"segment_not_in_domain": _outside("segment", "vip", "regular", "new", "inactive")}),
    )
)
CHECKS_DUPLICATES = f"""
SELECT 'stg_orders' AS table_name, 'duplicate_keys' AS check_name,
       CASE WHEN {big('sum(n - 1)')} > 0 THEN 'FAILED' ELSE 'PASSED' END AS status, {big('sum(n)')} AS record_count,
       {big('sum(n - 1)')} AS failed_count
FROM (SELECT count(*) AS n FROM lines GROUP BY order_id, line_number)"""
STAGED = ("lines", "heads", "stg_orders", "stg_products", "stg_suppliers", "stg_customers", "stg_gl_accounts")

ORACLE: dict[str, str] = {}


def _with(uses: tuple[str, ...], select: str) -> str:
    """The statement, preceded by the named subqueries it needs in order of dependence."""
    needed: dict[str, None] = {}

    def need(name: str) -> None:
        for other in TABLES[name][0]:
            need(other)
        needed[name] = None

    for name in uses:
        need(name)
    body = ",\n".join(f"{name} AS ({TABLES[name][1].strip()})" for name in needed)
    return f"WITH {body}\n{select.strip()}" if needed else select.strip()


def twin(name: str, uses: tuple[str, ...], select: str) -> None:
    ORACLE[name] = _with(uses, select)


# --- dimensions ------------------------------------------------------------------------------

twin(
    "dim_products",
    ("stg_products",),
    f"SELECT * REPLACE ({dbl('cost')} AS cost, {dbl('list_price')} AS list_price) FROM stg_products",
)
twin(
    "dim_customers_ltv",
    ("stg_customers", "totals"),
    f"""SELECT customer_id, customer_name, segment, country, region, {dbl('coalesce(v, 0)')} AS lifetime_value
FROM stg_customers LEFT JOIN (SELECT customer_id, sum(total_amount) AS v FROM totals GROUP BY customer_id) USING (customer_id)""",
)
twin("dim_suppliers_scorecard", ("dim_suppliers",), "SELECT * FROM dim_suppliers")
twin("dim_gl_accounts", ("stg_gl_accounts",), "SELECT * FROM stg_gl_accounts")
twin(
    "dim_dates",
    (),
    f"""SELECT {did('date')} AS date_id, date, year(date) AS year, quarter(date) AS quarter, month(date) AS month,
       week(date) AS week, isoyear(date) AS iso_year, day(date) AS day_of_month, isodow(date) AS day_of_week,
       dayname(date) AS day_name, monthname(date) AS month_name, isodow(date) >= 6 AS is_weekend, false AS is_holiday
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders)""",
)
COSTS = "SELECT product_id, delivery_date AS valid_from, max(unit_cost) AS unit_cost FROM stg_deliveries GROUP BY ALL"
VERSIONS = f"""SELECT product_id, valid_from, unit_cost,
       CAST(row_number() OVER w AS INTEGER) AS version, lead(valid_from) OVER w - 1 AS valid_to,
       lead(valid_from) OVER w IS NULL AS is_current
FROM (SELECT *, lag(unit_cost) OVER (PARTITION BY product_id ORDER BY valid_from) AS before FROM ({COSTS}))
WHERE unit_cost IS DISTINCT FROM before
WINDOW w AS (PARTITION BY product_id ORDER BY valid_from)"""
for _name in ("dim_products_scd2", "dim_products_scd2_incremental"):
    twin(_name, ("stg_deliveries",), f"SELECT * REPLACE ({dbl('unit_cost')} AS unit_cost) FROM ({VERSIONS})")
twin(
    "fact_orders_asof_cost",
    ("stg_orders", "stg_deliveries"),
    f"""SELECT o.order_id, o.line_number, o.product_id, CAST(o.order_date AS DATE) AS order_day, o.quantity,
       {dbl('o.cost_amount')} AS cost_amount, v.version, {dbl('v.unit_cost')} AS unit_cost,
       {dbl('CAST(o.quantity * v.unit_cost AS DECIMAL(18,2))')} AS cost_as_of
FROM stg_orders o ASOF LEFT JOIN ({VERSIONS}) v ON o.product_id = v.product_id AND CAST(o.order_date AS DATE) >= v.valid_from""",
)

# --- facts -----------------------------------------------------------------------------------

twin(
    "fact_orders",
    ("stg_orders",),
    f"""SELECT order_id, {did('order_date')} AS order_date_id, customer_id, product_id, supplier_id, quantity,
       {', '.join(f'{dbl(c)} AS {c}' for c in ('list_price', 'discount_amount', 'order_amount', 'tax_amount', 'shipping_amount', 'total_amount', 'cost_amount'))},
       {dbl('order_amount - cost_amount')} AS gross_profit,
       {pct('order_amount - cost_amount', 'order_amount')} AS gross_margin_pct, order_status, payment_status,
       shipping_status, {text('order_date')} AS created_at
FROM stg_orders""",
)
twin(
    "fact_deliveries",
    ("fact_deliveries",),
    f"SELECT * REPLACE ({dbl('unit_cost')} AS unit_cost, {dbl('total_cost')} AS total_cost) FROM fact_deliveries",
)
twin(
    "fact_transactions",
    ("fact_transactions",),
    f"""SELECT * REPLACE ({', '.join(f'{dbl(c)} AS {c}' for c in ('debit_amount', 'credit_amount', 'net_amount', 'exchange_rate'))})
FROM fact_transactions""",
)
BUDGET_AS_DOUBLE = ", ".join(f"{dbl(c)} AS {c}" for c in ("budget_amount", "actual_amount", "variance_amount"))
twin("fact_budget_actuals", ("fact_budget_actuals",), f"SELECT * REPLACE ({BUDGET_AS_DOUBLE}) FROM fact_budget_actuals")

# --- marts -----------------------------------------------------------------------------------

twin("kpi_ecommerce_daily", ("ecommerce",), "SELECT * FROM ecommerce")
twin("kpi_supply_chain_daily", ("supply_chain",), "SELECT * FROM supply_chain")
twin("kpi_financial_daily", ("financial",), "SELECT * FROM financial")
twin("kpi_unified_daily", ("unified",), "SELECT * FROM unified")
twin(
    "kpi_rollup_category_day",
    ("sales", "stg_products"),
    f"""SELECT CAST(grouping(category, date) AS INTEGER) AS level, category, date, {big('sum(order_count)')} AS total_orders,
       {big('sum(quantity)')} AS total_quantity, {dbl('sum(revenue)')} AS total_revenue
FROM sales JOIN stg_products USING (product_id) GROUP BY ROLLUP (category, date)""",
)

# --- serving ---------------------------------------------------------------------------------

RANGE = "date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"
SHOP = "date, total_orders, total_customers, total_revenue, average_order_value, conversion_rate, inventory_turnover"
CHAIN = "date, total_deliveries, on_time_delivery_pct, average_lead_time_days, supplier_quality_score"
twin("ecommerce_metrics_range", ("ecommerce",), f"SELECT {SHOP} FROM ecommerce WHERE {RANGE} ORDER BY date DESC")
for _name, _unit in (("weekly", "week"), ("monthly", "month")):
    twin(
        f"ecommerce_metrics_{_name}",
        ("ecommerce", "totals"),
        f"""SELECT CAST(date_trunc('{_unit}', date) AS DATE) AS date, {big('sum(total_orders)')} AS total_orders,
       {big('coalesce(any_value(n), 0)')} AS total_customers,
       {dbl('sum(CAST(total_revenue AS DECIMAL(25,2)))')} AS total_revenue,
       coalesce({r(ratio('sum(CAST(total_revenue AS DECIMAL(25,2)))', 'sum(total_orders)'), 2)}, 0) AS average_order_value,
       {r('avg(conversion_rate)', 2)} AS conversion_rate,
       {dbl('sum(CAST(inventory_turnover AS DECIMAL(20,6)))')} AS inventory_turnover
FROM ecommerce LEFT JOIN (SELECT date_trunc('{_unit}', date) AS p, count(DISTINCT customer_id) AS n FROM totals
  WHERE {RANGE} GROUP BY date_trunc('{_unit}', date)) ON p = date_trunc('{_unit}', date)
WHERE {RANGE} GROUP BY date_trunc('{_unit}', date)""",
    )
BOUGHT = f"""SELECT DISTINCT CAST(date_trunc('quarter', date) AS DATE) AS date, customer_id FROM totals
WHERE {RANGE} AND customer_id IS NOT NULL"""
twin(
    "customers_distinct_range",
    ("totals",),
    f"""SELECT b.date, count(*) AS customers, count(k.customer_id) AS returning,
  TRUE AS customers_within_bound, TRUE AS returning_within_bound
FROM ({BOUGHT}) b JOIN (SELECT date, lag(date) OVER (ORDER BY date) AS before FROM (SELECT DISTINCT date FROM ({BOUGHT}))) USING (date)
LEFT JOIN ({BOUGHT}) k ON k.date = before AND k.customer_id = b.customer_id GROUP BY b.date""",
)
twin(
    "conversion_rate_stats",
    ("ecommerce",),
    f"""SELECT 30 AS period_days, coalesce({r('avg(conversion_rate)', 6)}, 0) AS average,
       coalesce({r('min(conversion_rate)', 6)}, 0) AS minimum, coalesce({r('max(conversion_rate)', 6)}, 0) AS maximum,
       coalesce({r('stddev_samp(conversion_rate)', 6)}, 0) AS stddev
FROM ecommerce WHERE date BETWEEN (SELECT max(date) FROM ecommerce) - 30 AND (SELECT max(date) FROM ecommerce)""",
)
twin("supply_chain_metrics_range", ("supply_chain",), f"SELECT {CHAIN} FROM supply_chain WHERE {RANGE}")
twin(
    "supplier_performance",
    ("dim_suppliers",),
    "SELECT supplier_id, supplier_name, on_time_delivery_pct, quality_score, lead_time_days FROM dim_suppliers",
)
twin(
    "financial_metrics_range",
    ("financial",),
    f"SELECT date, total_revenue, total_expense, net_income, gross_margin_pct FROM financial WHERE {RANGE}",
)
twin(
    "budget_vs_actual",
    ("fact_budget_actuals",),
    f"""SELECT gl_account_id, date, {BUDGET_AS_DOUBLE}, variance_pct
FROM fact_budget_actuals WHERE date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'""",
)
twin(
    "unified_kpis_range",
    ("unified",),
    f"""SELECT date, revenue_per_supplier, profit_per_product, order_to_cash_cycle_days, cash_conversion_cycle_days
FROM unified WHERE {RANGE}""",
)
twin(
    "kpi_summary_latest",
    ("ecommerce", "supply_chain", "financial"),
    """SELECT e.date, coalesce(e.total_revenue, 0) AS revenue, coalesce(average_order_value, 0) AS aov,
       coalesce(conversion_rate, 0) AS conversion_rate, coalesce(on_time_delivery_pct, 0) AS on_time_pct,
       coalesce(average_lead_time_days, 0) AS lead_time_days, coalesce(net_income, 0) AS net_income,
       coalesce(gross_margin_pct, 0) AS margin_pct
FROM (SELECT * FROM ecommerce WHERE total_orders > 0 ORDER BY date DESC LIMIT 1) e
LEFT JOIN supply_chain USING (date) LEFT JOIN financial USING (date)""",
)
for _name in ("metrics_page", "metrics_page_seek"):
    twin(_name, ("supply_chain",), f"SELECT {CHAIN} FROM supply_chain ORDER BY date DESC LIMIT 100 OFFSET 200")

# --- anomalies -------------------------------------------------------------------------------

twin(
    "anomaly_revenue_zscore",
    ("ecommerce",),
    f"""SELECT 'ecom_revenue_' || date AS alert_id,
       CASE WHEN {CRITICAL} THEN 'CRITICAL' WHEN is_anomaly THEN 'WARNING' ELSE 'INFO' END AS severity, domain, metric, date,
       value AS current_value, {r('mean', 4)} AS expected_value,
       CASE WHEN is_anomaly THEN {r('mean - 2 * sd', 4)} END AS expected_range_min,
       CASE WHEN is_anomaly THEN {r('mean + 2 * sd', 4)} END AS expected_range_max,
       CASE WHEN is_anomaly THEN {r('z', 6)} END AS z_score,
       CASE WHEN is_anomaly THEN {r(DEVIATION, 4)} ELSE 0 END AS deviation_pct,
       CASE WHEN NOT is_anomaly THEN 'No anomaly detected'
            ELSE coalesce('Revenue ' || CASE WHEN value > mean THEN '↑ up' ELSE '↓ down' END || ' '
                 || format('{{:.1f}}', {r(DEVIATION, 1)}) || '%. Check for system issues or special events.',
                 'Revenue changed from zero. Check for system issues or special events.') END AS recommendation,
       is_anomaly
FROM ({_scored(_metric('ecommerce', 'ecommerce', 'revenue', 'total_revenue'))})""",
)


def _simple(series: str, sigma: str, prefix: str, severity: str, advice: str, condition: str) -> str:
    return f"""SELECT '{prefix}' || date AS alert_id, '{severity}' AS severity, domain, metric, date, value AS current_value,
       {r('mean', 4)} AS expected_value, {r('z', 6)} AS z_score, {r(DEVIATION, 4)} AS deviation_pct, '{advice}' AS recommendation
FROM ({_scored(series, sigma)}) WHERE {condition}"""


twin(
    "anomaly_conversion_zscore",
    ("ecommerce",),
    _simple(
        _metric("ecommerce", "ecommerce", "conversion_rate", "conversion_rate"),
        "2.0",
        "ecom_conv_",
        "WARNING",
        "Check website performance, marketing campaigns, or customer experience issues.",
        "is_anomaly",
    ),
)
twin(
    "anomaly_on_time_low",
    ("supply_chain",),
    _simple(
        _metric("supply_chain", "supply_chain", "on_time_delivery_pct", "on_time_delivery_pct"),
        "1.5",
        "sc_delivery_",
        "CRITICAL",
        "Investigate supplier delays. Consider escalation or alternative suppliers.",
        "is_anomaly AND value < mean",
    ),
)
twin("anomaly_budget_variance", ("budget_alerts",), "SELECT * FROM budget_alerts")
ORDERS_SERIES = _metric("ecommerce", "ecommerce", "orders", "total_orders")
twin(
    "anomaly_orders_zscore",
    ("ecommerce",),
    f"""SELECT 'ecom_orders_' || date AS alert_id, 'zscore' AS method, date, is_anomaly, value AS current_value,
       {r('mean', 4)} AS mean, {r('z', 6)} AS z_score,
       CASE WHEN {CRITICAL} THEN 'CRITICAL' WHEN is_anomaly THEN 'WARNING' ELSE 'INFO' END AS severity
FROM ({_scored(ORDERS_SERIES)})""",
)
twin(
    "anomaly_orders_iqr",
    ("ecommerce",),
    f"""SELECT 'ecom_orders_' || date AS alert_id, 'iqr' AS method, date, is_anomaly, value AS current_value,
       {r('lower_fence', 6)} AS lower_fence, {r('upper_fence', 6)} AS upper_fence,
       CASE WHEN is_anomaly THEN 'WARNING' ELSE 'INFO' END AS severity
FROM ({_fenced(ORDERS_SERIES)})""",
)
twin("alerts_active", ("alerts",), "SELECT * FROM alerts")
twin("alerts_unacknowledged", ("alerts",), "SELECT * FROM alerts WHERE domain <> 'supply_chain'")

# --- forecasts -------------------------------------------------------------------------------

twin(
    "forecast_demand_product",
    ("sales",),
    f"""SELECT product_id, day, {r('v', 6)} AS forecasted_quantity, {r('v * 0.8', 6)} AS lower_bound,
       {r('v * 1.2', 6)} AS upper_bound, {r('greatest(least(coalesce(r2, 1), 1), 0)', 6)} AS confidence_level
FROM (SELECT *, greatest(level + slope * day, 0) AS v FROM ({_fit('sales', 'product_id', 'quantity')}) {HORIZON})""",
)
twin(
    "forecast_demand_category_mean",
    ("category_sales",),
    f"""SELECT category, day, {r('m', 6)} AS forecasted_quantity
FROM (SELECT category, avg(quantity) AS m FROM ({_last_days('category_sales', 'category')}) GROUP BY category
      HAVING count(*) >= 14) {HORIZON}""",
)
TABLES["differences"] = (
    ("category_sales",),
    f"""
SELECT category, t, d, last FROM (
  SELECT category, row_number() OVER w - 1 AS t, y - lag(y) OVER w AS d,
         last_value(y) OVER (PARTITION BY category ORDER BY age DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last,
         count(*) OVER (PARTITION BY category) AS points
  FROM (SELECT category, age, CAST(quantity AS DOUBLE) AS y FROM ({_last_days('category_sales', 'category')}))
  WINDOW w AS (PARTITION BY category ORDER BY age DESC))
WHERE t > 0 AND points >= 14""",
)
ORACLE["forecast_demand_category_arima"] = _with(
    ("differences",),
    f"""SELECT category, day, {r('phi', 2)} AS phi, {r('theta', 2)} AS theta,
       {r('greatest(last + (phi * p + theta * e) * (1 - pow(phi, day)) / (1 - phi), 0)', 4)} AS forecasted_quantity
FROM (SELECT category, last, phi, theta, p, e FROM fold JOIN (SELECT category, max(t) AS t FROM differences GROUP BY category)
        USING (category, t)
      QUALIFY row_number() OVER (PARTITION BY category ORDER BY s, i, j) = 1) {HORIZON}""",
).replace(
    "WITH ", "WITH RECURSIVE ", 1
).replace(
    "\nSELECT category, day",
    """,
fold AS (
  SELECT category, last, i, j, i * 0.05e0 AS phi, j * 0.05e0 AS theta, t, d AS p, 0e0 AS e, 0e0 AS s
  FROM differences CROSS JOIN (SELECT unnest(range(-19, 20)) AS i) CROSS JOIN (SELECT unnest(range(-19, 20)) AS j)
  WHERE t = 1
  UNION ALL
  SELECT category, last, i, j, phi, theta, t, p, e, s + e * e
  FROM (SELECT f.category, f.last, i, j, phi, theta, n.t, n.d AS p, n.d - phi * f.p - theta * f.e AS e, f.s
        FROM fold f JOIN differences n ON n.category = f.category AND n.t = f.t + 1))
SELECT category, day""",
    1,
)

TABLES["arima_series"] = (
    ("category_sales",),
    f"""
SELECT category, list(date ORDER BY age DESC) AS dates, list(y ORDER BY age DESC) AS levels,
  list_transform(range(1, count(*)), lambda t: {{'a': 0e0, 'f': 0e0, 's': 0e0, 'p': 0e0, 'd':
    list(y ORDER BY age DESC)[t + 1] - list(y ORDER BY age DESC)[t]}}) AS steps
FROM (SELECT category, date, age, CAST(quantity AS DOUBLE) AS y FROM ({_last_days('category_sales', 'category')}))
GROUP BY category HAVING count(*) >= 14""",
)


def _filtered(steps: str) -> str:
    """The filter's state after these steps; phi and theta are columns."""
    start = "{'a': 0e0, 'f': (1e0 + 2e0 * phi * theta + theta * theta) / (1e0 - phi * phi), 's': 0e0, 'p': 1e0, 'd': 0e0}"
    after = (
        "{'a': phi * x.d + theta * (x.d - acc.a) / acc.f, 'f': 1e0 + theta * theta - theta * theta / acc.f, "
        "'s': acc.s + (x.d - acc.a) * (x.d - acc.a) / acc.f, 'p': acc.p * acc.f, 'd': 0e0}"
    )
    return f"list_reduce({steps}, lambda acc, x: {after}, {start})"


def _best_point(points: str, per_unit: int) -> str:
    cost = r("CASE WHEN run.s > 0 THEN len(steps) * ln(run.s) ELSE 0 END + ln(run.p)", 9)
    return f"""SELECT * EXCLUDE (run, phi, theta) FROM (SELECT *, {_filtered('steps')} AS run
  FROM (SELECT *, i / {per_unit}e0 AS phi, j / {per_unit}e0 AS theta FROM ({points})))
QUALIFY row_number() OVER (PARTITION BY category ORDER BY {cost}, i, j) = 1"""


_AROUND = "(SELECT CAST(unnest(range(-5, 6)) AS INTEGER) AS {0})"
TABLES["arima_0"] = (
    ("arima_series",),
    _best_point(
        "SELECT * FROM arima_series, (SELECT CAST(unnest(range(-9, 10)) AS INTEGER) AS i), (SELECT CAST(unnest(range(-9, 10)) AS INTEGER) AS j)",
        10,
    ),
)
for _k, (_per_unit, _bound) in enumerate(((50, 49), (250, 245), (1250, 1225)), 1):
    TABLES[f"arima_{_k}"] = (
        (f"arima_{_k - 1}",),
        _best_point(
            f"""SELECT * FROM (SELECT category, dates, levels, steps, 5 * i + di AS i, 5 * j + dj AS j
      FROM arima_{_k - 1}, {_AROUND.format('di')}, {_AROUND.format('dj')}) WHERE abs(i) <= {_bound} AND abs(j) <= {_bound}""",
            _per_unit,
        ),
    )
TABLES["arima_fitted"] = (("arima_3",), "SELECT *, i / 1250e0 AS phi, j / 1250e0 AS theta, len(steps) AS n FROM arima_3")
twin(
    "forecast_demand_arima_likelihood",
    ("arima_fitted",),
    f"""SELECT category, day, {r('phi', 4)} AS phi, {r('theta', 4)} AS theta,
  CASE WHEN run.s > 0 THEN {r('-n / 2e0 * (ln(2 * pi()) + 1 + ln(run.s / n)) - ln(run.p) / 2', 6)} END AS log_likelihood,
  {r('greatest(levels[n + 1] + run.a * (1 - pow(phi, day)) / (1 - phi), 0)', 4)} AS forecasted_quantity
FROM (SELECT *, {_filtered('steps')} AS run FROM arima_fitted) {HORIZON}""",
)
twin(
    "anomaly_arima_residual",
    ("arima_fitted",),
    f"""SELECT category, date, value, expected_value, z_score, abs(z_score) > 2 AS is_anomaly FROM (
  SELECT category, dates[t + 1] AS date, levels[t + 1] AS value, {r('levels[t] + before.a', 4)} AS expected_value,
    {r('coalesce((steps[t].d - before.a) / nullif(sqrt(whole.s / n * before.f), 0), 0)', 6)} AS z_score
  FROM (SELECT *, {_filtered('steps')} AS whole, {_filtered('steps[1:t - 1]')} AS before
        FROM (SELECT *, unnest(range(1, n + 1)) AS t FROM arima_fitted)))""",
)


twin(
    "delivery_quartiles_sketched",
    ("fact_deliveries",),
    f"""SELECT supplier_id, CAST(year(delivery_date) AS INTEGER) AS period, count(*) AS deliveries,
  {big('quantile_disc(lead_time_days, 0.25)')} AS q1, {big('quantile_disc(lead_time_days, 0.5)')} AS median,
  {big('quantile_disc(lead_time_days, 0.75)')} AS q3, TRUE AS within_bound
FROM fact_deliveries WHERE lead_time_days IS NOT NULL GROUP BY supplier_id, year(delivery_date)""",
)


def _even(value: str) -> str:
    return f"CAST(round_even({r(value, 9)}, 0) AS INTEGER)"


twin(
    "forecast_lead_time",
    ("fact_deliveries",),
    f"""SELECT supplier_id, {_even('avg(lead_time_days)')} AS forecasted_lead_time_days,
       {_even('avg(lead_time_days) - stddev_pop(lead_time_days)')} AS lower_bound,
       {_even('avg(lead_time_days) + stddev_pop(lead_time_days)')} AS upper_bound,
       CAST(0.85 AS DOUBLE) AS confidence_level, count(*) AS based_on_deliveries
FROM (SELECT * FROM fact_deliveries
      QUALIFY row_number() OVER (PARTITION BY supplier_id
                                 ORDER BY delivery_date DESC, delivery_id DESC, product_id DESC, lead_time_days DESC) <= 50)
GROUP BY supplier_id""",
)
twin(
    "forecast_cash_flow",
    ("cash_days",),
    f"""SELECT day, {r('i', 2)} AS forecasted_inflow, {r('o', 2)} AS forecasted_outflow, {r('i - o', 2)} AS net_flow,
       {r('greatest(least(fit, 1), 0)', 6)} AS confidence_level
FROM (SELECT day, fit, greatest(il + isl * day, 0) AS i, greatest(ol + osl * day, 0) AS o
      FROM (SELECT regr_slope(inflow, -age) AS isl, regr_intercept(inflow, -age) AS il, regr_slope(outflow, -age) AS osl,
                   regr_intercept(outflow, -age) AS ol,
                   (coalesce(regr_r2(inflow, -age), 1) + coalesce(regr_r2(outflow, -age), 1)) / 2 AS fit
            FROM (SELECT *, row_number() OVER (ORDER BY date DESC) - 1 AS age FROM cash_days
                  QUALIFY row_number() OVER (ORDER BY date DESC) <= 90)
            HAVING count(*) >= 14) {HORIZON})""",
)

# --- quality and loads -----------------------------------------------------------------------

twin("dq_orders", ("lines", "heads"), CHECKS_ORDERS)
twin("dq_deliveries", ("stg_deliveries",), CHECKS_DELIVERIES)
twin("dq_transactions", ("fact_transactions",), CHECKS_TRANSACTIONS)
twin(
    "dq_duplicate_keys",
    ("lines",),
    "SELECT order_id, line_number, count(*) AS occurrences FROM lines GROUP BY ALL HAVING count(*) > 1",
)
twin("dq_referential_integrity", (*STAGED, "fact_transactions"), CHECKS_KEYS)
twin("dq_range_checks", (*STAGED, "fact_deliveries"), CHECKS_RANGES)
twin("dq_enum_domain", (*STAGED, "stg_deliveries", "fact_transactions"), CHECKS_ENUMS)
ALL_CHECKS = " UNION ALL ".join(
    (
        CHECKS_ORDERS,
        CHECKS_DELIVERIES,
        CHECKS_TRANSACTIONS,
        CHECKS_DUPLICATES,
        CHECKS_KEYS,
        CHECKS_RANGES,
        CHECKS_ENUMS,
    )
)
twin(
    "dq_log",
    (*STAGED, "fact_deliveries", "fact_transactions"),
    f"""SELECT table_name, count(*) AS checks, {n_if("status = 'FAILED'")} AS failed_checks, max(record_count) AS record_count,
       {big('sum(failed_count)')} AS failed_count,
       CASE WHEN {n_if("status = 'FAILED'")} > 0 THEN 'FAILED' ELSE 'PASSED' END AS status
FROM ({ALL_CHECKS}) GROUP BY table_name""",
)
twin(
    "incremental_unprocessed",
    ("heads", "lines"),
    """SELECT order_id, customer_id, date, order_status FROM heads
WHERE order_id NOT IN (SELECT order_id FROM lines WHERE shipping_status = 'shipped')""",
)
twin(
    "incremental_fact_append",
    ("fact_deliveries",),
    f"""SELECT CAST(delivery_date_id // 100 AS INTEGER) AS month_id, count(*) AS rows, {dbl('sum(total_cost)')} AS amount
FROM fact_deliveries GROUP BY delivery_date_id // 100""",
)
twin("incremental_batch", ("supply_chain",), "SELECT * FROM supply_chain")
twin("incremental_batch_shop", ("ecommerce",), "SELECT * FROM ecommerce")
twin(
    "customers_approx_daily",
    ("heads", "lines"),
    """SELECT date, count(DISTINCT customer_id) AS customers, true AS within_bound FROM heads
WHERE order_id IN (SELECT order_id FROM lines) GROUP BY date""",
)
AUDITED = {
    "dim_products": "stg_products",
    "dim_gl_accounts": "stg_gl_accounts",
    "dim_dates": "(SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) FROM orders)",
    "fact_orders": "stg_orders",
    "fact_deliveries": "fact_deliveries",
    "fact_transactions": "fact_transactions",
    "fact_budget_actuals": "fact_budget_actuals",
    "dim_customers": "stg_customers",
    "dim_suppliers": "dim_suppliers",
    "ecommerce_daily_metrics": "ecommerce",
    "supply_chain_daily_metrics": "supply_chain",
    "financial_daily_metrics": "financial",
    "unified_kpi_metrics": "unified",
    "data_quality_log": f"({CHECKS_ORDERS} UNION ALL {CHECKS_DELIVERIES} UNION ALL {CHECKS_TRANSACTIONS})",
}
twin(
    "load_audit_summary",
    (*STAGED, "fact_budget_actuals", "dim_suppliers", "ecommerce", "supply_chain", "financial", "unified"),
    "SELECT 'etl_batch_processing' AS process_name, table_name, record_count, 'SUCCESS' AS status, CAST(1 AS BIGINT) AS attempts FROM ("
    + " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS record_count FROM {source}" for name, source in AUDITED.items())
    + ")",
)

# --- events and streams ----------------------------------------------------------------------

twin(
    "encode_order_events",
    ("stg_orders",),
    f"""SELECT CAST(order_id AS VARCHAR) AS key, order_id, customer_id, product_id, supplier_id,
       {text('order_date')} AS order_date, quantity,
       {', '.join(f'{dbl(c)} AS {c}' for c in ('list_price', 'discount_amount', 'order_amount', 'tax_amount', 'shipping_amount', 'total_amount', 'cost_amount'))},
       order_status, payment_status, shipping_status, {text('order_date')} AS created_at
FROM stg_orders""",
)
twin(
    "encode_batch_keyed",
    ("fact_transactions",),
    f"""SELECT 'financials.transactions' AS topic, gl_account_id AS key, count(*) AS messages,
       {dbl('sum(debit_amount)')} AS debit, {dbl('sum(credit_amount)')} AS credit
FROM fact_transactions GROUP BY gl_account_id""",
)
twin(
    "encode_batch_isolated",
    ("fact_transactions",),
    f"""SELECT 'financials.transactions' AS topic, outcome, count(*) AS messages,
       {big("sum(sum(CASE WHEN outcome = 'queued' THEN 1 ELSE 0 END)) OVER ()")} AS queued_in_all
FROM (SELECT CASE WHEN transaction_id % 97 = 0 THEN 'not_a_number' WHEN transaction_id % 89 = 0 THEN 'too_large' ELSE 'queued' END AS outcome
      FROM fact_transactions) GROUP BY outcome""",
)
twin("csv_mart_roundtrip", ("supply_chain",), f"SELECT {CHAIN} FROM supply_chain")
twin(
    "csv_ecommerce_roundtrip",
    ("ecommerce",),
    "SELECT date, total_orders, total_customers, total_revenue, average_order_value, conversion_rate, inventory_turnover FROM ecommerce",
)
twin(
    "csv_financial_roundtrip",
    ("financial",),
    "SELECT date, total_revenue, total_expense, net_income, gross_margin_pct FROM financial",
)
twin(
    "stream_decode_orders",
    ("stg_orders",),
    f"""SELECT date, order_status, count(*) AS orders, {dbl('sum(total_amount)')} AS revenue
FROM stg_orders GROUP BY date, order_status""",
)
STOCK = "CAST(json_extract_string(props, '$.k') AS INTEGER) * 3"
twin(
    "stream_quarantine",
    (),
    f"""SELECT CAST(event_id AS VARCHAR) AS key, event_type = 'error' AS is_corrupt,
       CASE WHEN event_type <> 'error' THEN {STOCK} END AS stock_level,
       CASE WHEN event_type = 'error' THEN '{{"product_id": ' || user_id || ', "stock_level": ' || {STOCK} END AS raw_value
FROM events""",
)
twin(
    "stream_land_staging",
    ("fact_transactions",),
    f"""SELECT date, transaction_type, count(*) AS transactions, {dbl('sum(debit_amount)')} AS debit,
       {dbl('sum(credit_amount)')} AS credit
FROM fact_transactions GROUP BY date, transaction_type""",
)
twin(
    "stream_multi_topic_route",
    ("stg_orders", "stg_customers", "fact_deliveries", "fact_transactions", "fact_budget_actuals"),
    f"""SELECT topic, count(*) AS messages, count(DISTINCT key) AS keys, {dbl('sum(amount)')} AS amount
FROM (SELECT 'ecommerce.orders' AS topic, order_id AS key, total_amount AS amount FROM stg_orders
      UNION ALL SELECT 'supply_chain.deliveries', delivery_id, total_cost FROM fact_deliveries
      UNION ALL SELECT 'financials.transactions', transaction_id, net_amount FROM fact_transactions
      UNION ALL SELECT 'financials.budgets', budget_id, budget_amount FROM fact_budget_actuals WHERE budget_id IS NOT NULL
      UNION ALL SELECT 'financials.actuals', date_id * 10 + CAST(left(gl_account_id, 1) AS INTEGER), actual_amount
        FROM fact_budget_actuals WHERE actual_amount IS NOT NULL
      UNION ALL SELECT 'supply_chain.purchase_orders', po_id, total_cost FROM fact_deliveries
      UNION ALL SELECT 'ecommerce.customers', customer_id, NULL FROM stg_customers
      UNION ALL SELECT 'supply_chain.suppliers', s_suppkey, NULL FROM supplier
      UNION ALL SELECT 'ecommerce.inventory', user_id, {STOCK} FROM events)
GROUP BY topic""",
)
AMOUNT = "CAST(value AS DECIMAL(12,2))"


def _windows(starts: str, span: str) -> str:
    return f"""SELECT {text('w')} AS window_start, {text(f'w + INTERVAL {span}')} AS window_end, count(*) AS orders,
       {dbl(f'sum({AMOUNT})')} AS revenue
FROM (SELECT value, {starts} AS w FROM events WHERE event_type = 'purchase') GROUP BY w"""


twin("stream_tumbling_revenue", (), _windows("date_trunc('hour', ts)", "1 HOUR"))
twin(
    "stream_sliding_revenue",
    (),
    _windows(
        "unnest([time_bucket(INTERVAL 15 MINUTES, ts) - INTERVAL 45 MINUTES, time_bucket(INTERVAL 15 MINUTES, ts) - INTERVAL "
        "30 MINUTES, time_bucket(INTERVAL 15 MINUTES, ts) - INTERVAL 15 MINUTES, time_bucket(INTERVAL 15 MINUTES, ts)])",
        "1 HOUR",
    ),
)
HOURLY = (
    "SELECT 'ecommerce' AS domain, 'hourly_revenue' AS metric, '' AS entity, date_trunc('hour', ts) AS date, "
    f"{dbl(f'sum({AMOUNT})')} AS value FROM events WHERE event_type = 'purchase' GROUP BY date_trunc('hour', ts)"
)
twin(
    "stream_zscore",
    (),
    f"""SELECT {text('date')} AS hour, value AS revenue, {r('mean', 4)} AS expected_value, {r('z', 6)} AS z_score, is_anomaly,
  date + INTERVAL 1 HOUR > (SELECT date_trunc('milliseconds', max(ts)) FROM events WHERE event_type = 'purchase') - INTERVAL 1 HOUR AS is_open
FROM ({_scored(HOURLY)})""",
)
twin(
    "stream_stock_alerts",
    ("stg_products",),
    f"""SELECT product_id, product_name, event_id, {text('ts')} AS at, previous_level, stock_level,
       stock_level - previous_level AS change_quantity, reorder_point
FROM (SELECT *, CASE WHEN lag(ts) OVER w + INTERVAL 7 DAYS >= ts THEN lag(stock_level) OVER w END AS previous_level
      FROM (SELECT event_id, ts, user_id AS product_id, {STOCK} AS stock_level FROM events) WHERE stock_level IS NOT NULL
      WINDOW w AS (PARTITION BY product_id ORDER BY ts, event_id))
JOIN stg_products USING (product_id)
WHERE stock_level < reorder_point AND (previous_level IS NULL OR previous_level >= reorder_point)""",
)
twin(
    "stream_sessions",
    (),
    f"""SELECT user_id, {text('min(ts)')} AS session_start, {text('max(ts) + INTERVAL 30 MINUTES')} AS session_end,
       count(*) AS events, {dbl(f'sum({AMOUNT})')} AS total_value,
       max(ts) + INTERVAL 30 MINUTES > (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 1 HOUR AS is_open
FROM (SELECT *, sum(CASE WHEN ts <= before + INTERVAL 30 MINUTES THEN 0 ELSE 1 END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events))
GROUP BY user_id, s""",
)
twin(
    "stream_inventory_low",
    ("stg_products",),
    f"""SELECT product_id, product_name, stock_level, reorder_point, last_seen
FROM (SELECT user_id AS product_id, arg_max({STOCK}, (ts, event_id)) AS stock_level, {text('max(ts)')} AS last_seen
      FROM events GROUP BY user_id)
JOIN stg_products USING (product_id) WHERE stock_level < reorder_point""",
)
twin("stream_dedup", (), "SELECT event_id, user_id, event_type, value FROM events")
twin(
    "stream_click_to_purchase",
    (),
    f"""WITH closing AS (
  SELECT date_trunc('milliseconds', least(max(ts) FILTER (WHERE event_type = 'click'),
                                          max(ts) FILTER (WHERE event_type = 'purchase'))) - INTERVAL 10 MINUTES AS w
  FROM events),
minutes AS (
  SELECT event_type, user_id, date_trunc('minute', ts) AS minute, count(*) AS n, sum({AMOUNT}) AS amount
  FROM events GROUP BY ALL)
SELECT user_id, {text('minute')} AS minute, n AS purchases, {dbl('amount')} AS amount,
  minute + INTERVAL 1 MINUTE > (SELECT w FROM closing) AS is_open
FROM minutes b WHERE event_type = 'purchase' AND EXISTS (
  SELECT 1 FROM minutes c WHERE c.event_type = 'click' AND c.user_id = b.user_id
    AND c.minute BETWEEN b.minute - INTERVAL 60 MINUTES AND b.minute)""",
)
twin(
    "stream_enrich_customer",
    ("stg_customers",),
    f"""SELECT CAST(ts AS DATE) AS date, segment, country, count(*) AS events, {dbl(f'sum({AMOUNT})')} AS total_value
FROM events LEFT JOIN stg_customers ON customer_id = user_id GROUP BY ALL""",
)
twin(
    "stream_late_data",
    (),
    f"""SELECT {text('h')} AS hour, {n_if('counted')} AS counted, {n_if('NOT counted')} AS late,
       {big(f"sum({n_if('NOT counted')}) OVER ()")} AS dropped_by_engine
FROM (SELECT date_trunc('hour', ts) AS h,
             event_type <> 'purchase' OR date_trunc('hour', ts) + INTERVAL 1 HOUR
               > (SELECT date_trunc('milliseconds', max(ts)) FROM events WHERE event_type <> 'purchase') - INTERVAL 1 HOUR AS counted
      FROM events) GROUP BY h""",
)

# --- reports ---------------------------------------------------------------------------------

twin(
    "top_products",
    ("sales", "heads", "stg_products"),
    f"""SELECT CAST(row_number() OVER (ORDER BY v DESC, product_id) AS INTEGER) AS rank, product_id, product_name,
       {dbl('v')} AS revenue, q AS quantity
FROM (SELECT product_id, sum(revenue) AS v, {big('sum(quantity)')} AS q FROM sales
      WHERE date > (SELECT max(date) FROM heads) - 30 GROUP BY product_id ORDER BY v DESC, product_id LIMIT 10)
JOIN stg_products USING (product_id)""",
)
twin(
    "inventory_risk",
    ("stg_products",),
    f"""SELECT product_id, product_name, category, current_stock_level, reorder_point,
       current_stock_level < reorder_point AS below_reorder_point, {dbl('current_stock_level * cost')} AS stock_value
FROM stg_products WHERE is_active AND current_stock_level < reorder_point * 1.2""",
)
twin(
    "cash_position",
    ("fact_transactions",),
    f"""SELECT date, {dbl('d')} AS debit, {dbl('c')} AS credit,
       {dbl('sum(n) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING)')} AS net_cash_position
FROM (SELECT date, sum(debit_amount) AS d, sum(credit_amount) AS c, sum(net_amount) AS n FROM fact_transactions GROUP BY date)""",
)
twin(
    "demand_trend",
    ("sales",),
    f"""SELECT product_id, points, {r('slope', 6)} AS slope_per_day,
       CASE WHEN {r('slope', 6)} > 0.01 THEN 'up' WHEN {r('slope', 6)} < -0.01 THEN 'down' ELSE 'stable' END AS trend_direction
FROM ({_fit('sales', 'product_id', 'quantity')})""",
)
twin(
    "reorder_forecast",
    ("sales", "stg_products"),
    f"""SELECT product_id, current_stock_level, lead_time_days, demand AS lead_time_demand,
       current_stock_level - demand < reorder_point AS needs_reorder,
       {big('ceil(greatest(reorder_point + demand - current_stock_level, 0))')} AS reorder_quantity
FROM (SELECT product_id, {r('sum(greatest(level + slope * day, 0))', 4)} AS demand
      FROM (SELECT product_id, level, slope, unnest(range(1, lead_time_days + 1)) AS day
            FROM ({_fit('sales', 'product_id', 'quantity')}) JOIN stg_products USING (product_id))
      GROUP BY product_id)
JOIN stg_products USING (product_id)""",
)
twin(
    "forecast_accuracy",
    ("category_sales",),
    f"""WITH_ROWS
SELECT category, model, CAST(count(*) AS INTEGER) AS tested_days, {r('avg(abs(y - guess) / abs(y)) * 100', 4)} AS mape
FROM (SELECT category, y, 'linear' AS model, greatest(level + slope * (14 - age), 0) AS guess FROM days JOIN fits USING (category)
      WHERE age < 14 AND y <> 0
      UNION ALL SELECT category, y, 'mean', mean FROM days JOIN fits USING (category) WHERE age < 14 AND y <> 0)
GROUP BY category, model""",
)
ORACLE["forecast_accuracy"] = ORACLE["forecast_accuracy"].replace(
    "\nWITH_ROWS",
    f""",
days AS (SELECT category, age, CAST(quantity AS DOUBLE) AS y FROM ({_last_days('category_sales', 'category', 104)})),
fits AS (SELECT category, avg(y) AS mean, regr_slope(y, 14 - age) AS slope, regr_intercept(y, 14 - age) AS level
         FROM days WHERE age >= 14 GROUP BY category HAVING count(*) >= 14)""",
)
twin(
    "anomaly_cash_flow",
    ("cash_days",),
    f"""SELECT domain, metric, entity, date, value AS current_value, {r('lower_fence', 6)} AS lower_fence,
       {r('upper_fence', 6)} AS upper_fence, is_anomaly
FROM ({_fenced(_metric('cash_days', 'financial', 'net_cash_flow', 'net_flow'))})""",
)
LEAD_TIMES = (
    "SELECT 'supply_chain' AS domain, 'lead_time_days' AS metric, CAST(supplier_id AS VARCHAR) AS entity, "
    f"delivery_date AS date, {r('avg(lead_time_days)', 4)} AS value FROM fact_deliveries GROUP BY supplier_id, delivery_date"
)
twin(
    "anomaly_lead_time",
    ("fact_deliveries",),
    f"""SELECT domain, metric, entity, date, value AS current_value, {r('mean', 4)} AS expected_value, {r('z', 6)} AS z_score,
       is_anomaly
FROM ({_scored(LEAD_TIMES)})""",
)
twin("anomaly_all_metrics", ("verdicts",), "SELECT * FROM verdicts")
twin(
    "anomaly_summary",
    ("verdicts",),
    f"""SELECT domain, metric, count(*) AS days, {n_if('is_anomaly')} AS anomalies,
       {r(f"{n_if('is_anomaly')} * 100e0 / count(*)", 2)} AS anomaly_pct, max(CASE WHEN is_anomaly THEN date END) AS last_anomaly
FROM verdicts GROUP BY domain, metric""",
)
twin(
    "kpi_period_comparison",
    ("ecommerce", "supply_chain", "financial"),
    f"""SELECT month, {big('orders')} AS orders, {dbl('revenue')} AS revenue, on_time_pct, {dbl('net_income')} AS net_income,
       {dbl('lag(revenue) OVER w')} AS previous_revenue,
       {pct('revenue - lag(revenue) OVER w', 'lag(revenue) OVER w')} AS revenue_change_pct,
       {r('on_time_pct - lag(on_time_pct) OVER w', 2)} AS on_time_change
FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month, sum(total_orders) AS orders,
             sum(CAST(total_revenue AS DECIMAL(25,2))) AS revenue FROM ecommerce GROUP BY 1)
FULL JOIN (SELECT CAST(date_trunc('month', date) AS DATE) AS month,
                  {pct('sum(on_time_deliveries)', 'sum(total_deliveries)')} AS on_time_pct FROM supply_chain GROUP BY 1) USING (month)
FULL JOIN (SELECT CAST(date_trunc('month', date) AS DATE) AS month, sum(CAST(net_income AS DECIMAL(25,2))) AS net_income
           FROM financial GROUP BY 1) USING (month)
WINDOW w AS (ORDER BY month)""",
)
twin(
    "revenue_by_product",
    ("sales", "stg_products"),
    f"""SELECT product_id, {big('sum(order_count)')} AS orders, {big('sum(quantity)')} AS quantity, {dbl('sum(revenue)')} AS revenue,
       {dbl('sum(revenue - sales.cost)')} AS profit, any_value(product_name) AS product_name, any_value(category) AS category
FROM sales JOIN stg_products USING (product_id) GROUP BY product_id""",
)
twin(
    "delivery_performance",
    ("fact_deliveries",),
    f"""SELECT supplier_id, CAST(date_trunc('month', delivery_date) AS DATE) AS month, count(*) AS deliveries,
       {pct('sum(CASE WHEN is_on_time THEN 1 ELSE 0 END)', 'count(is_on_time)')} AS on_time_pct,
       {r('avg(lead_time_days)', 2)} AS average_lead_time_days,
       {pct('sum(quantity_rejected)', 'sum(quantity_delivered)')} AS rejected_pct
FROM fact_deliveries GROUP BY supplier_id, date_trunc('month', delivery_date)""",
)
twin("cash_flow_daily", ("cash_days",), "SELECT * FROM cash_days")
twin(
    "anomaly_seasonal",
    ("ecommerce",),
    f"""SELECT date, value AS residual, {r('mean', 4)} AS expected_residual, {r('z', 6)} AS z_score, is_anomaly
FROM ({_scored(f'''SELECT 'ecommerce' AS domain, 'revenue_residual' AS metric, '' AS entity, date,
  {r('distance - effect', 2)} AS value
  FROM (SELECT date, distance, {ratio('sum(CAST(distance AS DECIMAL(20,6))) OVER (PARTITION BY isodow(date))', 'count(*) OVER (PARTITION BY isodow(date))')} AS effect
        FROM (SELECT date, total_revenue - {ratio('sum(CAST(total_revenue AS DECIMAL(20,2))) OVER w', 'count(*) OVER w')} AS distance
              FROM ecommerce WHERE total_orders > 0 WINDOW w AS (ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
        WHERE distance IS NOT NULL)''')})""",
)
