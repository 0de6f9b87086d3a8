"""Schemas of raw tables, events and mart files. Nothing is inferred from data."""

from __future__ import annotations

#: Raw tables, as given.
RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# --- fixed values: topics, enumerations and event fields -------------------------------------

TOPICS = {
    "orders": "ecommerce.orders",
    "inventory": "ecommerce.inventory",
    "customers": "ecommerce.customers",
    "suppliers": "supply_chain.suppliers",
    "deliveries": "supply_chain.deliveries",
    "purchase_orders": "supply_chain.purchase_orders",
    "transactions": "financials.transactions",
    "budgets": "financials.budgets",
    "actuals": "financials.actuals",
}

#: Field of each event that becomes the message key.
TOPIC_KEYS = {
    "orders": "order_id",
    "inventory": "product_id",
    "customers": "customer_id",
    "suppliers": "supplier_id",
    "deliveries": "delivery_id",
    "purchase_orders": "po_id",
    "transactions": "transaction_id",
    "budgets": "budget_id",
    "actuals": "actual_id",
}

ORDER_STATUS = ("pending", "shipped", "delivered", "cancelled", "returned")
PAYMENT_STATUS = ("pending", "paid", "failed", "refunded")
DELIVERY_STATUS = ("pending", "in_transit", "delivered", "delayed", "cancelled")
TRANSACTION_TYPE = ("journal_entry", "invoice", "payment", "credit_memo", "debit_memo")
CUSTOMER_SEGMENT = ("vip", "regular", "new", "inactive")

EVENTS = {
    "orders": "order_id bigint, customer_id bigint, product_id bigint, supplier_id bigint, order_date timestamp, "
    "quantity int, list_price decimal(12,2), discount_amount decimal(12,2), order_amount decimal(12,2), "
    "tax_amount decimal(12,2), shipping_amount decimal(12,2), total_amount decimal(12,2), "
    "cost_amount decimal(12,2), order_status string, payment_status string, shipping_status string, "
    "created_at timestamp",
    "inventory": "product_id bigint, stock_level int, previous_level int, change_quantity int, "
    "change_reason string, warehouse_id bigint, timestamp timestamp",
    "customers": "customer_id bigint, customer_name string, email string, phone string, segment string, "
    "lifetime_value decimal(15,2), country string, region string, created_at timestamp, updated_at timestamp",
    "suppliers": "supplier_id bigint, supplier_name string, country string, region string, "
    "on_time_delivery_pct double, quality_score double, lead_time_days int, contract_start_date timestamp, "
    "contract_end_date timestamp, is_active boolean, payment_terms string, created_at timestamp, "
    "updated_at timestamp",
    "purchase_orders": "po_id bigint, supplier_id bigint, product_id bigint, quantity int, "
    "unit_cost decimal(12,2), total_cost decimal(12,2), order_date timestamp, expected_delivery_date timestamp, "
    "po_status string, created_at timestamp",
    "deliveries": "delivery_id bigint, po_id bigint, supplier_id bigint, product_id bigint, quantity_ordered int, "
    "quantity_delivered int, quantity_rejected int, unit_cost decimal(12,2), total_cost decimal(12,2), "
    "order_date timestamp, delivery_date timestamp, promised_date timestamp, lead_time_days int, "
    "is_on_time boolean, is_quality_pass boolean, delivery_status string, created_at timestamp",
    "transactions": "transaction_id bigint, gl_account_id string, debit_amount decimal(15,2), "
    "credit_amount decimal(15,2), net_amount decimal(15,2), transaction_type string, description string, "
    "reference_id string, currency_code string, exchange_rate decimal(10,6), is_intercompany boolean, "
    "transaction_date timestamp, created_at timestamp",
    "budgets": "budget_id bigint, gl_account_id string, budget_amount decimal(15,2), budget_type string, "
    "budget_version int, budget_year int, budget_month int, budget_quarter int, created_at timestamp",
    "actuals": "actual_id bigint, gl_account_id string, actual_amount decimal(15,2), transaction_date timestamp, "
    "created_at timestamp",
}

#: Columns of the daily mart files.
MART_FILES = {
    "ecommerce_daily_metrics": "date date, total_orders bigint, total_customers bigint, total_revenue double, "
    "average_order_value double, conversion_rate double, inventory_turnover double",
    "supply_chain_daily_metrics": "date date, total_deliveries bigint, on_time_delivery_pct double, "
    "average_lead_time_days double, supplier_quality_score double",
    "financial_daily_metrics": "date date, total_revenue double, total_expense double, net_income double, "
    "gross_margin_pct double",
}

#: A message as it stands on a topic.
MESSAGE = "key string, value string, topic string"

# --- end of fixed values ---------------------------------------------------------------------
