"""The test tables as commerce tables.

Each text is run by Spark and by the SQL checker alike; ``{name}`` stands for a
test table. What the test tables lack is derived from their keys.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {
    "c_users": """
        SELECT c_custkey AS user_id, c_name AS full_name,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               CAST(84900000000 + c_custkey AS STRING) AS phone,
               'city-' || CAST(c_custkey % 50 AS STRING) AS city,
               'state-' || CAST(c_custkey % 7 AS STRING) AS state,
               n_name AS country,
               CASE c_custkey % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' END AS gender,
               CAST('1960-01-01' AS DATE) + CAST(c_custkey % 15000 AS INT) AS date_of_birth,
               c_mktsegment AS loyalty_segment,
               CASE c_custkey % 2 WHEN 0 THEN 'web' ELSE 'app' END AS registration_source,
               c_custkey % 5 <> 0 AS is_active,
               CAST(CAST('1994-01-01' AS DATE) + CAST(c_custkey % 365 AS INT) AS TIMESTAMP) AS created_at,
               CAST(CAST('1995-01-01' AS DATE) + CAST(c_custkey % 365 AS INT) AS TIMESTAMP) AS updated_at
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "c_categories": """
        SELECT n_nationkey AS category_id, n_name AS category_name, n_regionkey AS parent_id,
               CAST('1995-01-01' AS TIMESTAMP) AS created_at,
               CAST('1995-01-01' AS TIMESTAMP) AS updated_at
        FROM {nation}""",
    "c_products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               'SKU-' || CAST(p_partkey AS STRING) AS sku,
               CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(p_partkey % 27 AS INT) END AS category_id,
               p_brand AS brand, CAST(p_retailprice AS DECIMAL(15,2)) AS base_price,
               CASE WHEN p_partkey % 23 <> 0 THEN CAST(p_size * 10 AS DECIMAL(15,2)) END AS cost_price,
               CASE p_partkey % 4 WHEN 0 THEN 'inactive' WHEN 1 THEN 'discontinued' ELSE 'active' END AS status,
               CAST(CAST('1994-06-01' AS DATE) + CAST(p_partkey % 365 AS INT) AS TIMESTAMP) AS created_at,
               CAST(CAST('1995-06-01' AS DATE) + CAST(p_partkey % 365 AS INT) AS TIMESTAMP) AS updated_at
        FROM {part}""",
    "c_orders": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS user_id,
               o_orderdate AS order_date, CAST(o_totalprice AS DECIMAL(15,2)) AS total_amount,
               CAST(o_totalprice AS DECIMAL(15,2)) - CAST(o_orderkey % 37 AS DECIMAL(15,2)) AS subtotal_amount,
               CAST(o_orderkey % 37 AS DECIMAL(15,2)) AS tax_amount,
               CAST(o_orderkey % 11 AS DECIMAL(10,2)) AS shipping_fee,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS DECIMAL(15,2)) END
                   AS discount_amount,
               CASE o_orderstatus WHEN 'F' THEN 'Shipped' WHEN 'O' THEN 'Paid' ELSE 'Pending' END AS status,
               CASE o_orderkey % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'transfer' ELSE 'cash' END AS payment_method,
               CASE o_orderstatus WHEN 'P' THEN 'unpaid' ELSE 'paid' END AS payment_status,
               o_orderpriority AS source_channel,
               CASE o_orderkey % 2 WHEN 0 THEN 'desktop' ELSE 'mobile' END AS device_type,
               o_orderdate AS created_at, o_orderdate AS updated_at
        FROM {orders}""",
    "c_order_items": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
               l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
               CAST(900 + l_partkey % 1000 AS DECIMAL(15,2)) AS unit_price,
               CAST(CAST(l_discount AS DECIMAL(5,2)) * 10 AS DECIMAL(15,2)) AS discount_amount,
               CAST(CAST(l_tax AS DECIMAL(5,2)) * 10 AS DECIMAL(15,2)) AS tax_amount,
               CAST(l_extendedprice AS DECIMAL(15,2)) AS line_total,
               l_suppkey AS supplier_key, l_shipdate AS created_at, l_shipdate AS updated_at
        FROM {lineitem}""",
    "c_order_promotions": """
        SELECT l_orderkey AS order_id,
               CASE WHEN l_orderkey % 41 = 0 THEN 99 ELSE CAST(round(l_discount * 100) AS INT) END AS promo_id,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(5,2)))
                    AS DECIMAL(15,2)) AS applied_amount,
               min(l_shipdate) AS created_at, max(l_shipdate) AS updated_at
        FROM {lineitem} WHERE l_discount > 0
        GROUP BY l_orderkey, CASE WHEN l_orderkey % 41 = 0 THEN 99 ELSE CAST(round(l_discount * 100) AS INT) END""",
    "c_promotions": """
        SELECT promo_id, 'PROMO' || CAST(promo_id AS STRING) AS promo_code,
               CASE WHEN promo_id % 4 <> 0 THEN CAST(promo_id AS DECIMAL(5,2)) END AS discount_percent,
               CASE WHEN promo_id % 4 <> 0 THEN 'percentage' ELSE 'fixed_amount' END AS discount_type,
               CAST(first_used AS DATE) AS start_date, CAST(last_used AS DATE) AS end_date,
               CAST(promo_id * 50 AS DECIMAL(15,2)) AS min_order_value,
               CAST(promo_id * 500 AS DECIMAL(15,2)) AS max_discount_amount,
               'campaign-' || CAST(promo_id % 3 AS STRING) AS campaign_name,
               first_used AS created_at, last_used AS updated_at
        FROM (SELECT CAST(round(l_discount * 100) AS INT) AS promo_id,
                     min(l_shipdate) AS first_used, max(l_shipdate) AS last_used
              FROM {lineitem} WHERE l_discount > 0
              GROUP BY CAST(round(l_discount * 100) AS INT)) AS used""",
    "c_warehouses": """
        SELECT s_suppkey AS warehouse_id, s_name AS warehouse_name,
               CAST('1995-01-01' AS TIMESTAMP) AS updated_at
        FROM {supplier}""",
    "c_inventory": """
        SELECT product_id * 1000000 + warehouse_id AS inventory_id, product_id, warehouse_id,
               CAST((7 * product_id + 13 * warehouse_id) % 500 AS INT) AS stock_on_hand,
               CASE WHEN product_id % 17 <> 0 THEN CAST((product_id + warehouse_id) % 50 AS INT) END
                   AS reserved_quantity,
               CAST(10 + (3 * product_id + warehouse_id) % 41 AS INT) AS reorder_level,
               last_moved AS updated_at
        FROM (SELECT l_partkey AS product_id, l_suppkey AS warehouse_id, max(l_shipdate) AS last_moved
              FROM {lineitem}
              GROUP BY l_partkey, l_suppkey) AS stocked""",
    "c_marketing_channels": """
        SELECT channel_id, 'channel-' || CAST(channel_id AS STRING) AS channel_name,
               CASE channel_id % 3 WHEN 0 THEN 'Paid' WHEN 1 THEN 'Organic' ELSE 'Referral' END AS channel_type,
               'platform-' || CAST(channel_id % 4 AS STRING) AS platform,
               'source-' || CAST(channel_id AS STRING) AS utm_source,
               CASE channel_id % 2 WHEN 0 THEN 'cpc' ELSE 'email' END AS utm_medium,
               first_seen AS updated_at
        FROM (SELECT 1 + event_id % 10 AS channel_id, min(ts) AS first_seen
              FROM {events} GROUP BY 1 + event_id % 10) AS seen""",
    "c_clickstream": """
        SELECT event_id, user_id, 'session-' || CAST(event_id % 1000 AS STRING) AS session_id,
               CASE event_type WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type,
               event_id % 2100 AS product_id,
               CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 27 AS INT) END AS category_id,
               CASE WHEN event_id % 31 = 0 THEN 77 WHEN event_id % 11 <> 0 THEN 1 + event_id % 9 END AS channel_id,
               ts AS event_time, value AS price
        FROM {events}""",
}


def tables_of(text: str) -> list[str]:
    """The test tables a text reads."""
    return list(dict.fromkeys(name for _, name, _, _ in string.Formatter().parse(text) if name))


def run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A text on the test tables, in Spark."""
    frames = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in tables_of(text)}
    return spark.sql(text, **frames)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return run(spark, sf_dir, VIEWS[name])


def as_sql(text: str) -> str:
    """A text on the test tables, for the SQL checker, which knows them by name."""
    return text.format(**{name: name for name in tables_of(text)})
