"""Inputs for the cleaning, ingest and merge queries, in SQL for both engines."""

from __future__ import annotations

from verification.adapters import VIEWS

DIRTY_USERS = """
    SELECT CASE WHEN c_custkey % 9 = 0 THEN 'u-' || CAST(c_custkey AS STRING)
                WHEN c_custkey % 10 = 0 THEN '  00' || CAST(c_custkey AS STRING) || ' '
                WHEN c_custkey % 31 = 0 THEN '99999999999999999999'
                ELSE CAST(c_custkey AS STRING) END AS user_id,
           ' session ' || c_name AS session_id,
           CASE c_custkey % 4 WHEN 0 THEN '   ' WHEN 1 THEN '  mary   ann  ' || c_name
                WHEN 2 THEN c_name ELSE upper(c_name) || '  o''NEIL-smith ' END AS full_name,
           CASE c_custkey % 7
                WHEN 0 THEN '  ' || upper(replace(c_name, '#', '.')) || '@Example.COM '
                WHEN 1 THEN replace(c_name, '#', '.') || '.example.com'
                WHEN 2 THEN replace(c_name, '#', '.') || '@example.c'
                WHEN 3 THEN replace(c_name, '#', '+tag') || '@mail.example.org'
                WHEN 4 THEN replace(c_name, '#', ' ') || '@example.com'
                WHEN 5 THEN '' END AS email,
           CASE c_custkey % 6
                WHEN 0 THEN CAST(10000000 + c_custkey AS STRING)
                WHEN 1 THEN CAST(100000000 + c_custkey AS STRING)
                WHEN 2 THEN '+84 (90) 123-4567'
                WHEN 3 THEN CAST(1000000000000000 + c_custkey AS STRING)
                WHEN 4 THEN CAST(100000000000000 + c_custkey AS STRING) END AS phone,
           c_acctbal AS balance, c_nationkey AS nation_key,
           CASE c_custkey % 5 WHEN 0 THEN ' 2001-02-03 04:05:06 ' WHEN 1 THEN '2001-02-03'
                WHEN 2 THEN 'not a time' WHEN 3 THEN '2001-02-03T04:05:06.5' END AS created_at
    FROM {customer}"""

LINES = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
    FROM {lineitem}"""

# Every order is in the base, in the incoming rows, or in both.
BASE_ORDERS = f"""
    SELECT order_id, user_id, total_amount, status, updated_at
    FROM ({VIEWS['c_orders']}) AS o WHERE order_date < CAST('1999-01-01' AS TIMESTAMP) OR order_id % 3 <> 0"""

INCOMING_ORDERS = f"""
    SELECT order_id, user_id, total_amount, 'Refunded' AS status, updated_at
    FROM ({VIEWS['c_orders']}) AS o WHERE order_id % 3 = 0
    UNION ALL
    SELECT order_id, user_id, total_amount, 'Cancelled' AS status,
           updated_at + INTERVAL '1' DAY AS updated_at
    FROM ({VIEWS['c_orders']}) AS o WHERE order_id % 6 = 0"""

# Three loads of orders: late ones and refunds in the second; in the third corrected ones and versions older than those known.
ORDER_LOADS = f"""
    SELECT 1 AS load, order_id, user_id, order_date, total_amount, status, updated_at
    FROM ({VIEWS['c_orders']}) AS o WHERE order_id % 5 <> 0
    UNION ALL
    SELECT 2 AS load, order_id, user_id, order_date, total_amount, status, updated_at
    FROM ({VIEWS['c_orders']}) AS o WHERE order_id % 5 = 0
    UNION ALL
    SELECT 2 AS load, order_id, user_id, order_date, total_amount, 'Refunded' AS status,
           updated_at + INTERVAL '1' DAY AS updated_at
    FROM ({VIEWS['c_orders']}) AS o WHERE order_id % 7 = 0
    UNION ALL
    SELECT 3 AS load, order_id, CASE WHEN order_id % 3 = 0 THEN user_id ELSE user_id + 1 END AS user_id,
           order_date + INTERVAL '3' DAY AS order_date, total_amount + 5 AS total_amount, 'Paid' AS status,
           updated_at + INTERVAL '2' DAY AS updated_at
    FROM ({VIEWS['c_orders']}) AS o WHERE order_id % 11 = 0
    UNION ALL
    SELECT 3 AS load, order_id, user_id, order_date, total_amount, 'Cancelled' AS status,
           updated_at - INTERVAL '1' DAY AS updated_at
    FROM ({VIEWS['c_orders']}) AS o WHERE order_id % 13 = 0"""

CLICK_ROWS = """
    SELECT event_id, CAST(user_id AS INT) AS user_id,
           'session-' || CAST(event_id % 1000 AS STRING) AS session_id, event_type,
           CAST(event_id % 2100 AS INT) AS product_id,
           CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 27 AS INT) END AS category_id,
           CASE WHEN event_id % 11 <> 0 THEN CAST(1 + event_id % 9 AS INT) END AS channel_id,
           CASE WHEN event_id % 50 = 0 THEN 'some day' ELSE CAST(ts AS STRING) END AS event_time,
           'https://shop.example/?p=' || CAST(event_id % 2100 AS STRING) || ',' || event_type AS page_url,
           CASE WHEN event_id % 5 <> 0 THEN 'https://referrer.example/' END AS referrer_url,
           'campaign "' || CAST(event_id % 3 AS STRING) || '"' AS campaign_name,
           CASE event_id % 2 WHEN 0 THEN 'desktop' ELSE 'mobile' END AS device_type,
           'browser-' || CAST(event_id % 4 AS STRING) AS browser,
           'os-' || CAST(event_id % 5 AS STRING) AS os, 'country' AS country, 'city' AS city,
           value AS price, value / 4 AS discount,
           CASE event_id % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'TRUE' END AS is_returning,
           CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN '2024-02-01 00:00:00' WHEN 2 THEN 'NULL' END AS is_read
    FROM {events}"""

# References as text: some point at no user, some are no number at all, and others are written with blanks.
TEXT_KEY_ORDERS = f"""
    SELECT order_id,
           CASE WHEN order_id % 50 = 1 THEN 'u-' || CAST(user_id AS STRING)
                WHEN order_id % 50 = 2 THEN CAST(-user_id AS STRING)
                WHEN order_id % 50 = 3 THEN ' ' || CAST(user_id AS STRING)
                ELSE CAST(user_id AS STRING) END AS user_id
    FROM ({VIEWS['c_orders']}) AS o"""

TEXT_KEY_USERS = f"""
    SELECT CAST(user_id AS STRING) AS user_id FROM ({VIEWS['c_users']}) AS u"""

# Whole rows, most of them twice or more.
REPEATED_LINES = """
    SELECT l_orderkey, l_returnflag, l_linestatus, CAST(l_linenumber % 2 AS BIGINT) AS parity FROM {lineitem}"""
