"""Plain SQL for every query, written apart from the library."""

from __future__ import annotations

from cartwheel.model import FOREIGN_KEYS, PRIMARY_KEYS
from verification import inputs
from verification.adapters import VIEWS, as_sql

AS_OF = "DATE '2001-08-01'"
SETTLED = "('Paid', 'Shipped')"


def half_up(value: str, digits: int) -> str:
    """Round a double half up on its printed digits, as Spark does."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def oracle(columns: str, body: str, **ctes: str) -> str:
    """``body`` over the commerce tables it names, with its columns cast.

    ``columns`` lists ``name:type``; a bare name keeps its type.
    """
    texts = {name: as_sql(text) for name, text in {**VIEWS, **ctes}.items() if name in body}
    withs = ",\n".join(f"{name} AS ({text})" for name, text in texts.items())
    picks = []
    for column in columns.split():
        name, _, kind = column.partition(":")
        picks.append(f"CAST({name} AS {kind.upper()}) AS {name}" if kind else name)
    head = f"WITH {withs}\n" if withs else ""
    return f"{head}SELECT {', '.join(picks)} FROM ({body}) AS result"


ORDERS = (
    "order_id:bigint user_id:bigint order_date total_amount:double subtotal_amount:double tax_amount:double "
    "shipping_fee:double discount_amount:double status payment_method payment_status source_channel "
    "device_type created_at updated_at"
)
LINES = (
    "l_orderkey:bigint l_linenumber:bigint l_partkey:bigint l_suppkey:bigint l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate _ingestion_ts _ingestion_date"
)


def latest_lines(first_stamp: str, second_stamp: str) -> str:
    return f"""
        SELECT * EXCLUDE (place),
               CAST(CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN '{first_stamp}'
                         ELSE '{second_stamp}' END AS TIMESTAMP) AS _ingestion_ts,
               CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN '{first_stamp[:10]}'
                    ELSE '{second_stamp[:10]}' END AS _ingestion_date
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                           l_extendedprice DESC, l_discount DESC, l_tax DESC,
                           l_returnflag DESC, l_linestatus DESC) AS place
              FROM lines) AS ranked
        WHERE place = 1"""


SILVER_DEDUP = oracle(
    LINES, latest_lines("2001-08-03 00:00:00.000002", "2001-08-03 00:00:00.000002"), lines=inputs.LINES
)


def funnel() -> str:
    def rate(part: str, whole: str) -> str:
        return f"CASE WHEN {whole} > 0 THEN {half_up(f'{part} / {whole} * 100', 2)} ELSE 0 END"

    body = f"""
        SELECT f.category_id, category_name, views, add_to_carts, purchases, unique_viewers, unique_purchasers,
               {rate('add_to_carts', 'views')} AS view_to_cart_rate,
               {rate('purchases', 'add_to_carts')} AS cart_to_purchase_rate,
               {rate('purchases', 'views')} AS overall_conversion_rate
        FROM (SELECT category_id,
                     count(*) FILTER (event_type = 'view') AS views,
                     count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
                     count(*) FILTER (event_type = 'purchase') AS purchases,
                     count(DISTINCT user_id) FILTER (event_type = 'view') AS unique_viewers,
                     count(DISTINCT user_id) FILTER (event_type = 'purchase') AS unique_purchasers
              FROM c_clickstream GROUP BY category_id) AS f
        LEFT JOIN c_categories AS c ON c.category_id = f.category_id"""
    return oracle(
        "category_id:bigint category_name views:bigint add_to_carts:bigint purchases:bigint "
        "unique_viewers:bigint unique_purchasers:bigint view_to_cart_rate:double "
        "cart_to_purchase_rate:double overall_conversion_rate:double",
        body,
    )


def rfm(recency: list[int], frequency: list[int], monetary: list[int], **tables: str) -> str:
    def score(value: str, sign: str, bounds: list[int]) -> str:
        whens = " ".join(f"WHEN {value} {sign} {bound} THEN {5 - i}" for i, bound in enumerate(bounds))
        return f"CASE {whens} ELSE 1 END"

    body = f"""
        SELECT s.user_id, full_name, email, loyalty_segment, recency_days, frequency, monetary,
               r_score, f_score, m_score, rfm_score,
               CASE WHEN rfm_score >= 13 THEN 'VIP' WHEN rfm_score >= 10 THEN 'Loyal'
                    WHEN rfm_score >= 7 THEN 'Potential'
                    WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
                    WHEN r_score <= 2 THEN 'Churn Risk' ELSE 'New/Casual' END AS customer_segment,
               first_order_date, last_order_date
        FROM (SELECT *, r_score + f_score + m_score AS rfm_score
              FROM (SELECT *, {score('recency_days', '<=', recency)} AS r_score,
                           {score('frequency', '>=', frequency)} AS f_score,
                           {score('monetary', '>=', monetary)} AS m_score
                    FROM (SELECT user_id, {AS_OF} - CAST(max(order_date) AS DATE) AS recency_days,
                                 count(order_id) AS frequency, sum(total_amount) AS monetary,
                                 min(order_date) AS first_order_date, max(order_date) AS last_order_date
                          FROM c_orders WHERE status IN {SETTLED} GROUP BY user_id) AS spent) AS scored) AS s
        LEFT JOIN c_users AS u ON u.user_id = s.user_id"""
    return oracle(
        "user_id:bigint full_name email loyalty_segment recency_days:bigint frequency:bigint monetary:double "
        "r_score:bigint f_score:bigint m_score:bigint rfm_score:bigint customer_segment "
        "first_order_date last_order_date",
        body,
        **tables,
    )


LATEST_ORDERS = f"""
    SELECT * EXCLUDE (load, place)
    FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) AS place
          FROM ({inputs.ORDER_LOADS}) AS loads) AS ranked
    WHERE place = 1"""


def _mean(amount: str) -> str:
    # The mean of a DECIMAL(15,2) has six digits; rounded half up on whole numbers.
    cents = f"CAST(sum(CAST({amount} * 100 AS HUGEINT)) AS HUGEINT)"
    return f"((20000 * {cents} + count({amount})) // (2 * count({amount}))) / 1000000.0"


def promo_comparison(per_order: bool) -> str:
    promos = "(SELECT DISTINCT order_id, 1 AS promo_id FROM c_order_promotions)" if per_order else "c_order_promotions"
    body = f"""
        SELECT promo_id IS NOT NULL AS has_promotion, count(o.order_id) AS num_orders,
               sum(total_amount) AS total_revenue, {_mean('total_amount')} AS avg_order_value,
               sum(discount_amount) AS total_discount, {_mean('discount_amount')} AS avg_discount
        FROM c_orders AS o LEFT JOIN {promos} AS p ON p.order_id = o.order_id
        GROUP BY promo_id IS NOT NULL"""
    return oracle(
        "has_promotion num_orders:bigint total_revenue:double avg_order_value:double "
        "total_discount:double avg_discount:double",
        body,
    )


PROMO_DETAIL = oracle(
    "promo_id:bigint promo_code discount_percent:double campaign_name times_used:bigint total_revenue:double "
    "avg_order_value:double total_discount_given:double revenue_per_discount:double",
    f"""
        SELECT *, CASE WHEN total_discount_given > 0 THEN
                  (CAST(200 * total_revenue * 100 AS HUGEINT) + CAST(total_discount_given * 100 AS HUGEINT))
                  // (2 * CAST(total_discount_given * 100 AS HUGEINT)) / 100.0 END AS revenue_per_discount
        FROM (SELECT p.promo_id, promo_code, discount_percent, campaign_name, count(o.order_id) AS times_used,
                     sum(total_amount) AS total_revenue, {_mean('total_amount')} AS avg_order_value,
                     sum(applied_amount) AS total_discount_given
              FROM c_orders AS o JOIN c_order_promotions AS p ON p.order_id = o.order_id
              LEFT JOIN c_promotions AS d ON d.promo_id = p.promo_id
              GROUP BY p.promo_id, promo_code, discount_percent, campaign_name) AS detail""",
)

INVENTORY = oracle(
    "product_id:bigint product_name sku status total_stock:bigint available_stock:bigint avg_reorder_level:double "
    "qty_sold_90d:bigint qty_sold_365d:bigint daily_sales_rate:double days_of_stock:double dsi:double inventory_status",
    f"""
        SELECT *, CASE WHEN daily_sales_rate > 0
                       THEN {half_up('available_stock / daily_sales_rate', 0)} END AS days_of_stock,
               CASE WHEN available_stock <= 0 THEN 'Out of Stock'
                    WHEN available_stock < avg_reorder_level THEN 'Low Stock'
                    WHEN dsi > 180 THEN 'Slow Moving' WHEN dsi > 90 THEN 'Moderate'
                    ELSE 'Healthy' END AS inventory_status
        FROM (SELECT *, {half_up('qty_sold_90d / 90', 2)} AS daily_sales_rate,
                     -- the ratio has six digits before it is scaled to a year and cut to one
                     CASE WHEN cogs > 0 THEN CAST(round(CAST(
                         (2000000 * value + cogs) // (2 * cogs) AS DECIMAL(30,0)) * 0.000001 * 365, 1) AS DOUBLE)
                     END AS dsi
              FROM (SELECT p.product_id, product_name, sku, p.status, avg_reorder_level,
                           coalesce(on_hand, 0) AS total_stock,
                           coalesce(on_hand, 0) - coalesce(reserved, 0) AS available_stock,
                           coalesce(sold_90, 0) AS qty_sold_90d, coalesce(sold_365, 0) AS qty_sold_365d,
                           CAST(coalesce(on_hand, 0) * cost_price * 100 AS HUGEINT) AS value,
                           CAST(coalesce(sold_365, 0) * coalesce(cost_price, 0) * 100 AS HUGEINT) AS cogs
                    FROM c_products AS p
                    LEFT JOIN (SELECT product_id, sum(stock_on_hand) AS on_hand, sum(reserved_quantity) AS reserved,
                                      avg(reorder_level) AS avg_reorder_level
                               FROM c_inventory GROUP BY product_id) AS i ON i.product_id = p.product_id
                    LEFT JOIN (SELECT product_id, sum(quantity) AS sold_90
                               FROM c_order_items AS l JOIN c_orders AS o ON o.order_id = l.order_id
                               WHERE status IN {SETTLED} AND order_date >= {AS_OF} - 90
                               GROUP BY product_id) AS s90 ON s90.product_id = p.product_id
                    LEFT JOIN (SELECT product_id, sum(quantity) AS sold_365
                               FROM c_order_items AS l JOIN c_orders AS o ON o.order_id = l.order_id
                               WHERE status IN {SETTLED} AND order_date >= {AS_OF} - 365
                               GROUP BY product_id) AS s365 ON s365.product_id = p.product_id
                   ) AS joined) AS rated""",
)


def attribution(lookback_days: int) -> str:
    body = f"""
        SELECT c.channel_id, channel_name, channel_type,
               coalesce(first_touch_conversions, 0) AS first_touch_conversions,
               coalesce(last_touch_conversions, 0) AS last_touch_conversions,
               coalesce({half_up('linear_credit', 2)}, 0) AS linear_conversions
        FROM c_marketing_channels AS c
        LEFT JOIN (SELECT channel_id, count(*) FILTER (from_first = 1) AS first_touch_conversions,
                          count(*) FILTER (from_last = 1) AS last_touch_conversions,
                          sum(1.0 / touches) AS linear_credit
                   FROM (SELECT channel_id,
                                row_number() OVER (PARTITION BY t.user_id, bought ORDER BY event_time, event_id)
                                    AS from_first,
                                row_number() OVER (PARTITION BY t.user_id, bought
                                                   ORDER BY event_time DESC, event_id DESC) AS from_last,
                                CAST(count(*) OVER (PARTITION BY t.user_id, bought) AS DOUBLE) AS touches
                         FROM c_clickstream AS t
                         JOIN (SELECT DISTINCT user_id, event_time AS bought
                               FROM c_clickstream WHERE event_type = 'purchase') AS p
                           ON p.user_id = t.user_id AND event_time < bought
                              AND event_time >= CAST(bought AS DATE) - {lookback_days}
                         WHERE event_type IN ('view', 'add_to_cart')) AS pairs
                   GROUP BY channel_id) AS earned ON earned.channel_id = c.channel_id"""
    return oracle(
        "channel_id:bigint channel_name channel_type first_touch_conversions:bigint "
        "last_touch_conversions:bigint linear_conversions:double",
        body,
    )


CLEAN_EMAIL = r"regexp_full_match(lower(trim(email)), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')"
CLEAN_PHONE = "regexp_replace(trim(phone), '[^0-9]', '', 'g')"
WORDS = r"string_split(lower(regexp_replace(trim(full_name), '\s+', ' ', 'g')), ' ')"

SILVER_CLEAN = oracle(
    "user_id:bigint session_id full_name email phone balance nation_key:bigint created_at",
    f"""
        SELECT CASE WHEN regexp_full_match(trim(user_id), '[0-9]+') THEN TRY_CAST(trim(user_id) AS BIGINT) END
                   AS user_id,
               nullif(trim(session_id), '') AS session_id,
               nullif(array_to_string(list_transform({WORDS}, lambda w: upper(w[1]) || w[2:]), ' '), '') AS full_name,
               CASE WHEN {CLEAN_EMAIL} THEN lower(trim(email)) END AS email,
               CASE WHEN length({CLEAN_PHONE}) BETWEEN 9 AND 15 THEN {CLEAN_PHONE} END AS phone,
               balance, nation_key, TRY_CAST(trim(created_at) AS TIMESTAMP) AS created_at
        FROM dirty_users""",
    dirty_users=inputs.DIRTY_USERS,
)

EMAIL_PHONE_QUALITY = oracle(
    "column_name total_rows:bigint missing:bigint valid:bigint invalid:bigint",
    f"""
        SELECT 'email' AS column_name, count(*) AS total_rows,
               count(*) FILTER (email IS NULL OR trim(email) = '') AS missing,
               count(*) FILTER ({CLEAN_EMAIL}) AS valid,
               count(*) FILTER (trim(email) <> '' AND NOT {CLEAN_EMAIL}) AS invalid
        FROM dirty_users
        UNION ALL
        SELECT 'phone', count(*), count(*) FILTER (phone IS NULL OR trim(phone) = ''),
               count(*) FILTER (length({CLEAN_PHONE}) BETWEEN 9 AND 15),
               count(*) FILTER (trim(phone) <> '' AND length({CLEAN_PHONE}) NOT BETWEEN 9 AND 15)
        FROM dirty_users""",
    dirty_users=inputs.DIRTY_USERS,
)

MERGE_INPUTS = {"base_orders": inputs.BASE_ORDERS, "incoming_orders": inputs.INCOMING_ORDERS}
MERGED = "order_id:bigint user_id:bigint total_amount:double status updated_at"
FRESH = """(SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC)
            AS place FROM incoming_orders) AS ranked WHERE place = 1)"""

UPSERT = oracle(
    MERGED,
    f"""
        SELECT * FROM base_orders WHERE order_id NOT IN (SELECT order_id FROM incoming_orders)
        UNION ALL SELECT * FROM {FRESH} AS fresh""",
    **MERGE_INPUTS,
)
INSERT = oracle(
    MERGED,
    f"""
        SELECT * FROM base_orders
        UNION ALL SELECT * FROM {FRESH} AS fresh WHERE order_id NOT IN (SELECT order_id FROM base_orders)""",
    **MERGE_INPUTS,
)


def fk_report() -> str:
    parts = [
        f"""SELECT '{fk.name}' AS "constraint", '{fk.parent}' AS parent_table, count(*) AS violations,
                   count(DISTINCT {fk.column}) AS missing_keys
            FROM c_{fk.child} WHERE {fk.column} IS NOT NULL
              AND {fk.column} NOT IN (SELECT {fk.parent_column} FROM c_{fk.parent})"""
        for fk in FOREIGN_KEYS
    ]
    return oracle('"constraint" parent_table violations:bigint missing_keys:bigint', " UNION ALL ".join(parts))


def key_report() -> str:
    checks = [(table, "primary key", key) for table, key in PRIMARY_KEYS.items()]
    checks.append(("users", "unique", ("email",)))
    parts = []
    for table, kind, key in checks:
        complete = " AND ".join(f"{column} IS NOT NULL" for column in key)
        parts.append(
            f"""SELECT '{table}' AS table_name, '{kind}' AS kind, '{','.join(key)}' AS key_columns,
                       (SELECT count(*) FROM c_{table} WHERE NOT ({complete})) AS null_rows,
                       (SELECT count(*) FROM (SELECT 1 FROM c_{table} WHERE {complete}
                           GROUP BY {', '.join(key)} HAVING count(*) > 1) AS r) AS repeated_keys,
                       (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM c_{table} WHERE {complete}
                           GROUP BY {', '.join(key)}) AS r) AS excess_rows"""
        )
    for table, column in (("categories", "category_name"), ("products", "product_name")):
        parts.append(
            f"""SELECT '{table}', 'not null', '{column}', count(*) FILTER ({column} IS NULL), 0, 0 FROM c_{table}"""
        )
    return oracle(
        "table_name kind key_columns null_rows:bigint repeated_keys:bigint excess_rows:bigint",
        " UNION ALL ".join(parts),
    )


def pipeline() -> str:
    unread = "(is_read IS NULL OR trim(is_read) = '' OR lower(is_read) = 'null')"
    raw = {table: f"c_{table}" for table in PRIMARY_KEYS}
    raw["clickstream"] = f"(SELECT * FROM click_rows WHERE {unread})"

    def trusted(table: str) -> str:
        return f"SELECT DISTINCT {', '.join(PRIMARY_KEYS[table])} FROM {raw[table]}"

    counts = {("bronze", table): f"SELECT count(*) FROM {rows}" for table, rows in raw.items()}
    counts |= {("silver", table): f"SELECT count(*) FROM ({trusted(table)})" for table in raw}
    for name in ("users", "products", "promotions", "marketing_channels"):
        counts["gold", f"dim_{name}"] = f"SELECT count(*) FROM ({trusted(name)})"
    counts["gold", "fact_orders"] = "SELECT count(*) FROM c_orders"
    counts["gold", "fact_order_items"] = f"SELECT count(*) FROM ({trusted('order_items')})"
    counts["gold", "gold_q1_conversion_funnel"] = (
        f"SELECT count(*) FROM (SELECT DISTINCT category_id FROM {raw['clickstream']})"
    )
    counts["gold", "gold_q2_rfm_segmentation"] = (
        f"SELECT count(*) FROM (SELECT DISTINCT user_id FROM c_orders WHERE status IN {SETTLED})"
    )
    counts["gold", "gold_q3_promo_comparison"] = (
        "SELECT count(DISTINCT p.order_id IS NULL) FROM c_orders AS o "
        "LEFT JOIN c_order_promotions AS p ON p.order_id = o.order_id"
    )
    counts["gold", "gold_q3_promo_detail"] = "SELECT count(DISTINCT promo_id) FROM c_order_promotions"
    counts["gold", "gold_q4_inventory_analysis"] = "SELECT count(*) FROM c_products"
    counts["gold", "gold_q5_attribution"] = "SELECT count(*) FROM c_marketing_channels"
    rows = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, '*' AS column_name, ({count}) AS filled, "
        "0 AS total, 0 AS letters"
        for (layer, table), count in counts.items()
    )
    totals = [_column_totals(name, text) for name, text in _curated().items()]
    body = oracle("layer table_name column_name filled:bigint total:double letters:bigint", rows, click_rows=inputs.CLICK_ROWS)
    return " UNION ALL ".join([f"SELECT * FROM ({body})", *totals])


def _column_totals(table: str, text: str) -> str:
    """Filled values, sum of the numbers and sum over the digests of other values, for each column of a result."""
    return f"""
        SELECT 'gold' AS layer, '{table}' AS table_name, column_name, count(value) AS filled,
               CAST(coalesce(sum(CAST(round(TRY_CAST(value AS DOUBLE) * 10000) AS BIGINT)), 0) AS DOUBLE) / 10000 AS total,
               CAST(coalesce(sum(CAST('0x' || substr(md5(value), 1, 8) AS BIGINT))
                    FILTER (TRY_CAST(value AS DOUBLE) IS NULL), 0) AS BIGINT) AS letters
        FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({text}))
             UNPIVOT INCLUDE NULLS (value FOR column_name IN (COLUMNS(*)))
        GROUP BY column_name"""


# What the trusted layer holds in place of the tables of the direct queries: ingested clicks, one row per order line.
TRUSTED_VIEWS = {
    "c_clickstream": f"""
        SELECT event_id, CAST(user_id AS BIGINT) AS user_id, event_type, category_id, channel_id,
               TRY_CAST(event_time AS TIMESTAMP) AS event_time
        FROM ({inputs.CLICK_ROWS}) AS click_rows
        WHERE is_read IS NULL OR trim(is_read) = '' OR lower(is_read) = 'null'""",
    "c_order_items": f"""
        SELECT * EXCLUDE (place)
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY order_item_id
                  ORDER BY updated_at DESC, order_id DESC, product_id DESC, quantity DESC, unit_price DESC,
                           discount_amount DESC, tax_amount DESC, line_total DESC, supplier_key DESC) AS place
              FROM ({VIEWS['c_order_items']}) AS lines) AS ranked
        WHERE place = 1""",
}


def _curated() -> dict[str, str]:
    """The curated tables as direct queries on what the trusted layer holds."""
    marts = (
        "q1_conversion_funnel", "q2_rfm_segmentation", "q3_promo_comparison", "q3_promo_detail",
        "q4_inventory_analysis", "q5_attribution",
    )
    plain = ("dim_users", "dim_products", "dim_promotions", "dim_marketing_channels", "fact_orders", "fact_order_items")
    tables = {name: ORACLES[name] for name in plain} | {f"gold_{name}": ORACLES[name] for name in marts}
    for view, text in TRUSTED_VIEWS.items():
        tables = {name: sql.replace(as_sql(VIEWS[view]), as_sql(text)) for name, sql in tables.items()}
    return tables


CLICKS = oracle(
    "event_id:bigint user_id:bigint session_id event_type product_id:bigint category_id:bigint "
    "channel_id:bigint event_time page_url referrer_url campaign_name device_type browser os country city "
    "price discount is_returning is_read",
    """SELECT * REPLACE (TRY_CAST(event_time AS TIMESTAMP) AS event_time,
                         coalesce(lower(is_returning) = 'true', false) AS is_returning)
       FROM click_rows WHERE is_read IS NULL OR lower(is_read) = 'null'""",
    click_rows=inputs.CLICK_ROWS,
)

ORACLES: dict[str, str] = {
    "user_transactions": oracle(
        "region user_id:bigint name transaction_count:bigint total_amount:double avg_amount:double",
        f"""
            SELECT country AS region, u.user_id, full_name AS name, count(order_id) AS transaction_count,
                   sum(total_amount) AS total_amount, {_mean('total_amount')} AS avg_amount
            FROM c_users AS u JOIN c_orders AS o ON o.user_id = u.user_id
            GROUP BY country, u.user_id, full_name""",
    ),
    "bronze_incremental": oracle(
        ORDERS + " _ingestion_ts",
        """SELECT *, TIMESTAMP '2001-08-02 00:00:00.000001' AS _ingestion_ts
           FROM c_orders WHERE updated_at > TIMESTAMP '2000-01-01 00:00:00'""",
    ),
    "clickstream_ingest": CLICKS,
    "bronze_incremental_overlap": oracle(ORDERS, "SELECT * FROM c_orders"),
    "raw_refresh": oracle("warehouse_id:bigint warehouse_name updated_at", "SELECT * FROM c_warehouses"),
    "clickstream_batch": CLICKS,
    "clickstream_continuous": oracle(
        "batch_rows:bigint", "SELECT count(*) AS batch_rows FROM click_rows GROUP BY event_id % 3", click_rows=inputs.CLICK_ROWS
    ),
    "transactions_csv": oracle(
        "region user_id:bigint name transaction_count:bigint total_amount:double avg_amount:double row_count:bigint",
        f"""
            SELECT country AS region, u.user_id, full_name AS name, count(order_id) AS transaction_count,
                   sum(total_amount) AS total_amount, {half_up('sum(total_amount) / count(total_amount)', 2)} AS avg_amount,
                   count(*) OVER () AS row_count
            FROM c_users AS u JOIN c_orders AS o ON o.user_id = u.user_id
            GROUP BY country, u.user_id, full_name""",
    ),
    "silver_distinct_rows": oracle(
        "l_orderkey:bigint l_returnflag l_linestatus parity:bigint", "SELECT DISTINCT * FROM lines", lines=inputs.REPEATED_LINES
    ),
    "fk_violations_text_keys": oracle(
        '"constraint" parent_table violations:bigint missing_keys:bigint',
        """SELECT 'orders.user_id' AS "constraint", 'users' AS parent_table, count(*) AS violations,
                  count(DISTINCT trim(user_id)) AS missing_keys
           FROM text_orders WHERE user_id IS NOT NULL AND trim(user_id) NOT IN (SELECT user_id FROM text_users)""",
        text_orders=inputs.TEXT_KEY_ORDERS,
        text_users=inputs.TEXT_KEY_USERS,
    ),
    "silver_clean": SILVER_CLEAN,
    "silver_dedup": SILVER_DEDUP,
    "silver_dedup_rare": SILVER_DEDUP,
    "silver_incremental": oracle(
        ORDERS + " _ingestion_ts _ingestion_date",
        """SELECT *, TIMESTAMP '2001-08-04 00:00:00.000003' AS _ingestion_ts, '2001-08-04' AS _ingestion_date
           FROM c_orders WHERE order_id % 3 = 0""",
    ),
    "current_snapshot": oracle(
        LINES, latest_lines("2001-08-02 00:00:00.000001", "2001-08-03 00:00:00.000002"), lines=inputs.LINES
    ),
    "snapshot_incremental": oracle(
        "order_id:bigint user_id:bigint order_date total_amount:double status updated_at",
        "SELECT * FROM latest_orders",
        latest_orders=LATEST_ORDERS,
    ),
    "q1_funnel_incremental": funnel(),
    "q2_rfm_incremental": rfm([30, 60, 90, 180], [10, 5, 3, 2], [1000, 500, 200, 100], c_orders=LATEST_ORDERS),
    "q4_inventory_incremental": INVENTORY,
    "q5_attribution_incremental": attribution(30),
    "clickstream_unique": CLICKS,
    "clickstream_touch_pairs": f"""
        WITH clicks AS ({CLICKS})
        SELECT p.user_id, p.event_id AS purchase_event, p.event_time AS purchased_at,
               t.event_id AS touch_event, t.event_time AS touched_at, t.channel_id
        FROM clicks AS p JOIN clicks AS t
          ON t.user_id = p.user_id AND t.event_time < p.event_time
             AND t.event_time >= date_trunc('day', p.event_time) - INTERVAL 3 DAY
        WHERE p.event_type = 'purchase' AND t.event_type IN ('view', 'add_to_cart')""",
    "dim_users": oracle(
        "user_id:bigint full_name email phone city state country gender date_of_birth loyalty_segment "
        "registration_source is_active registered_at",
        "SELECT *, created_at AS registered_at FROM c_users",
    ),
    "dim_products": oracle(
        "product_id:bigint product_name sku category_id:bigint category_name brand base_price:double "
        "cost_price:double status created_at",
        """SELECT p.*, category_name FROM c_products AS p
           LEFT JOIN c_categories AS c ON c.category_id = p.category_id""",
    ),
    "dim_promotions": oracle(
        "promo_id:bigint promo_code discount_percent:double discount_type start_date end_date "
        "min_order_value:double max_discount_amount:double campaign_name",
        "SELECT * FROM c_promotions",
    ),
    "dim_marketing_channels": oracle(
        "channel_id:bigint channel_name channel_type platform utm_source utm_medium",
        "SELECT * FROM c_marketing_channels",
    ),
    "fact_orders": oracle(
        "order_id:bigint user_id:bigint order_date order_date_key total_amount:double subtotal_amount:double "
        "tax_amount:double shipping_fee:double discount_amount:double promo_discount_total:double "
        "num_promos_applied:bigint status payment_method payment_status source_channel device_type "
        "total_quantity:bigint num_line_items:bigint",
        """SELECT o.*, CAST(order_date AS DATE) AS order_date_key,
                  (SELECT coalesce(sum(applied_amount), 0) FROM c_order_promotions AS p
                   WHERE p.order_id = o.order_id) AS promo_discount_total,
                  (SELECT count(*) FROM c_order_promotions AS p WHERE p.order_id = o.order_id) AS num_promos_applied,
                  (SELECT coalesce(sum(quantity), 0) FROM c_order_items AS l
                   WHERE l.order_id = o.order_id) AS total_quantity,
                  (SELECT count(*) FROM c_order_items AS l WHERE l.order_id = o.order_id) AS num_line_items
           FROM c_orders AS o""",
    ),
    "fact_order_items": oracle(
        "order_item_id:bigint order_id:bigint user_id:bigint product_id:bigint order_date order_date_key "
        "quantity:bigint unit_price:double discount_amount:double tax_amount:double line_total:double",
        """SELECT l.*, o.user_id, o.order_date, CAST(o.order_date AS DATE) AS order_date_key
           FROM c_order_items AS l LEFT JOIN c_orders AS o ON o.order_id = l.order_id""",
    ),
    "q1_conversion_funnel": funnel(),
    "q2_rfm_segmentation": rfm([30, 60, 90, 180], [10, 5, 3, 2], [1000, 500, 200, 100]),
    "q2_rfm_segmentation_raised": rfm(
        [60, 180, 365, 730], [11, 9, 7, 5], [3_000_000, 2_200_000, 1_500_000, 800_000]
    ),
    "q3_promo_comparison": promo_comparison(per_order=False),
    "q3_promo_comparison_per_order": promo_comparison(per_order=True),
    "q3_promo_detail": PROMO_DETAIL,
    "q4_inventory_analysis": INVENTORY,
    "q5_attribution": attribution(30),
    "q5_attribution_week": attribution(7),
    "order_totals_rollup": oracle(
        ORDERS,
        """SELECT o.* REPLACE (CASE WHEN s.order_id IS NULL THEN o.subtotal_amount ELSE subtotal END AS subtotal_amount,
                               CASE WHEN s.order_id IS NULL THEN o.tax_amount ELSE tax END AS tax_amount,
                               CASE WHEN s.order_id IS NULL THEN o.discount_amount ELSE discount END AS discount_amount,
                               CASE WHEN s.order_id IS NULL THEN o.total_amount
                                    ELSE subtotal + tax + o.shipping_fee - discount END AS total_amount)
           FROM c_orders AS o
           LEFT JOIN (SELECT order_id, sum(unit_price * quantity) AS subtotal, sum(tax_amount) AS tax,
                             sum(discount_amount) AS discount
                      FROM c_order_items GROUP BY order_id) AS s ON s.order_id = o.order_id""",
    ),
    "upsert_latest": UPSERT,
    "insert_if_absent": INSERT,
    "fk_violations": fk_report(),
    "key_violations": key_report(),
    "fk_violations_by_bitmap": fk_report(),
    "key_violations_by_bitmap": key_report(),
    "email_phone_quality": EMAIL_PHONE_QUALITY,
}
ORACLES["pipeline_run"] = pipeline()
