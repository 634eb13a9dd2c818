"""The commerce data model: table schemas, keys and references.

Everything in this file is a fixed value of the data model. The jobs, the
quality checks and the cleaning rules all read it from here.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# The relational source tables, in Spark DDL.
TABLE_DDL: dict[str, str] = {
    "categories": (
        "category_id INT, category_name STRING, parent_id INT, category_code STRING, "
        "description STRING, is_active BOOLEAN, sort_order INT, seo_title STRING, "
        "seo_description STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "products": (
        "product_id INT, product_name STRING, sku STRING, category_id INT, brand STRING, "
        "base_price DECIMAL(15,2), cost_price DECIMAL(15,2), currency STRING, status STRING, "
        "weight DECIMAL(10,2), length DECIMAL(10,2), width DECIMAL(10,2), height DECIMAL(10,2), "
        "color STRING, size STRING, material STRING, supplier_name STRING, warranty_months INT, "
        "release_date DATE, tags STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "users": (
        "user_id INT, full_name STRING, email STRING, phone STRING, address STRING, city STRING, "
        "state STRING, country STRING, postal_code STRING, gender STRING, date_of_birth DATE, "
        "loyalty_segment STRING, registration_source STRING, preferred_language STRING, "
        "preferred_currency STRING, is_active BOOLEAN, last_login_at TIMESTAMP, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "orders": (
        "order_id INT, user_id INT, order_date TIMESTAMP, total_amount DECIMAL(15,2), "
        "subtotal_amount DECIMAL(15,2), tax_amount DECIMAL(15,2), shipping_fee DECIMAL(10,2), "
        "discount_amount DECIMAL(15,2), status STRING, payment_method STRING, "
        "payment_status STRING, shipping_address STRING, billing_address STRING, "
        "coupon_code STRING, source_channel STRING, device_type STRING, browser STRING, "
        "ip_address STRING, user_agent STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "order_items": (
        "order_item_id INT, order_id INT, product_id INT, quantity INT, unit_price DECIMAL(15,2), "
        "discount_amount DECIMAL(15,2), tax_amount DECIMAL(15,2), line_total DECIMAL(15,2), "
        "variant_name STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "promotions": (
        "promo_id INT, promo_code STRING, discount_percent DECIMAL(5,2), discount_type STRING, "
        "start_date DATE, end_date DATE, min_order_value DECIMAL(15,2), "
        "max_discount_amount DECIMAL(15,2), campaign_name STRING, channel_limit STRING, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "order_promotions": (
        "order_id INT, promo_id INT, applied_amount DECIMAL(15,2), "
        "created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "warehouses": (
        "warehouse_id INT, warehouse_name STRING, location STRING, capacity INT, "
        "manager_name STRING, phone STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "inventory": (
        "inventory_id INT, product_id INT, warehouse_id INT, stock_on_hand INT, "
        "reserved_quantity INT, reorder_level INT, reorder_quantity INT, safety_stock INT, "
        "last_restock_date TIMESTAMP, next_restock_date TIMESTAMP, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "marketing_channels": (
        "channel_id INT, channel_name STRING, channel_type STRING, platform STRING, "
        "utm_source STRING, utm_medium STRING, utm_campaign STRING, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "clickstream": (
        "event_id BIGINT, user_id INT, session_id STRING, event_type STRING, product_id INT, "
        "category_id INT, channel_id INT, timestamp TIMESTAMP, page_url STRING, "
        "referrer_url STRING, ad_campaign STRING, device_type STRING, browser STRING, os STRING, "
        "country STRING, city STRING, price_viewed DECIMAL(15,2), discount_shown DECIMAL(5,2), "
        "is_new_user BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
}

# The headerless click-event files, in field order.
CLICK_FILE_DDL = (
    "event_id BIGINT, user_id INT, session_id STRING, event_type STRING, product_id INT, "
    "category_id INT, channel_id INT, event_time STRING, page_url STRING, referrer_url STRING, "
    "campaign_name STRING, device_type STRING, browser STRING, os STRING, country STRING, "
    "city STRING, price DOUBLE, discount DOUBLE, is_returning STRING, is_read STRING"
)

# The columns that identify one row of each table.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "categories": ("category_id",),
    "products": ("product_id",),
    "users": ("user_id",),
    "orders": ("order_id",),
    "order_items": ("order_item_id",),
    "promotions": ("promo_id",),
    "order_promotions": ("order_id", "promo_id"),
    "warehouses": ("warehouse_id",),
    "inventory": ("inventory_id",),
    "marketing_channels": ("channel_id",),
    "clickstream": ("event_id",),
}

# The tables that carry a change time, read incrementally by it.
TRACKED_TABLES = frozenset(PRIMARY_KEYS)


class ForeignKey(NamedTuple):
    child: str
    column: str
    parent: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}"

    @property
    def parent_column(self) -> str:
        return PRIMARY_KEYS[self.parent][0]


# The references between tables.
FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("products", "category_id", "categories"),
    ForeignKey("orders", "user_id", "users"),
    ForeignKey("order_items", "order_id", "orders"),
    ForeignKey("order_items", "product_id", "products"),
    ForeignKey("order_promotions", "order_id", "orders"),
    ForeignKey("order_promotions", "promo_id", "promotions"),
    ForeignKey("inventory", "product_id", "products"),
    ForeignKey("inventory", "warehouse_id", "warehouses"),
    ForeignKey("clickstream", "user_id", "users"),
    ForeignKey("clickstream", "product_id", "products"),
    ForeignKey("clickstream", "category_id", "categories"),
    ForeignKey("clickstream", "channel_id", "marketing_channels"),
)

# Further constraints of the source database.
UNIQUE_COLUMNS: dict[str, tuple[str, ...]] = {"users": ("email",)}
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "categories": ("category_name",),
    "products": ("product_name",),
}

# How the database names the click-event columns that the files name otherwise.
CLICK_TABLE_RENAMES: dict[str, str] = {
    "timestamp": "event_time",
    "ad_campaign": "campaign_name",
    "price_viewed": "price",
    "discount_shown": "discount",
}

# Names of the columns the layers add.
STAMP = "_ingestion_ts"
STAMP_DATE = "_ingestion_date"
VERSION = "updated_at"


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLE_DDL[table])


def click_file_schema() -> T.StructType:
    return T.StructType.fromDDL(CLICK_FILE_DDL)


def declared_ids() -> frozenset[str]:
    """Every column that is part of a declared key or reference."""
    keys = {column for columns in PRIMARY_KEYS.values() for column in columns}
    return frozenset(keys | {fk.column for fk in FOREIGN_KEYS})
