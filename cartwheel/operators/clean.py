"""Schema-driven cleaning of a raw table."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions import text
from cartwheel.model import declared_ids

NAME_COLUMNS = ("name", "full_name")
EMAIL_COLUMNS = ("email",)
PHONE_COLUMNS = ("phone",)
TIME_SUFFIX = "_at"


def clean(
    df: DataFrame,
    *,
    people: bool = False,
    name_columns: Collection[str] = NAME_COLUMNS,
    email_columns: Collection[str] = EMAIL_COLUMNS,
    phone_columns: Collection[str] = PHONE_COLUMNS,
    id_columns: Collection[str] | None = None,
) -> DataFrame:
    """Apply the column rules to every string column, in one projection.

    All strings are trimmed and blanks become NULL. In tables about ``people``
    the name, address and phone rules apply too. String columns among
    ``id_columns`` (by default the declared key and reference columns, so that
    free-form ids such as a session id survive) become longs, and string columns
    ending in ``_at`` become timestamps.
    """
    ids = declared_ids() if id_columns is None else frozenset(id_columns)

    def rule(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return column
        value = text.blank_to_null(column)
        if people and field.name in name_columns:
            value = text.proper_name(value)
        if people and field.name in email_columns:
            value = text.email_or_null(value)
        if people and field.name in phone_columns:
            value = text.phone_or_null(value)
        if field.name in ids:
            value = text.id_or_null(value)
        elif field.name.endswith(TIME_SUFFIX):
            value = text.time_or_null(value)
        return value.alias(field.name)

    return df.select([rule(field) for field in df.schema.fields])
