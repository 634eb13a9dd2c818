"""Row versions: latest per key, snapshots, upserts.

Every ranking here is a ``row_number`` compared with 1 directly above its window,
which Spark also applies before the shuffle: each map task sends on at most one
row per key, so a key with very many versions does not overload a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.model import STAMP, STAMP_DATE, VERSION

_UNORDERED = (T.MapType, T.VariantType)


def newest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], *, settle_ties: bool = True
) -> DataFrame:
    """One row per key, the first in the given order.

    With ``settle_ties`` the remaining columns complete the order, so the result
    does not depend on how rows are spread over tasks.
    """
    order = list(newest_first)
    if settle_ties:
        order += [
            F.col(f"`{field.name}`").desc_nulls_last()
            for field in df.schema.fields
            if field.name not in keys and not isinstance(field.dataType, _UNORDERED)
        ]
    ranked = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def by_age(df: DataFrame, version: str | None, stamp: str | None) -> list[Column]:
    """The order of versions, newest first, by those of both columns that there are."""
    return [
        F.col(f"`{name}`").desc_nulls_last() for name in (version, stamp) if name and name in df.columns
    ]


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    *,
    version: str | None = VERSION,
    stamp: str | None = STAMP,
) -> DataFrame:
    """The latest row per key; rows without a full key are dropped.

    Latest means the highest ``version``, then the highest arrival ``stamp``.
    Without keys, whole duplicate rows are removed.
    """
    if not keys:
        return df.dropDuplicates()
    return newest_per_key(df.dropna(subset=list(keys)), keys, by_age(df, version, stamp))


def dedup_rare(
    df: DataFrame,
    keys: Sequence[str],
    *,
    version: str | None = VERSION,
    stamp: str | None = STAMP,
) -> DataFrame:
    """What ``dedup`` returns, with a ranking of the repeated keys alone.

    The repeated keys are counted from the key columns; rows of other keys are not ranked. Spark
    chooses how to join the two, by the sizes it measures.
    """
    keys = list(keys)
    complete = df.dropna(subset=keys)
    repeated = complete.groupBy(*keys).agg(F.count("*").alias("_copies")).where("_copies > 1").select(*keys)
    single = complete.join(repeated, keys, "left_anti").select(*df.columns)
    several = complete.join(repeated, keys, "left_semi").select(*df.columns)
    return single.unionByName(newest_per_key(several, keys, by_age(df, version, stamp)))


def restamp(df: DataFrame, stamp: str) -> DataFrame:
    """Replace the arrival stamp and add its date, the partition column of the trusted layer."""
    return df.withColumns(
        {STAMP: F.lit(stamp).cast("timestamp"), STAMP_DATE: F.lit(stamp[:10])}
    )


def current_snapshot(
    history: DataFrame,
    keys: Sequence[str],
    *,
    version: str | None = VERSION,
    stamp: str | None = STAMP,
) -> DataFrame:
    """The latest row per key over all batches of a trusted table.

    Two batches may carry the same stamp, so the remaining columns settle ties. Select the
    columns that are needed before, and the ranking reads no others.
    """
    if not keys:
        return history.dropDuplicates()
    return newest_per_key(history, keys, by_age(history, version, stamp))


def upsert_latest(
    base: DataFrame, incoming: DataFrame, keys: Sequence[str], *, version: str | None = VERSION
) -> DataFrame:
    """``base`` with the rows of ``incoming`` put in place of those with the same key.

    Incoming rows win whatever their version; the version only picks among
    incoming rows of one key. ``base`` is expected to hold a key once. It is
    filtered by the incoming keys, which are not ranked for that, so it is not shuffled
    while those are small enough to broadcast.
    """
    kept = base.join(incoming.select(*keys), list(keys), "left_anti")
    fresh = dedup(incoming, keys, version=version, stamp=None)
    return kept.unionByName(fresh.select(*base.columns))


def insert_if_absent(
    base: DataFrame, incoming: DataFrame, keys: Sequence[str], *, version: str | None = VERSION
) -> DataFrame:
    """``base`` and those rows of ``incoming`` whose key it lacks, one per key."""
    return base.unionByName(absent(base, incoming, keys, version=version).select(*base.columns))


def absent(
    base: DataFrame, incoming: DataFrame, keys: Sequence[str], *, version: str | None = VERSION
) -> DataFrame:
    """The rows of ``incoming`` whose key ``base`` lacks, one per key.

    The base keys are first cut down to the incoming ones, which are not ranked for
    that and can be broadcast; only the matches meet the anti join.
    """
    known = base.select(*keys).join(incoming.select(*keys), list(keys), "left_semi")
    return dedup(incoming.join(known, list(keys), "left_anti"), keys, version=version, stamp=None)


def new_rows(known: DataFrame, incoming: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct rows of ``incoming`` that ``known`` does not hold, compared in ``columns`` with NULL equal to NULL."""
    left, right = incoming.dropDuplicates(list(columns)).alias("incoming"), known.select(*columns).alias("known")
    same = [F.col(f"incoming.`{name}`").eqNullSafe(F.col(f"known.`{name}`")) for name in columns]
    return left.join(right, reduce(lambda a, b: a & b, same), "left_anti")
