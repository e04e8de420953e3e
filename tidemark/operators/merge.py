"""Upserts, increments, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordered import attach, names
from tidemark.operators.rolling import latest_per_key


def upsert(
    target: DataFrame, source: DataFrame, keys, coalesce_cols=(), overwrite_cols=(), strict_keys=()
) -> DataFrame:
    """The table after a MERGE of ``source`` into ``target``.

    On a match, ``coalesce_cols`` take the source value unless it is NULL, ``overwrite_cols`` take the
    source value, and other columns keep theirs. Unmatched source rows are inserted. Keys are compared
    NULL-safe; a NULL in one of the ``strict_keys`` matches nothing. The source must hold a key once
    (see ``dedupe``). Write the result as a new snapshot, never over the files it is read from.
    """
    keys, strict = names(keys), names(strict_keys)
    coalesced, overwritten = set(names(coalesce_cols)), set(names(overwrite_cols))
    columns = target.columns

    def keyed(df, side):
        key = [F.col(k) for k in keys]
        if strict:
            # A row with a NULL strict key gets a key of its own, from its side and content: it meets no
            # row of the other side, and many such rows do not gather in one partition.
            loose = F.greatest(*[F.col(k).isNull() for k in strict]) if len(strict) > 1 else F.col(strict[0]).isNull()
            key.append(F.when(loose, F.struct(F.lit(side).alias("side"), F.xxhash64(*df.columns).alias("row"))).alias("__own"))
        return df.select(F.struct(*key).alias("__key"), F.struct(*df.columns).alias(side))

    pairs = keyed(target, "__t").join(keyed(source, "__s"), "__key", "full")

    has_s, has_t = F.col("__s").isNotNull(), F.col("__t").isNotNull()

    def merged(c):
        old = F.col("__t")[c]
        if c in keys:
            return F.col("__key")[c]
        if c not in source.columns:
            return old
        new = F.col("__s")[c]
        if c in coalesced:
            return F.coalesce(new, old)
        if c in overwritten:
            return F.when(has_s, new).otherwise(old)
        return F.when(has_t, old).otherwise(new)

    return pairs.select(*[merged(c).cast(target.schema[c].dataType).alias(c) for c in columns])


def incremental(
    new: DataFrame, held: DataFrame, key: str, date: str = "date", default_days: int | None = None, as_of=None,
    overlap_days: int | None = None,
) -> DataFrame:
    """Rows of ``new`` past the latest date held for their key.

    A key without history gives its last ``default_days`` up to ``as_of`` (default: latest date of
    ``new``), or everything. ``overlap_days`` is how far before the marks the source is re-read:
    with ``default_days`` too, rows older than the smallest mark less the overlap and than the default range are
    dropped at the scan, which does not change the result.
    """
    marks = held.groupBy(key).agg(F.max(date).alias("__mark"))
    if overlap_days is not None and default_days is not None:
        end = F.lit(as_of).cast("date") if as_of is not None else new.agg(F.max(date).alias("d")).scalar()
        oldest = marks.agg(F.date_sub(F.min("__mark"), overlap_days).alias("d")).scalar()
        new = new.filter(F.col(date) >= F.least(oldest, F.date_sub(end, default_days)))
    rows = attach(new, marks, key)
    if default_days is None:
        first = F.lit(True)
    else:
        end = F.lit(as_of).cast("date") if as_of is not None else new.agg(F.max(date).alias("d")).scalar()
        first = F.col(date) >= F.date_sub(end, default_days)
    keep = F.when(F.col("__mark").isNull(), first).otherwise(F.col(date) > F.col("__mark"))
    return rows.filter(keep).select(*new.columns)


def dedupe(df: DataFrame, key, order: str, ties=()) -> DataFrame:
    """One row per key, the latest by ``order``; further columns break ties."""
    return latest_per_key(df, key, order, ties)
