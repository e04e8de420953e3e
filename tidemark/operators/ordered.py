"""Ordered work on long series without putting a hot series into one task.

A window over ``partitionBy(key)`` sends every row of a key to one task, and an un-keyed window sends
the whole table there. So the rows per key are counted first. Where no key has more than ``HOT_ROWS``,
the plain window is the right plan and is used. The keys beyond it, and every un-keyed table, are cut
into *segments* by a range shuffle over all order columns: their bounds follow the number of rows, so a
dense day is cut like any other, and their number follows the shuffle partitions, so little passes
between them, one summary row per segment:

* ``row_index``   exact row numbers: count per segment, running total of the counts, number inside.
* ``neighbours``  last and next non-NULL value: local inside a segment, carried over the summaries.
* ``over_rows``   any frame of a fixed number of rows: numbered rows are cut into blocks, and each
  block also gets copies of the few rows just outside it.

NULL order values come first. Rows that tie on the order columns stand in the order of a hash of their
other columns, so both paths give the same answer; equal rows are interchangeable.

The cut rows are written to the shared folder: a range shuffle samples its bounds, so a second run of the
same plan might cut elsewhere. The input is read twice (sample, cut) before that, and the count per key
reads it once more: stage it first if it is costly to compute. ``segment`` gives the number of segments;
``segment=WHOLE`` keeps the plain window, for series whose length the calendar bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.session import stage

WHOLE = "whole"

_SEG, _RN, _OWN, _BLOCK, _HOT, _TIE = "__segment", "__rn", "__own", "__block", "__hot", "__tie"
BLOCK_ROWS = 8192
HOT_ROWS = 1_000_000


def names(cols) -> list[str]:
    """A column name or a sequence of names, as a list."""
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def _join_small(df: DataFrame, small: DataFrame, keys, also=()) -> DataFrame:
    """Left join to a frame with one row per key. It is staged, so the planner knows its size and
    broadcasts it below the session's threshold, before the rows are shuffled. NULL keys match."""
    right = stage(small.withColumnsRenamed({k: f"__r_{k}" for k in [*keys, *also]}), "summary")
    match = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys] + [F.col(k) == F.col(f"__r_{k}") for k in also]
    return df.join(right, match, "left").drop(*[f"__r_{k}" for k in [*keys, *also]])


def _join_summary(body: DataFrame, summary: DataFrame, keys) -> DataFrame:
    """Left join to one row per segment. Without keys there are no more of them than shuffle partitions."""
    if keys:
        return _join_small(body, summary, keys, [_SEG])
    return body.join(F.broadcast(summary), _SEG, "left")


def _split(df: DataFrame, order, keys, segment) -> DataFrame | None:
    """The frame with the segment of each row of a hot key, NULL on other rows; None when no key is hot."""
    if segment == WHOLE:
        return None

    def cut(rows: DataFrame) -> DataFrame:
        # The last bound lets rows that differ elsewhere part, where ties are settled by a few columns only.
        by = [*keys, *order, F.xxhash64(*_hashable(rows))]
        ranged = rows.repartitionByRange(segment, *by) if segment else rows.repartitionByRange(*by)
        return stage(ranged.withColumn(_SEG, F.spark_partition_id()), "segments")

    if not keys:
        return cut(df)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > HOT_ROWS)
    # At most one row per HOT_ROWS rows of the table.
    hot = stage(sizes.select(*keys, F.lit(True).alias(_HOT)), "hot_keys")
    if hot.isEmpty():
        return None
    marked = _join_small(df, hot, keys)
    cold = marked.filter(F.col(_HOT).isNull()).withColumn(_SEG, F.lit(None).cast("int"))
    return cut(marked.filter(_HOT)).unionByName(cold).drop(_HOT)


def _hashable(df: DataFrame, without=()) -> list[str]:
    return [f.name for f in df.schema if f.name not in without and "map<" not in f.dataType.simpleString()]


def _tied(df: DataFrame, order: list[str], cols=None) -> tuple[DataFrame, list[str]]:
    """The frame and its order with a last column that settles ties: a hash of ``cols``, by default of all columns."""
    told = [c for c in _hashable(df, order) if cols is None or c in cols]
    return df.withColumn(_TIE, F.xxhash64(*told) if told else F.lit(0).cast("bigint")), [*order, _TIE]


def place(df: DataFrame, order, ties=()) -> Column:
    """The place of a row in the one total order of this module, to be compared in ``max_by`` and ``min_by``: the order columns,
    then ``ties``, then the hash of the others. NULL, and so passed over, where the first order column is NULL."""
    order = [*names(order), *names(ties)]
    told = _hashable(df, order)
    return F.when(F.col(order[0]).isNotNull(), F.struct(*order, (F.xxhash64(*told) if told else F.lit(0).cast("bigint")).alias("tie")))


def _between_segments(keys, descending: bool = False) -> WindowSpec:
    """Window over segment summaries, one light row per hot key and segment."""
    seg = F.col(_SEG)
    return Window.partitionBy(*keys).orderBy(seg.desc() if descending else seg.asc())


def _numbered(body: DataFrame, order, keys, name: str) -> DataFrame:
    before = F.sum("__n").over(_between_segments(keys).rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        body.filter(F.col(_SEG).isNotNull()).groupBy(*keys, _SEG).agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, _SEG, F.coalesce(before, F.lit(0)).alias("__before"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys, _SEG).orderBy(*order))
    return (
        _join_summary(body, offsets, keys)
        .withColumn(name, (F.coalesce("__before", F.lit(0)) + inside - 1).cast("bigint"))
        .drop("__before")
    )


def row_index(df: DataFrame, order, keys=(), name: str = "rn", segment=None) -> DataFrame:
    """Adds the 0-based position of a row inside its key."""
    keys = names(keys)
    df, order = _tied(df, names(order))
    split = _split(df, order, keys, segment)
    if split is None:
        return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint")).drop(_TIE)
    return _numbered(split, order, keys, name).drop(_SEG, _TIE)


STEP = "__step"


def neighbours(df: DataFrame, order, cols, keys=(), segment=None, steps: bool = False) -> DataFrame:
    """Adds ``__prev_c`` and ``__next_c`` for each column c: a struct of the order columns and the value
    ``v`` at the nearest non-NULL row, the row itself included. With ``steps`` the rows are also numbered
    per key, and the structs and the row carry that number as ``__step``; only differences of it count.
    """
    cols, keys = names(cols), names(keys)
    df, order = _tied(df, names(order), cols)
    numbered = [STEP] if steps else []

    def mark(c):
        return F.when(F.col(c).isNotNull(), F.struct(*order, *numbered, F.col(c).alias("v")))

    def local(frame, partition):
        past = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        # A frame that runs to the end of the partition is quadratic; the mirrored order is not.
        ahead = Window.partitionBy(*partition).orderBy(*[F.col(o).desc() for o in order]).rowsBetween(
            Window.unboundedPreceding, 0
        )
        return frame.withColumns({f"__prev_{c}": F.last(mark(c), True).over(past) for c in cols}).withColumns(
            {f"__next_{c}": F.last(mark(c), True).over(ahead) for c in cols}
        )

    def number(frame, partition):
        if not steps:
            return frame
        return frame.withColumn(STEP, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)).cast("bigint"))

    split = _split(df, order, keys, segment)
    if split is None:
        return local(number(df, keys), keys).drop(_TIE)

    body = number(split, [*keys, _SEG])
    ends = body.filter(F.col(_SEG).isNotNull()).groupBy(*keys, _SEG).agg(
        *[F.max(mark(c)).alias(f"__last_{c}") for c in cols],
        *[F.min(mark(c)).alias(f"__first_{c}") for c in cols],
        F.count(F.lit(1)).alias("__n"),
    )
    earlier = _between_segments(keys).rowsBetween(Window.unboundedPreceding, -1)
    later = _between_segments(keys, descending=True).rowsBetween(Window.unboundedPreceding, -1)
    if steps:
        # Numbers inside a segment become numbers of the key by the row count of all earlier segments.
        ends = ends.withColumn("__offset", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        shift = lambda side, c: F.when(
            F.col(f"{side}_{c}").isNotNull(),
            F.col(f"{side}_{c}").withField(STEP, F.col(f"{side}_{c}")[STEP] + F.col("__offset")),
        )
        ends = ends.withColumns({f"{side}_{c}": shift(side, c) for c in cols for side in ("__last", "__first")})
    carried = ends.select(
        *keys, _SEG,
        *(["__offset"] if steps else []),
        *[F.last(f"__last_{c}", True).over(earlier).alias(f"__before_{c}") for c in cols],
        *[F.last(f"__first_{c}", True).over(later).alias(f"__after_{c}") for c in cols],
    )
    joined = _join_summary(body, carried, keys)
    if steps:
        joined = joined.withColumn(STEP, F.col(STEP) + F.coalesce("__offset", F.lit(0)))
    found = local(joined, [*keys, _SEG])
    return found.withColumns(
        {
            **{f"__prev_{c}": F.coalesce(f"__prev_{c}", f"__before_{c}") for c in cols},
            **{f"__next_{c}": F.coalesce(f"__next_{c}", f"__after_{c}") for c in cols},
        }
    ).drop(_SEG, _TIE, "__offset", *[f"__{side}_{c}" for c in cols for side in ("before", "after")])


Step = Callable[[WindowSpec], dict[str, Column]]


def over_rows(
    df: DataFrame, order, steps: Step | list[Step], keys=(), before: int = 0, after: int = 0, segment=None
) -> DataFrame:
    """Adds window columns whose frames reach at most ``before`` rows back and ``after`` rows ahead.

    Each step maps an ordered window to new columns; later steps may read columns of earlier ones, and
    ``before`` / ``after`` are then the sums of the reaches.
    """
    keys = names(keys)
    df, order = _tied(df, names(order))
    steps = steps if isinstance(steps, list) else [steps]
    split = _split(df, order, keys, segment)
    if split is None:
        for step in steps:
            df = df.withColumns(step(Window.partitionBy(*keys).orderBy(*order)))
        return df.drop(_TIE)

    size = max(BLOCK_ROWS, 4 * (before + after))
    hot = F.col(_SEG).isNotNull()
    own = F.when(hot, F.floor(F.col(_RN) / size)).otherwise(0)
    place = F.col(_RN) % size
    copies = [own]
    if before:
        copies.append(F.when(hot & (place >= size - before), own + 1))
    if after:
        copies.append(F.when(hot & (place < after) & (own > 0), own - 1))
    rows = (
        _numbered(split, order, keys, _RN)
        .withColumn(_OWN, own)
        .withColumn(_BLOCK, F.explode(F.array_compact(F.array(*copies))))
    )
    for step in steps:
        rows = rows.withColumns(step(Window.partitionBy(*keys, _BLOCK).orderBy(_RN)))
    return rows.filter(F.col(_OWN) == F.col(_BLOCK)).drop(_RN, _OWN, _BLOCK, _SEG, _TIE)


def attach(df: DataFrame, stats: DataFrame, keys=()) -> DataFrame:
    """Adds the columns of a per-key aggregate to every row of the key.

    Without keys the aggregate is one row and is read as a scalar subquery. With keys it is staged and
    joined by size: a broadcast leaves the table unshuffled however hot a key is; past the threshold it
    is a sort-merge join with adaptive skew handling.
    """
    keys = names(keys)
    if keys:
        return _join_small(df, stats, keys)
    row = stats.select(F.struct(*stats.columns)).scalar()
    return df.withColumn("__stats", row).select(*df.columns, *[F.col("__stats")[c].alias(c) for c in stats.columns])
