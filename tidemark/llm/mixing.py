"""Mixing sources to target weights by Pareto order sampling. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD
from tidemark.session import stage

#: Documents in one slice of the sampling order. The number of slices follows the source's size.
SLICE = 2_000
DIGITS = 13


def uniform(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 that depends on key and seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**DIGITS))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """Words wanted of each source: (source, source_size, target) from (source, source_size).

    Sources in code point order, NULL last, take ``weights`` in turn. The budget is ``share`` of all words. A target
    stops at ``most`` times its source; the excess goes to the others by weight until none is above. With sources in
    order of cap / weight, those that stop are the first ones, so running sums settle it in one pass over one row
    per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    listed = sizes.withColumn("place", place).withColumn("weight", weight.cast("long"))
    listed = listed.withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place"))
    total = F.round(F.sum("source_size").over(Window.partitionBy()) * F.lit(share)).cast("long")
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    stepped = listed.select("*", total.alias("total"), before.alias("before"), rest.alias("rest"))
    level = (F.col("total") - F.col("before")) / F.col("rest")
    stepped = stepped.withColumn("stops", level >= F.col("cap") / F.col("weight"))
    free = F.min(F.when(~F.col("stops"), F.struct(F.col("cap") / F.col("weight"), "place", "before", "rest"))).over(Window.partitionBy())
    stepped = stepped.withColumn("free", free)
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(
        ((F.col("total") - F.col("free.before")) * F.col("weight")).cast("double") / F.col("free.rest")
    )
    return stepped.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3, weight_col: str | None = None,
    seed: str = "mix", slice_rows: int = SLICE,
) -> DataFrame:
    """How often each document goes into the mix: (id, size, source_size, target, copies, taken).

    A document's expected copies are target / source_size, times its ``weight_col`` over the source's mean weight (by
    words) if given, ``most`` at most. Their whole part is certain. For the rest, documents stand in Pareto order:
    random odds u/(1-u) divided by inclusion odds p/(1-p). The sample is the head of that order whose words fill what
    the certain copies leave open; the document on the border goes in if more than half of it fits, so a source is off
    by half a document at most (with weights that ask for more than ``most`` copies, it may fall short).

    The order is cut into slices of about ``slice_rows`` documents; a running sum over one row per slice gives each
    slice its start, so no source, however large, is sorted in one task. u depends on the id and ``seed`` only: reruns
    agree, and rows that repeat an id share its u.

    NULL or empty texts have size 0 and are never drawn; a NULL source is a source of its own, last in order; a NULL id
    counts as the empty id; a NULL or negative weight is 0. Other columns are ignored. Empty input gives no rows.
    """
    weight = F.lit(1.0) if weight_col is None else F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0))
    slim = stage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), weight.alias("w"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ), "mix-sizes")
    sums = slim.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("w") * F.col("size")).alias("mass"), F.count("*").alias("n"),
    )
    wanted = targets(sums.select("source", "source_size"), weights, share, most)
    sums = sums.withColumnRenamed("source_size", "s").withColumnRenamed("source", "own")
    wanted = wanted.join(sums, F.col("source").eqNullSafe(F.col("own")))
    wanted = stage(wanted.select("source", "source_size", "target", "mass", "n"), "mix-targets")

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    if weight_col is not None:
        rate = F.when(F.col("mass") > 0, rate * F.col("w") / (F.col("mass") / F.col("source_size"))).otherwise(0.0)
    joined = slim.withColumnRenamed("source", "own").join(wanted, F.col("own").eqNullSafe(F.col("source"))).drop("own")
    held = joined.withColumn("rate", F.least(rate, F.lit(float(most)))).withColumn("whole", F.floor("rate"))
    u, p = uniform(F.col("id"), seed), F.col("rate") - F.col("whole")
    odds = (u / (1.0 - u)) / (p / (1.0 - p))
    held = held.withColumn("odds", F.when((p > 0) & (F.col("size") > 0), odds))
    slices = F.ceil(F.col("n") / F.lit(slice_rows))
    # Odds times the source's own inclusion odds are near u/(1-u) again, so slices are even; the order stays.
    own = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    own = F.least(F.greatest(own - F.floor(own), F.lit(0.001)), F.lit(0.999))
    even = F.col("odds") * (own / (1.0 - own))
    held = held.withColumn("slice", F.floor(even / (1.0 + even) * slices))

    keys = ["source", "slice"]
    certain = F.sum(F.col("whole") * F.col("size"))
    heads = held.groupBy(*keys).agg(F.sum("size").alias("words"), certain.alias("certain"))
    line = Window.partitionBy("source").orderBy("slice")
    heads = heads.select(
        F.col("source").alias("s"), F.col("slice").alias("k"), F.sum("certain").over(Window.partitionBy("source")).alias("certain"),
        F.when(F.col("slice").isNotNull(), F.sum(F.when(F.col("slice").isNotNull(), F.col("words")).otherwise(0)).over(
            line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")).alias("start"),
    )
    placed = held.join(heads, F.col("source").eqNullSafe(F.col("s")) & F.col("slice").eqNullSafe(F.col("k")))
    # Documents that cannot be drawn need no order: spread them instead of gathering them under a NULL slice.
    drawn, plain = placed.filter("slice IS NOT NULL"), placed.filter("slice IS NULL")
    run = F.sum("size").over(Window.partitionBy(*keys).orderBy("odds", "id", "size").rowsBetween(Window.unboundedPreceding, 0))
    middle = F.col("start") + run - F.col("size") / 2.0
    drawn = drawn.withColumn("extra", (middle < F.col("target") - F.col("certain")).cast("long"))
    both = drawn.unionByName(plain.withColumn("extra", F.lit(0).cast("long")))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0).cast("long")
    return both.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )
