"""Connected components of a link table, without gathering a component anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

#: Links that a task holds at once.
BLOCK = 1 << 18


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each node to the smallest one it reaches over the given links; the smallest ones have none."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, root = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while (root[x] != root[y]).any():
        np.minimum.at(root, np.maximum(root[x], root[y]), np.minimum(root[x], root[y]))
        while (root[root] != root).any():
            root = root[root]
    own = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[own], nodes[root[own]]


def contracted(links: DataFrame) -> DataFrame:
    """Fewer links that connect the same nodes: each block of a partition's links as stars. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            block = pa.Table.from_batches(held)
            a, b = forest(block.column("a").to_numpy(), block.column("b").to_numpy())
            return pa.RecordBatch.from_arrays([pa.array(a, block.schema.field("a").type), pa.array(b, block.schema.field("b").type)], ["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(h.num_rows for h in held) >= BLOCK:
                yield flush()
                held.clear()
        if held:
            yield flush()

    return links.mapInArrow(run, links.schema)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Alternating stars: each node sends its larger neighbours to the smallest node it knows, then its smaller ones.
    Both steps keep connectivity, and the table ends as one star per component after a logarithmic number of rounds.
    Minima are pre-aggregated before the shuffle and joined back, so a node with a third of all links is no hot group.
    Every round is written to the shared folder, which cuts the lineage. Blocks of links are made stars in the task that
    finds them, before they are written, so ``links`` may come straight from a join; this reads it once. What each node
    knows is written before the joins: it tells whether all are stars, so no round is spent on finding that nothing
    changes, and a small table is broadcast instead of shuffling the links. Rounds are what the driver's memory and time
    go into, as every shuffle is planned, compiled and accounted for there, and each writes two tables of files.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(contracted(ordered), "links")
    for _ in range(most_rounds):
        ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        above = F.when(F.col("b") < F.col("a"), F.col("b"))
        known = links.select(F.explode(ends).alias("link")).select("link.*").groupBy("a").agg(
            F.least("a", F.min("b")).alias("m"), (F.min(above) < F.max(above)).alias("torn"), (F.min("b") < F.col("a")).alias("led"), (F.max("b") > F.col("a")).alias("leads"))
        known = stage(known, "least")
        if not known.filter("torn OR led AND leads").count():
            return known.select(F.col("a").alias("node"), F.col("m").alias("component"))
        large = links.join(known.select(F.col("a").alias("b"), "m"), "b").select("a", F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
        )).alias("link")).select("link.*").filter("a <> b").distinct()
        links = stage(contracted(small), "links")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
