"""Connected components by alternating large-star and small-star steps, each a groupBy and a join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.llm.common import drop_table, write_table

#: As many links (16 bytes each) are joined up in one task; more take the steps over all executors.
ONE_TASK_LINKS = 500_000


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def roots_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node and its component's smallest one, by lowering labels along links and then along labels."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def components(links: DataFrame) -> DataFrame:
    """node and root (the component's smallest node) of every node in `links` (columns u and v, of type long).

    Large-star hangs every larger neighbour on the smallest one, small-star every smaller one; both repeat until
    nothing moves. A node's neighbours are never collected: their minimum is aggregated and joined back. At most
    ONE_TASK_LINKS links are joined up by one task instead, with the same result."""
    edges = write_table(_tidy(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "edges")
    state = _state(edges)
    if state[0] <= ONE_TASK_LINKS:

        def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for x in batches:
                u.append(x.column(0).to_numpy(zero_copy_only=False))
                v.append(x.column(1).to_numpy(zero_copy_only=False))
            nodes, roots = roots_of(np.concatenate(u), np.concatenate(v))
            if len(nodes):
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "root"])

        return edges.select("u", "v").coalesce(1).mapInArrow(join_up, "node long, root long")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.col("n")).alias("m"))
        large = both.filter("v > u").join(low, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = write_table(_tidy(large), "edges")
        low = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("n")).select("v", "m").unionByName(low.select(F.col("n").alias("v"), "m"))
        after = write_table(_tidy(small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))), "edges")
        drop_table(edges)
        drop_table(large)
        edges, old, state = after, state, _state(after)
        if old == state:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
