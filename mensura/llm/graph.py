"""Connected components of an edge list, and runs of equal keys in batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): every node of ``edges`` (a, b) with the smallest node of
    its component.

    Alternates large-star and small-star: each round joins a node's
    neighbours to the least of them, until every node hangs on one root.
    Rounds are written to the shared folder; no node's neighbours meet in one
    task (minimum by aggregation, then a join).
    """
    e = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), label)
    while True:
        # Done when no node has two edges up, or edges both up and down.
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up + down > 1").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = staged(small.select("u", F.col("m").alias("v")).union(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), label)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Groups of rows that are equal in the first ``keys`` columns (longs or
    ints), from batches sorted by them; holds one batch and one group."""
    held: pa.Table | None = None
    for rb in batches:
        t = pa.Table.from_batches([rb])
        t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
        if not t.num_rows:
            continue
        change = np.zeros(t.num_rows, dtype=bool)
        for k in range(keys):
            v = t.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change)
        lo = 0
        for hi in cuts.tolist():
            yield t.slice(lo, hi - lo)
            lo = hi
        held = t.slice(lo)
    if held is not None and held.num_rows:
        yield held


def roots(m: int, pairs: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
    """Least member of each of ``m`` items' set after uniting i with js."""
    root = np.arange(m)
    for i, js in pairs:
        if len(js):
            named = np.unique(np.append(root[js], root[i]))
            if len(named) > 1:
                root[np.isin(root, named)] = named[0]
    return root
