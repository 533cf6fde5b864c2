"""Groups of neighbouring rows in sorted Arrow batches, and connected components by Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsift.session import cut


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table for each run of equal keys (integers without nulls), across batch borders."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        changes = np.zeros(table.num_rows, dtype=bool)
        for key in keys:
            values = table.column(key).to_numpy()
            changes[1:] |= values[1:] != values[:-1]
        borders = [0, *np.flatnonzero(changes).tolist()]
        for begin, end in zip(borders, borders[1:]):
            yield table.slice(begin, end - begin)
        rest = table.slice(borders[-1]).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of n nodes, by repeated minima over the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node that has a link.

    ``edges`` has columns a and b without nulls. Large-star and small-star steps alternate: each links
    the neighbours of a node to the smallest of them, until nothing changes. A node's minimum is a
    grouped aggregate joined back, so a node with very many links is summed before the shuffle and its
    rows are split by the skewed-join rule. Edges are cut by a reliable checkpoint in each round.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = cut(links.distinct())
    state = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        pairs = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        links = cut(pairs.where("a <> b").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
