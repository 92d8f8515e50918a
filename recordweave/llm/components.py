"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.llm.common import materialize
from recordweave.storage import delete_folder


def local_components(size: int, left: np.ndarray, right: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """The smallest index of each node's component, for the nodes 0 to ``size`` - 1.

    ``labels`` may hold the result of an earlier call, to which the links are added.
    """
    labels = np.arange(size) if labels is None else labels
    while True:
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return labels
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(flat := labels[labels], labels):
            labels[:] = flat


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def star_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node with a link: ``root`` is the smallest node it reaches.

    ``edges`` has the columns a, b (bigint).  Each round points all larger neighbours of a
    node to its smallest one, then all smaller ones; a chain shrinks by a constant factor
    a round.  A hub's neighbours are joined with the hub's minimum, which adaptive
    execution splits; nothing is gathered per hub.  Every round is written as a table, so a lost
    executor costs one round at most.
    """
    spark = edges.sparkSession
    links = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = materialize(large.distinct(), "links")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = small.select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select("a", F.col("m").alias("b"))
        )
        after = materialize(small.distinct(), "links")
        used, links = (links, large), after
        reached = _state(links)
        for table in used:
            for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
                delete_folder(spark, folder)
        if reached == state:
            break
        state = reached
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
