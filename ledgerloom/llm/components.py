"""Connected components of links, by union-find spread over tasks."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import Workspace

#: Links that one task writes in a round, at least.
LINKS = 1 << 16


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one batch of links: each node is linked with the smallest it is joined to."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        found = [(x, find(x)) for x in parent]
        found = [(x, r) for x, r in found if x != r]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], ["node", "root"])


def _starred(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """One star step: the neighbours of each node are linked with the smallest of them.

    With ``larger_only`` a node's larger neighbours move to its smallest one, else its smaller ones
    and itself do. The minimum is aggregated before the join, so a hot node does not gather its
    neighbours in one task: the join can be split by adaptive execution.
    """
    if larger_only:
        both = pairs.unionByName(pairs.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("least"))
        moved = both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.least("least", F.col("node")).alias("root"))
    else:
        least = pairs.groupBy("node").agg(F.min("root").alias("least"))
        joined = pairs.join(least, "node")
        moved = joined.select(F.explode(F.array(F.struct("node", F.col("least").alias("root")), F.struct(F.col("root").alias("node"), F.col("least").alias("root")))).alias("x")).select("x.*").where("node > root")
    return moved.distinct()


def components(links: DataFrame, space: Workspace) -> DataFrame:
    """Node and the smallest node it can reach, for every linked node but those smallest ones.

    ``links`` has two long columns; rows with a null or the same node twice are no links. Tasks first
    contract their own links by union-find; then star steps over the written forest join the tasks'
    trees until nothing changes, in a number of rounds that grows with the logarithm of the size.
    Each round is written to the shared folder, so lost executors cost one round at most.
    """
    a, b = links.columns
    pairs = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).where("node > root")
    pairs = space.write(pairs.mapInArrow(_forest, "node long, root long").distinct(), "forest")
    mark = [F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))]
    before = pairs.agg(*mark).first()
    while True:
        # a round writes a file for each LINKS links, not one for each shuffle partition
        after = space.write(_starred(_starred(pairs, True), False).coalesce(max(1, before[0] // LINKS)), "forest")
        found = after.agg(*mark).first()
        if found == before:
            return after
        pairs, before = after, found
