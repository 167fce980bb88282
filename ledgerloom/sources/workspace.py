"""Written layers: tables that are read several times and must not change between reads."""

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor sees: the session's ``spark.checkpoint.dir``, or the checkpoint folder
    its context was given. The cluster vouches for that folder, also where it is a mounted one (``file:``).
    There is no fallback: a folder of one machine would lose layers."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder


class Workspace:
    """Named Parquet layers under one run folder.

    A layer is written once and read back, so later jobs neither repeat its plan nor depend on
    cached blocks of executors that may be lost.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        base = folder or shared_folder(spark)
        self.folder = f"{base.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"
        self._layers: dict[str, DataFrame] = {}
        self._tables: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write one frame under a fresh name and return the reader of it."""
        path = self.path(f"{name}-{uuid.uuid4().hex[:8]}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_bucketed(self, df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> DataFrame:
        """Write one frame in buckets of the ``keys`` and return the reader of it.

        Frames bucketed alike join and group on these keys where they lie, with no exchange. ``buckets`` must be the same
        for them; it defaults to the shuffle partitions, so it grows with that setting. The table is known to this session only.
        """
        count = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"ledgerloom_{re.sub('[^a-z0-9]', '_', name.lower())}_{uuid.uuid4().hex}"
        dealt = df.repartition(count, *keys).sortWithinPartitions(*keys)
        dealt.write.option("path", self.path(table)).format("parquet").bucketBy(count, *keys).sortBy(*keys).saveAsTable(table)
        self._tables.append(table)
        return self.spark.table(table)

    def layer(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The named layer, built and written at first use."""
        if name not in self._layers:
            self._layers[name] = self.write(build(), name)
        return self._layers[name]

    def memo(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The named frame, kept as built; for frames that are already written inside."""
        if name not in self._layers:
            self._layers[name] = build()
        return self._layers[name]

    def drop(self) -> None:
        """Remove the run folder through the file system that holds it, and forget its tables."""
        for table in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.folder)
        target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
        self._layers.clear()
