"""Last values per key in a table of their own, for streams that compare with them.

The table is a folder: ``base=<n>`` holds every key's value after micro-batch n, ``delta=<n>``
the values that micro-batch n set. Each is replaced as a whole when its micro-batch is
repeated, and read by micro-batches after it only, so a repeat sees what the first attempt
saw. It belongs to no checkpoint: a stream on a new one goes on from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.writers import checkpoint_mark
from ..sources.written import exists, make_folder, matching, remove

COMPACT_EVERY = 50


class LastValues:
    """The table at ``path`` of ``value`` by ``key``; a NULL key is a key."""

    def __init__(
        self, spark: SparkSession, path: str, key: T.StructField, value: T.StructField, compact_every: int = COMPACT_EVERY
    ) -> None:
        self.spark, self.path, self.compact_every = spark, path.rstrip("/"), compact_every
        self.schema = T.StructType([T.StructField(key.name, key.dataType), T.StructField(value.name, value.dataType)])
        self.key = key.name

    def _parts(self, kind: str) -> list[int]:
        """Numbers of the finished folders of a kind."""
        found = matching(self.spark, f"{self.path}/{kind}=*")
        return sorted(int(x.rsplit("=", 1)[1]) for x in found if exists(self.spark, f"{x}/_SUCCESS"))

    def first_number(self, checkpoint: str) -> int:
        """The number here of the first micro-batch of the stream with this checkpoint.

        It is above all numbers used before the stream first came, and noted in the table.
        """
        name = f"{self.path}/first-{checkpoint_mark(checkpoint)}"
        noted = matching(self.spark, f"{name}=*")
        if noted:
            return int(noted[0].rsplit("=", 1)[1])
        first = max([*self._parts("base"), *self._parts("delta"), -1]) + 1
        make_folder(self.spark, f"{name}={first}")
        return first

    def _read(self, kind: str, number: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{kind}={number}")

    def before(self, number: int) -> DataFrame:
        """The values as they were before micro-batch ``number``, a row per key."""
        return self._values(number, number - 1)

    def _values(self, number: int, last: int) -> DataFrame:
        """The newest base before ``number`` with the deltas after it up to ``last``."""
        base = max((n for n in self._parts("base") if n < number), default=None)
        deltas = [n for n in self._parts("delta") if (base is None or n > base) and n <= last]
        if not deltas:
            return self.spark.createDataFrame([], self.schema) if base is None else self._read("base", base)
        parts = [self._read("delta", n).withColumn("_at", F.lit(n)) for n in deltas]
        if base is not None:
            parts.append(self._read("base", base).withColumn("_at", F.lit(-1)))
        rows = reduce(DataFrame.unionAll, parts)
        newest = F.max_by(F.struct(*self.schema.names), "_at").alias("row")
        return rows.groupBy(F.col(self.key).alias("_key")).agg(newest).select("row.*")

    def put(self, values: DataFrame, number: int) -> None:
        """The values that micro-batch ``number`` sets; now and then all are written as a new base.

        What no micro-batch from the one before the last base on can read is removed.
        """
        values.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/delta={number}")
        bases = self._parts("base")
        last = max((n for n in bases if n < number), default=-1)
        if sum(last < n <= number for n in self._parts("delta")) < self.compact_every:
            return
        self._values(number, number).write.mode("overwrite").parquet(f"{self.path}/base={number}")
        for kind in ("base", "delta"):
            for n in self._parts(kind):
                if n < last or (kind == "delta" and n <= last):
                    remove(self.spark, f"{self.path}/{kind}={n}")
