"""A last-wins dimension that is kept from batch to batch and changed by what arrives.

The state holds one row per id with its rank and name, in partitions by a hash of the id. A delta is
brought to one row per id with map-side combining, merged with the partitions that its ids fall into, and
only those in which an id won a later name are written again. The later of two ranks wins whichever comes
first, so deltas may arrive in any order, twice, or again after a crash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from nestweave.functions.nested import column
from nestweave.sources.partitions import PartitionedFolder

#: Partitions of the state; a delta names at most so many to the driver.
PARTITIONS = 256

_PART = "part"


class MaintainedDimension:
    """The names that :func:`nestweave.operators.dimension.last_wins_dimension` would choose from all deltas.

    ``example`` gives the types: any DataFrame with the columns of the deltas. ``path`` is a folder that
    every executor can reach; the same one with the same arguments goes on where the last update ended.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        example: DataFrame,
        id_column: str,
        name_column: str,
        order: Sequence[str],
        partitions: int = PARTITIONS,
    ):
        self.id_column, self.name_column, self.order = id_column, name_column, list(order)
        self.partitions = partitions
        # Nullability is left out: a state that was written may hold nulls where a delta can't.
        kinds = [self._best().alias("best")]
        best = example.select(*kinds).schema["best"].dataType
        self.schema = T.StructType([
            T.StructField("id", example.schema[id_column].dataType),
            T.StructField("best", _nullable(best)),
            T.StructField(_PART, T.IntegerType()),
        ])
        self.state = PartitionedFolder(spark, path, self.schema, _PART)

    def _best(self) -> Column:
        ranks = [column(c).alias(f"order_{i}") for i, c in enumerate(self.order)]
        return F.struct(*ranks, column(self.name_column).alias("name"))

    def update(self, delta: DataFrame) -> list[int]:
        """Merges ``delta`` and returns the partitions that were written."""
        part = F.pmod(F.xxhash64("id"), F.lit(self.partitions)).cast("int")
        new = (
            delta.where(column(self.id_column).isNotNull())
            .select(column(self.id_column).alias("id"), self._best().alias("best"))
            .groupBy("id")
            .agg(F.max("best").alias("best"))
            .withColumn(_PART, part)
        )
        touched = [r[0] for r in new.select(_PART).distinct().collect()]
        if not touched:
            return []
        old = self.state.rows().where(F.col(_PART).isin(touched)).withColumn("old", F.col("best"))
        merged = old.unionByName(new, allowMissingColumns=True).groupBy("id", _PART)
        merged = merged.agg(F.max("best").alias("best"), F.max("old").alias("old"))
        return self.state.replace(merged, F.col("old").isNull() | (F.col("best") > F.col("old")))

    def names(self) -> DataFrame:
        """One row per id with its name, under the names of the reference's columns; read without a shuffle."""
        return self.state.rows().select(F.col("id").alias(self.id_column), F.col("best.name").alias(self.name_column))


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    return kind


def maintain(
    stream: DataFrame, dimension: MaintainedDimension, checkpoint: str, trigger: dict[str, object]
) -> StreamingQuery:
    """Merges every micro-batch of a stream of reference rows; a replayed one changes nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            dimension.update(kept)
        finally:
            kept.unpersist()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**trigger).start()
