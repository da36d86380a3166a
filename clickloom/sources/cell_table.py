"""A stored cell table: layers of files with known key ranges, and states that name the layers.

An upsert appends one layer, sorted by row key over range partitions, and beside it an
index of the least and greatest key of each file. A read merges the layers, the last
write of a cell wins. A lookup joins its keys to the ranges first and opens only the
files that can hold them. Compaction folds all layers into one.

Each step ends with a new state, the list of layers that make up the table. Readers
take the newest state that was written to its end, so they see the table before a step
or after it. One writer at a time: of two, the second fails on its state's name.
Layers of older states stay until :meth:`CellTable.expire`, for readers that still use them.

Cells without a row key are left out. Two changes of one cell at one version: the
greater value counts within an upsert, the later upsert across them.
"""

from __future__ import annotations

import uuid
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.session import cut_lineage
from clickloom.sources.cells import lookup_cells
from clickloom.sources.snapshots import list_snapshots

CELLS = "row_key string, family string, qualifier string, value string, version long"
INDEX = "layer string, file string, low string, high string, n long"
STATE = "state."
MAX_LAYERS = 16
# A lookup that hits more files than this reads the layers without naming files.
MAX_OPEN = 10_000


def _newest(cells: DataFrame) -> DataFrame:
    best = cells.groupBy("row_key", "family", "qualifier").agg(F.max(F.struct("version", "layer", "value")).alias("b"))
    return best.select("row_key", "family", "qualifier", F.col("b.value").alias("value"),
                       F.col("b.version").alias("version"))


class CellTable:
    """The table in one folder. ``files`` fixes the files of a layer; by default their size does."""

    def __init__(self, spark: SparkSession, path: str, files: int | None = None, max_layers: int = MAX_LAYERS):
        self.spark, self.path, self.files, self.max_layers = spark, path.rstrip("/"), files, max_layers
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _states(self) -> list[str]:
        """Complete states, the newest first."""
        if not self._fs.exists(self._path(f"{self.path}/states")):
            return []
        return [s for s in list_snapshots(self.spark, f"{self.path}/states", STATE)
                if self._fs.exists(self._path(f"{s}/_SUCCESS"))]

    def _named(self, state: str) -> list[str]:
        return [r.layer for r in self.spark.read.schema("place int, layer string").parquet(state).orderBy("place").collect()]

    def layers(self) -> list[str]:
        """Names of the layers of the newest state, the oldest first; never more than ``max_layers`` and one."""
        states = self._states()
        return self._named(states[0]) if states else []

    def _commit(self, layers: list[str]) -> None:
        states = self._states()
        number = int(states[0].rsplit(".", 1)[1]) + 1 if states else 0
        rows = self.spark.createDataFrame(list(enumerate(layers)), "place int, layer string")
        # A state of this name raises here: another writer was faster.
        rows.coalesce(1).write.parquet(f"{self.path}/states/{STATE}{number:012d}")

    def _write_layer(self, cells: DataFrame, below: list[str]) -> str:
        """A new layer and its index. A row of many cells spreads over as many files as it needs.

        Names sort by age, so the name tells which of two layers is the later one.
        """
        number = 1 + max((int(name.split("-")[1]) for name in below), default=-1)
        name = f"layer-{number:012d}-{uuid.uuid4().hex}"
        keys = ["row_key", "family", "qualifier"]
        ranged = cells.repartitionByRange(self.files, *keys) if self.files else cells.repartitionByRange(*keys)
        ranged.sortWithinPartitions(*keys).write.parquet(f"{self.path}/cells/{name}")
        written = self.spark.read.schema(CELLS).parquet(f"{self.path}/cells/{name}")
        written.select(F.col("_metadata.file_name").alias("file"), "row_key").groupBy("file").agg(
            F.min("row_key").alias("low"), F.max("row_key").alias("high"), F.count("*").alias("n")
        ).select(F.lit(name).alias("layer"), "file", "low", "high", "n").write.parquet(f"{self.path}/index/{name}")
        return name

    def upsert(self, changes: DataFrame) -> None:
        """Append the changes as a layer; fold the table once it has ``max_layers``."""
        usable = changes.select("row_key", "family", "qualifier", "value", F.col("version").cast("long"),
                                F.lit("").alias("layer")).where(F.col("row_key").isNotNull())
        layers = self.layers()
        self._commit([*layers, self._write_layer(_newest(usable), layers)])
        if len(layers) >= self.max_layers:
            self.compact()

    def compact(self) -> None:
        """Fold all layers into one. Readers go on with the state before until it is written."""
        layers = self.layers()
        if len(layers) > 1:
            self._commit([self._write_layer(_newest(self._cells(layers)), layers)])

    def expire(self, keep: int = 1) -> None:
        """Delete all but the newest ``keep`` states, and the layers that none of those names."""
        if keep < 1:
            raise ValueError("the newest state has to stay")
        states = self._states()
        kept = {layer for state in states[:keep] for layer in self._named(state)}
        gone = {layer for state in states[keep:] for layer in self._named(state)} - kept
        for path in [*states[keep:], *(f"{self.path}/{kind}/{layer}" for layer in gone for kind in ("cells", "index"))]:
            self._fs.delete(self._path(path), True)

    def _cells(self, paths: list[str]) -> DataFrame:
        """Cells of layers or of single files of them, with the name of their layer: one scan."""
        cells = self.spark.read.schema(CELLS).parquet(*[f"{self.path}/cells/{path}" for path in paths])
        return cells.withColumn("layer", F.regexp_extract(F.col("_metadata.file_path"), r"/(layer-[^/]+)/[^/]+$", 1))

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], CELLS)

    def read(self) -> DataFrame:
        """All current cells."""
        layers = self.layers()
        return _newest(self._cells(layers)) if layers else self._empty()

    def _files_of(self, layers: list[str], keys: DataFrame) -> list[str] | None:
        """Files that can hold the keys, as ``layer/file``; None if there are more than ``MAX_OPEN``."""
        index = self.spark.read.schema(INDEX).parquet(*[f"{self.path}/index/{name}" for name in layers])
        wanted = cut_lineage(keys.where(F.col("row_key").isNotNull()).distinct())
        # Files that begin with a key, and of each layer the last file that begins before it.
        begin = index.join(wanted, F.col("low") == F.col("row_key"), "left_semi").select("layer", "file")
        hits = begin.unionByName(self._begun_before(index, wanted, layers)).distinct().take(MAX_OPEN + 1)
        return None if len(hits) > MAX_OPEN else sorted(f"{hit.layer}/{hit.file}" for hit in hits)

    def _begun_before(self, index: DataFrame, wanted: DataFrame, layers: list[str]) -> DataFrame:
        """(layer, file): the last file that begins before a key, if it ends at the key or behind it.

        Files and keys are sorted together over range partitions; a partition's keys in
        front of its first file take the last file of the partitions before.
        """
        file = F.struct("low", "high", "file")
        files = index.select("layer", F.col("low").alias("at"), F.col("high").alias("until"), file.alias("held"))
        sought = wanted.select(
            F.explode(F.array(*map(F.lit, layers))).alias("layer"), F.col("row_key").alias("at"),
            F.lit(None).cast("string").alias("until"), F.lit(None).cast(files.schema["held"].dataType).alias("held"),
        )
        # A key sorts before the files that begin with it.
        order: list[Column] = [F.col("at"), F.col("until").asc_nulls_first()]
        both = files.unionByName(sought).repartitionByRange("layer", *order).withColumn("part", F.spark_partition_id())
        both = cut_lineage(both)
        inside = Window.partitionBy("part", "layer").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        before = Window.partitionBy("layer").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        fronts = both.groupBy("part", "layer").agg(F.max("held").alias("last")).select(
            "part", "layer", F.last("last", ignorenulls=True).over(before).alias("front"))
        placed = both.withColumn("seen", F.last("held", ignorenulls=True).over(inside)).where(F.col("held").isNull())
        met = placed.join(fronts, ["part", "layer"]).withColumn("met", F.coalesce("seen", "front"))
        return met.where(F.col("met.high") >= F.col("at")).select("layer", F.col("met.file").alias("file"))

    def cells_of(self, keys: DataFrame, key: str = "row_key") -> DataFrame:
        """Current cells of the listed keys, from the files that can hold them."""
        layers = self.layers()
        wanted = keys.select(F.col(key).alias("row_key"))
        paths = self._files_of(layers, wanted) if layers else []
        if paths is None:
            paths = layers
        if not paths:
            return self._empty()
        return _newest(self._cells(paths).join(wanted, ["row_key"], "left_semi"))

    def lookup(self, keys: DataFrame, key: str = "row_key", **options) -> DataFrame:
        """Rows of the listed keys as ``key:(qualifier,value)...`` text."""
        return lookup_cells(keys, self.cells_of(keys, key), key, **options)
