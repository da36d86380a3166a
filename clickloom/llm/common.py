"""What several corpus operators share: words, row numbers, bounded joins, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.session import cut_lineage

# Fixed value: the characters that separate words, [\x20\x09-\x0D].
SPACE = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"

# A group is hot once it holds this share of all rows; so at most 1,000 groups are hot.
HOT_SHARE = 1_000


def text_of(text: str | Column = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit(""))


def free_name(name: str, *tables: DataFrame) -> str:
    """``name``, with as many underscores behind as it takes to clash with no column, whatever its case."""
    taken = {c.lower() for table in tables for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(rows: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    """``rows`` with their place from 1 among those of equal ``keys``.

    A key may hold any share of the rows, so no task counts a whole key. Rows are
    range-partitioned by key and order and stored; the counts of the ranges in
    front of a row and its place in its own range give its place.
    """
    part, row, front, inside, n = (free_name(x, rows) for x in ("part__", "row__", "front__", "inside__", "n__"))
    rows = rows.withColumn(row, F.monotonically_increasing_id())
    order = [*order, F.asc(row)]
    ranged = cut_lineage(rows.repartitionByRange(*keys, *order).withColumn(part, F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    fronts = ranged.groupBy(*keys, part).agg(F.count("*").alias(n)).select(
        *[F.col(k).alias(f"{front}{i}") for i, k in enumerate(keys)], F.col(part).alias(f"{front}p"),
        F.coalesce(F.sum(n).over(before), F.lit(0)).alias(front),
    )
    same = F.col(part) == F.col(f"{front}p")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"{front}{i}"))
    placed = ranged.withColumn(inside, F.row_number().over(Window.partitionBy(*keys, part).orderBy(*order)))
    kept = [c for c in rows.columns if c != row]
    return placed.join(fronts, same).select(*kept, (F.col(front) + F.col(inside)).alias(out))


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Their Python then finds it whatever the driver's import path is.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="clickloom-code-")), "clickloom_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def small_batches(spark: SparkSession, rows: int = 2_000, mb: int = 32) -> None:
    """Bound what one Arrow batch of long texts holds, for this session."""
    ship_code(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def crc_of(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def stored_order(rows: DataFrame) -> Column:
    """A long that follows the order in which a stored table was written.

    Spark numbers the files of a write by partition (``part-00012-...-c000``); that
    number, the file's own count and the row's place in its file give the order, however
    the files are dealt to tasks when they are read. Rows that come from no file take
    the order in which they lie.
    """
    try:
        file = rows.metadataColumn("_metadata")
        rows.select(file["row_index"]).schema  # noqa: B018 - resolved here, so that what follows is
    except AnalysisException:
        return F.monotonically_increasing_id()
    number = [F.coalesce(F.regexp_extract(file["file_name"], mark, 1).try_cast("long"), F.lit(0))
              for mark in (r"^part-(\d+)", r"-c(\d+)")]
    return F.shiftleft(number[0], 40) + F.shiftleft(number[1], 30) + file["row_index"]


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of rows to one row per group, where a few groups may hold most rows.

    ``size`` of ``groups`` is the number of rows of each group. Groups above
    1/1,000 of all rows number fewer than 1,000 and are broadcast, so that
    their rows stay where they are; all others join by a shuffle in which no
    key is large. Both inputs are read twice and should be stored tables.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    least = max(1, -(-total // HOT_SHARE))
    hot = groups.where(F.col(size) > least)
    cold = groups.where(F.col(size) <= least)
    listed = F.broadcast(hot)
    near = rows.join(listed, key)
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return near.unionByName(far)


def bounded_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """The ``limit`` rows with the least hash of ``key``: the same rows in each run.

    Meant for narrow rows; the result is small enough to broadcast.
    """
    return rows.orderBy(F.xxhash64(key), key).limit(limit)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, limit: int,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, label) of at most ``limit`` labelled documents.

    Ids are drawn from the narrow label table first, so the texts of all other
    documents are left where they are. Rows without id or label do not take
    part; of several labels of one id the largest counts.
    """
    usable = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & may_learn)
    id_, label_ = free_name("id__", docs), free_name("label__", docs)
    drawn = bounded_sample(
        usable.groupBy(F.col(doc_id).alias(id_)).agg(F.max(label).cast("int").alias(label_)), id_, limit
    )
    return docs.join(F.broadcast(drawn), F.col(doc_id) == F.col(id_)).select(
        text_of(text).alias("text"), F.col(label_).alias("label")
    )
