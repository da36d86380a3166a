"""A side table that follows the newest snapshot while a stream runs."""

from __future__ import annotations

import logging
from collections import deque
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession

from clickloom.sources.snapshots import list_snapshots

log = logging.getLogger(__name__)


# What a snapshot that is missing, half written or of another format raises when it is read.
READ_ERRORS = (AnalysisException, FileNotFoundError)
_FILE_WORDS = ("FAILED_READ_FILE", "CANNOT_READ_FILE", "PATH_NOT_FOUND", "FileNotFoundException", "does not exist",
               "is not a Parquet file", "UNABLE_TO_INFER_SCHEMA")


def is_read_error(error: Exception) -> bool:
    """Whether an error is about files; anything else is none of a side table's business."""
    return isinstance(error, READ_ERRORS) or (
        isinstance(error, (PySparkException, Py4JError)) and any(word in str(error) for word in _FILE_WORDS)
    )


class RefreshingTable:
    """Newest usable snapshot, looked for anew on each call.

    A snapshot is usable when it can be read and has more than ``min_rows``
    rows; that holds for the first one too. The last ``keep`` usable ones are
    remembered: when the newest cannot be read any more, the one before is
    taken, and so on.
    """

    def __init__(self, spark: SparkSession, folder: str, prefix: str, min_rows: int = 10, fmt: str = "parquet",
                 keep: int = 3):
        self.spark = spark
        self.folder = folder
        self.prefix = prefix
        self.min_rows = min_rows
        self.fmt = fmt
        self.ring: deque[str] = deque(maxlen=keep)

    @property
    def path(self) -> str | None:
        return self.ring[-1] if self.ring else None

    def _usable(self, path: str) -> bool:
        """Counts no further than needed."""
        try:
            return self.spark.read.format(self.fmt).load(path).limit(self.min_rows + 1).count() > self.min_rows
        except Exception as error:
            if not is_read_error(error):
                raise
            log.warning("%s cannot be read: %s", path, error)
            return False

    def current(self) -> DataFrame:
        while self.ring and not self._usable(self.ring[-1]):
            log.warning("%s is gone, going back", self.ring.pop())
        try:
            found = list_snapshots(self.spark, self.folder, self.prefix)
        except Exception as error:
            # A folder that cannot be listed must not stop the stream.
            if not is_read_error(error):
                raise
            log.warning("keeping %s: %s", self.path, error)
            found = []
        # With a table at hand only the newest one matters.
        for path in found[: 1 if self.ring else None]:
            if path not in self.ring and self._usable(path):
                self.ring.append(path)
                break
        if not self.ring:
            raise FileNotFoundError(f"no usable snapshot {self.prefix}* in {self.folder}")
        return self.spark.read.format(self.fmt).load(self.ring[-1])

    def dismiss(self, path: str) -> None:
        """Forget a snapshot that vanished while it was read."""
        if path in self.ring:
            self.ring.remove(path)


def run_with_side_table(stream: DataFrame, side: RefreshingTable, on: Sequence[str], path: str, checkpoint: str,
                        how: str = "left") -> None:
    """Join every micro-batch to the side table of the moment; process what is available.

    Each batch replaces its own ``batch`` directory, so a repeated batch leaves
    no duplicates.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        for _ in range(side.ring.maxlen + 1):
            table, used = side.current(), side.path
            try:
                batch.join(table, list(on), how).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
                return
            except Exception as error:
                # Only a snapshot that is gone by now is to blame; the batch goes on with the one before.
                if not is_read_error(error) or side._usable(used):
                    raise
                side.dismiss(used)
        raise FileNotFoundError(f"no snapshot of {side.folder} lasts for a batch")

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
