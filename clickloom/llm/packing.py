"""Best-fit packing of token sequences with a bounded number of open bins.

Every input partition tokenizes its documents and packs them on the way. A
document longer than a sequence is cut from its end into full pieces; only its
first piece may be shorter. A piece goes into the open bin with the least free
space that still holds it. Open bins are kept by free space, with one bit per
free space in a bitset, so the best fit is the lowest set bit at or above the
piece's length. At most ``open_bins`` are open: before one more opens, the
fullest closes. Pieces are placed in windows of ``window`` pieces, each from the
longest to the shortest, whatever the size of an Arrow batch.

Bins that are open at a partition's end and not nearly full (1 % free) would make
the fill depend on the layout of the input. Their pieces, at most ``open_bins``
bins a partition, are dealt to few tasks, by their number of tokens, and packed a
second time by the same rule. What is left part-filled then grows with the tokens
and not with the partitions. Packed pieces are stored before this, so no text is
tokenized twice.

With a ``position``, the windows follow the rows, the second pass takes pieces by
ranges of position, and sequences carry the mean position of their pieces and come
out in its order.

Defined cases. Null text: empty, so the end token alone. Repeated rows: each is
packed. Null ids stay null, null positions come first. Pieces of one length are
placed in row order. An empty table gives no rows. A very long text is cut on the
way, so no more than a window of its pieces is held beside its ids. Only the id,
text and position are read, so further columns may have any name. Sequence ids
hold the partition's number in the high bits, and rows are sorted before the second
pass, so a task that runs again gives the same rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import small_batches, text_of
from clickloom.session import fresh_folder

MAX_TOKENS = 1024
OPEN_BINS = 4096
WINDOW = 2_000
# In training order, pieces of one sequence are to be near each other.
ORDERED_BINS, ORDERED_WINDOW = 256, 256
# A bin with this share of its space free, or less, is as good as full.
NEARLY_FULL = 100
# Tokens that one task packs in the second pass.
TAIL_TOKENS = 1 << 23
SECOND = 1 << 62
END = 2
SCHEMA = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
PLACED = f"{SCHEMA}, place long, open boolean"


class BestFit:
    """Online best fit over bins of one capacity; a bin is only its number."""

    def __init__(self, capacity: int, open_bins: int, first: int):
        self.capacity, self.limit, self.next = capacity, open_bins, first
        self.bits = 0
        self.open = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        # Bins closed since the caller last emptied the list.
        self.closed: list[int] = []

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        chosen = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return chosen

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            free, chosen = self.capacity, self.next
            self.next += 1
        left = free - length
        if not left:
            self.closed.append(chosen)
        else:
            if self.open >= self.limit:
                # The fullest bin closes, be it this one.
                fullest = (self.bits & -self.bits).bit_length() - 1
                if left <= fullest:
                    self.closed.append(chosen)
                    return chosen, self.capacity - free
                self.closed.append(self._take(fullest))
            self.by_free[left].append(chosen)
            self.bits |= 1 << left
            self.open += 1
        return chosen, self.capacity - free


class Encoder:
    """Ids of a text as the JSON tokenizer gives them.

    The rank file holds the same merges for a faster library. A text that spells
    a special token goes to the tokenizer itself, which gives that token's id, and
    so does a text that the faster library cannot take: its pattern search gives up
    on very long runs of white space.
    """

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def _pieces(batches: Iterator[pa.RecordBatch], encoder: Encoder, end: int, max_tokens: int) -> Iterator[tuple]:
    """(doc_id, piece, start, length, ids, place) of every piece of (id, text, place) rows."""
    for batch in batches:
        for doc_id, text, place in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            tokens = np.append(encoder.ids(text), np.uint32(end)).astype("<u4", copy=False)
            at, cut = 0, len(tokens) % max_tokens or min(max_tokens, len(tokens))
            number = 0
            while at < len(tokens):
                yield doc_id, number, at, cut - at, tokens[at:cut].tobytes(), place
                at, cut, number = cut, cut + max_tokens, number + 1


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    names = ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset", "place", "open"]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)], names=names
    )


def _pack(pieces: Iterator[tuple], bins: BestFit, window: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Place pieces window by window; a bin's rows come out when it closes.

    Bins that are open at the end are marked, unless they are nearly full or this is the ``last`` pass.
    """
    held: dict[int, list[tuple]] = {}
    ready: list[tuple] = []

    def finish(chosen: int, is_open: bool) -> None:
        rows = held.pop(chosen)
        places = [p[5] for p, _ in rows if p[5] is not None]
        place = None if len(places) < len(rows) else sum(places) // len(places)
        for p, offset in rows:
            # A piece that is packed again keeps its own place.
            ready.append((*p[:5], chosen, offset, p[5] if is_open else place, is_open))

    while some := list(islice(pieces, window)):
        for p in sorted(some, key=lambda p: -p[3]):
            chosen, offset = bins.place(p[3])
            held.setdefault(chosen, []).append((p, offset))
            for closed in bins.closed:
                finish(closed, False)
            bins.closed.clear()
        if len(ready) >= WINDOW:
            yield _table(ready)
            ready = []
    for chosen in list(held):
        free = bins.capacity - sum(p[3] for p, _ in held[chosen])
        finish(chosen, not last and free * NEARLY_FULL > bins.capacity)
        if len(ready) >= WINDOW:
            yield _table(ready)
            ready = []
    if ready:
        yield _table(ready)


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, end: int = END,
         max_tokens: int = MAX_TOKENS, open_bins: int | None = None, doc_id: str = "doc_id", text: str = "text",
         position: Column | None = None, window: int | None = None) -> DataFrame:
    """One row per piece: its ids (little-endian unsigned 32 bit), sequence and offset.

    With ``position``, a column of integers, there is one more column ``position``, that
    of the sequence, and rows are sorted by it.
    """
    small_batches(docs.sparkSession)
    ordered = position is not None
    open_bins = open_bins or (ORDERED_BINS if ordered else OPEN_BINS)
    window = window or (ORDERED_WINDOW if ordered else WINDOW)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"),
        (position if ordered else F.lit(None)).cast("long").alias("place"),
    )

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(max_tokens, open_bins, TaskContext.get().partitionId() << 36)
        yield from _pack(_pieces(batches, Encoder(tokenizer, ranks, pattern), end, max_tokens), bins, window, False)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(max_tokens, open_bins, SECOND | TaskContext.get().partitionId() << 36)
        yield from _pack(_stored(batches), bins, window, True)

    # Ids are four bytes of which two are mostly zero.
    folder = fresh_folder(docs.sparkSession, "pieces")
    rows.mapInArrow(first, PLACED).write.option("compression", "zstd").parquet(folder)
    placed = docs.sparkSession.read.schema(PLACED).parquet(folder)
    tail = placed.where("open")
    tokens = tail.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-tokens // TAIL_TOKENS))
    if ordered:
        dealt = tail.repartitionByRange(tasks, "place", "sequence_id", "offset").sortWithinPartitions(
            "place", "sequence_id", "offset")
    else:
        dealt = tail.repartition(tasks, "sequence_id").sortWithinPartitions(F.desc("length"), "sequence_id", "offset")
    columns = ["doc_id", "piece", "start", "length", "ids", "place"]
    again = dealt.select(*columns).mapInArrow(second, PLACED)
    packed = placed.where("not open").unionByName(again).drop("open")
    if not ordered:
        return packed.drop("place")
    return packed.withColumnRenamed("place", "position").orderBy("position", "sequence_id", "offset")
