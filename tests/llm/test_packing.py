import random
import zlib
from collections import defaultdict

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import packing
from clickloom.llm.common import stored_order
from clickloom.llm.production import TOKENIZER


def test_pieces_are_whole_and_sequences_gapless(spark):
    docs = cases.edge_docs(spark)
    rows = packing.pack(docs, **TOKENIZER).collect()
    slow = Tokenizer.from_file(TOKENIZER["tokenizer"])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in {r[0]: r[1] for r in cases.edge_rows() if r[0] not in (None, 12)}.items():
        ids = [*slow.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        joined = b"".join(bytes(p.ids) for p in pieces)
        assert joined == np.array(ids, "<u4").tobytes()
        assert all(p.length == 1024 for p in pieces[1:]) and len(pieces) == -(-len(ids) // 1024)
        assert [p.start for p in pieces] == np.cumsum([0, *[p.length for p in pieces]])[:-1].tolist()
    assert len(by_doc[12]) == 2 and len(by_doc[None]) == 2
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(cases.edge_docs(spark, empty=True), **TOKENIZER).count() == 0


def test_a_special_token_in_a_text_is_that_token():
    encoder = packing.Encoder(**TOKENIZER)
    slow = Tokenizer.from_file(TOKENIZER["tokenizer"])
    for text in ("a <|endoftext|> b", "plain text", "  x\n\ny ", "中文\U0001F600"):
        assert encoder.ids(text).tolist() == slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("mark", [" ", "\n"])
def test_a_run_of_white_space_of_any_length_is_encoded(mark):
    text = "x" + mark * 2_000_000 + "y"
    encoder = packing.Encoder(**TOKENIZER)
    slow = Tokenizer.from_file(TOKENIZER["tokenizer"])
    assert encoder.ids(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = packing.BestFit(10, 8, 0)
    assert [bins.place(n) for n in (6, 7, 3, 4, 10, 1)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0)]
    few = packing.BestFit(10, 2, 0)
    # The third bin closes the first, which would have held the piece of 2 best.
    assert [few.place(n)[0] for n in (8, 7, 6, 2, 3, 4)] == [0, 1, 2, 1, 2, 3]
    draw = random.Random(2)
    sizes = [draw.randint(1, 1024) for _ in range(5_000)]
    bounded = packing.BestFit(1024, 64, 0)
    used = len({bounded.place(n)[0] for n in sizes})
    assert used <= 1.05 * sum(sizes) / 1024 + 64


def test_crc_is_of_little_endian_words():
    assert zlib.crc32(np.array([1, 2], "<u4").tobytes()) == zlib.crc32(b"\1\0\0\0\2\0\0\0")


@pytest.mark.parametrize("partitions", [1, 64, 256])
def test_the_fill_does_not_follow_the_layout(spark, partitions):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = packing.pack(docs.repartition(partitions, "doc_id"), **TOKENIZER).select(
        "doc_id", "piece", "length", "sequence_id", "offset").collect()
    least = -(-sum(r.length for r in rows) // 1024)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert len(sequences) <= 1.02 * least
    for places in sequences.values():
        places.sort()
        ends = np.cumsum([n for _, n in places]).tolist()
        assert [at for at, _ in places] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows) and {r.doc_id for r in rows} == {
        r.doc_id for r in docs.select("doc_id").collect()}


def test_the_batch_size_of_the_session_does_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").coalesce(1)
    key, got = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    for size in ("7", "2000"):
        spark.conf.set(key, size)
        got.append(sorted(packing.pack(docs, **TOKENIZER).select("doc_id", "piece", "sequence_id", "offset").collect()))
    spark.conf.set(key, before)
    assert got[0] == got[1]


def test_sequences_follow_the_position_of_a_stored_table(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    # Files of unlike size, which Spark reads in another order than it wrote them.
    order = docs.withColumn("_metadata", F.xxhash64("doc_id"))
    order.repartitionByRange(7, "_metadata").sortWithinPartitions("_metadata").write.parquet(f"{folder}/docs")
    stored = spark.read.parquet(f"{folder}/docs")
    rows = packing.pack(stored, **TOKENIZER, position=stored_order(stored)).select(
        "doc_id", "piece", "position", "sequence_id").collect()
    places = [r.position for r in rows]
    assert places == sorted(places)
    wanted = {r.doc_id: i for i, r in enumerate(stored.orderBy("_metadata").select("doc_id").collect())}
    first = [wanted[r.doc_id] for r in rows if r.piece == 0]
    assert len(first) == len(wanted)
    assert np.corrcoef(first, np.arange(len(first)))[0, 1] > 0.9
    least = -(-sum(r.length for r in packing.pack(stored, **TOKENIZER).select("length").collect()) // 1024)
    assert len({r.sequence_id for r in rows}) <= 1.02 * least


def test_order_of_rows_from_no_file(spark):
    rows = cases.edge_docs(spark).coalesce(1)
    places = [r.p for r in rows.select(stored_order(rows).alias("p")).collect()]
    assert places == sorted(places) and len(set(places)) == len(places)
