import hashlib
from collections import defaultdict

import cases
import numpy as np
import pytest

from clickloom.llm import exact_dedup


def squeeze(text):
    return "".join(c for c in (text or "") if c not in "\t\n\x0b\x0c\r ")


def test_perfect_hash_is_minimal_and_rejects_strangers():
    make = lambda tag, n: np.frombuffer(
        b"".join(hashlib.sha256(f"{tag}{i}".encode()).digest() for i in range(n)), "<u8"
    ).reshape(-1, 4)
    for n in (0, 1, 2, 5_000):
        held, others = make("in", n), make("out", 500)
        sizes, bits, slots = exact_dedup.build_hash(held)
        assert sorted(slots.tolist()) == list(range(n))
        assert (exact_dedup.find_slots(held, sizes, bits) == slots).all()
        table = np.empty_like(held)
        table[slots] = held
        found = exact_dedup.find_slots(others, sizes, bits)
        assert not any((table[s] == o).all() for s, o in zip(found, others, strict=True) if s >= 0)


@pytest.mark.parametrize("bucket", [50_000, 2])
def test_against_plain_grouping(spark, monkeypatch, bucket):
    monkeypatch.setattr(exact_dedup, "BUCKET_DIGESTS", bucket)
    docs = cases.edge_docs(spark)
    got = exact_dedup.dedupe(exact_dedup.digest_rows(docs), exact_dedup.first_half()).collect()
    assert len(got) == len(cases.edge_rows())
    groups = defaultdict(list)
    for row in cases.edge_rows():
        groups[hashlib.sha256(squeeze(row[1]).encode()).digest()].append((-len(row[1] or ""), row[0] is None, row[0]))
    kept = defaultdict(int)
    for r in got:
        members = groups[bytes(r.digest)]
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        assert (r.group_size, r.keep_id) == (len(members), best[2])
        kept[bytes(r.digest)] += r.kept
    assert set(kept.values()) == {1}


def test_every_choice_of_history_gives_the_same(spark):
    from pyspark.sql import functions as F

    rows = exact_dedup.digest_rows(cases.edge_docs(spark))
    results = []
    for history in (F.lit(True), F.lit(False), exact_dedup.first_half(), F.col("doc_id") > 5):
        judged = exact_dedup.dedupe(rows, F.coalesce(history, F.lit(False)))
        results.append(sorted(map(tuple, judged.select("row", "keep_row", "group_size", "kept").collect())))
    assert all(r == results[0] for r in results)


def test_a_large_batch_without_history_is_dealt(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup, "BUCKET_DIGESTS", 2)
    dealt, probe = [], exact_dedup.probe
    monkeypatch.setattr(exact_dedup, "probe", lambda index, batch, n: dealt.append(n) or probe(index, batch, n))
    judged = exact_dedup.dedupe(exact_dedup.digest_rows(cases.edge_docs(spark)), F.lit(False))
    assert judged.count() == len(cases.edge_rows())
    assert dealt == [-(-len(cases.edge_rows()) // 2)]


def test_drop_copies_keeps_one_row_and_all_columns(spark):
    docs = cases.edge_docs(spark)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [squeeze(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({squeeze(r[1]) for r in cases.edge_rows()})
    assert {r.doc_id for r in kept.collect()} >= {3, 7, 8}  # most code points stay
    assert exact_dedup.drop_copies(cases.edge_docs(spark, empty=True)).count() == 0


def test_any_column_name(spark):
    from clickloom.llm import near_dedup

    names = ["id__", "hash__", "points__", "own_id__", "OWN_HASH__", "own_points__", "n__", "kept__", "__id", "__doc"]
    schema = "doc_id long, text string, " + ", ".join(f"{n} int" for n in names)
    docs = spark.createDataFrame([(i, t, *range(len(names))) for i, t in enumerate(["a b", "ab", "c d e f", "c  d e f"])], schema)
    for keep in (exact_dedup.drop_copies, near_dedup.drop_near_duplicates):
        kept = keep(docs)
        assert kept.columns == docs.columns and {tuple(r[2:]) for r in kept.collect()} == {tuple(range(len(names)))}
