"""The stored cell table: against one upsert over everything, by files opened and bytes written."""

import random

import pytest
from pyspark.sql import functions as F

from clickloom.sources import cell_table, cells

SCHEMA = cell_table.CELLS


def _draw(seed, n, keys):
    draw = random.Random(seed)
    return [(f"k{draw.randrange(keys):04d}", draw.choice("fg"), draw.choice("abc"), f"{seed}-{i}", draw.randrange(3))
            for i in range(n)]


def _rows(df):
    return {tuple(r) for r in df.select("row_key", "family", "qualifier", "value", "version").collect()}


def _model(layers):
    """Last write by version, then by layer, then by value."""
    best = {}
    for at, rows in enumerate(layers):
        for key, family, qualifier, value, version in rows:
            if key is not None:
                cell, mark = (key, family, qualifier), (version, at, value)
                best[cell] = max(best.get(cell, mark), mark)
    return {(*cell, value, version) for cell, (version, _, value) in best.items()}


def test_layers_and_compaction_keep_the_last_write(spark, folder):
    table = cell_table.CellTable(spark, folder + "/t", files=4, max_layers=3)
    assert table.read().count() == 0
    assert table.lookup(spark.createDataFrame([("k",)], "row_key string")).count() == 0
    layers = []
    for seed in range(5):
        layers.append(_draw(seed, 60, 25) + [(None, "f", "a", "no key", 9)])
        table.upsert(spark.createDataFrame(layers[-1], SCHEMA))
        assert _rows(table.read()) == _model(layers)
    # The fourth upsert folded the table.
    assert len(table.layers()) == 2
    table.compact()
    assert len(table.layers()) == 1 and _rows(table.read()) == _model(layers)


def test_lookup_opens_the_files_of_its_keys_only(spark, folder):
    table = cell_table.CellTable(spark, folder + "/t", files=64)
    rows = spark.range(20_000).select(
        F.format_string("k%06d", "id").alias("row_key"), F.lit("f").alias("family"), F.lit("a").alias("qualifier"),
        F.col("id").cast("string").alias("value"), F.lit(1).cast("long").alias("version"))
    table.upsert(rows)
    ids = random.Random(1).sample(range(20_000), 10)
    keys = spark.createDataFrame([(f"k{i:06d}",) for i in ids] + [("a",), ("k0000005",), ("z",), (None,)], "row_key string")
    found = table.cells_of(keys)
    assert {(r.row_key, r.value) for r in found.collect()} == {(f"k{i:06d}", str(i)) for i in ids}
    assert len(spark.read.parquet(f"{folder}/t/cells/*").inputFiles()) >= 60
    assert len(found.inputFiles()) <= 12


@pytest.mark.parametrize("parts", ["1", "9"])
def test_every_key_is_found_whatever_the_partitions(spark, folder, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        table = cell_table.CellTable(spark, folder + "/t", files=16)
        # A row of many cells lies in several files, all of which begin or end with its key.
        wide = [("k0010", "f", f"q{i:03d}", str(i), 1) for i in range(300)]
        layers = [_draw(1, 200, 60) + wide, _draw(2, 80, 60)]
        for rows in layers:
            table.upsert(spark.createDataFrame(rows, SCHEMA))
        for step in (1, 7):
            names = [f"k{i:04d}" for i in range(0, 60, step)]
            got = _rows(table.cells_of(spark.createDataFrame([(k,) for k in names], "key string"), "key"))
            assert got == {c for c in _model(layers) if c[0] in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_hits_read_whole_layers(spark, folder, monkeypatch):
    monkeypatch.setattr(cell_table, "MAX_OPEN", 2)
    table = cell_table.CellTable(spark, folder + "/t", files=8)
    rows = _draw(3, 200, 50)
    table.upsert(spark.createDataFrame(rows, SCHEMA))
    keys = spark.createDataFrame([(f"k{i:04d}",) for i in range(50)], "row_key string")
    assert table._files_of(table.layers(), keys) is None and _rows(table.cells_of(keys)) == _model([rows])


def test_an_upsert_writes_as_much_as_it_changes(spark, folder):
    def written(n):
        table = cell_table.CellTable(spark, f"{folder}/t{n}")
        table.upsert(spark.range(n).select(
            F.col("id").cast("string").alias("row_key"), F.lit("f").alias("family"), F.lit("a").alias("qualifier"),
            F.col("id").cast("string").alias("value"), F.lit(1).cast("long").alias("version")))
        table.upsert(spark.createDataFrame([(str(i), "f", "a", "new", 2) for i in range(10)], SCHEMA))
        path = table._path(f"{folder}/t{n}/cells/{table.layers()[-1]}")
        return table._fs.getContentSummary(path).getLength()

    assert written(100_000) <= 1.1 * written(1_000)


def test_a_reader_in_the_middle_of_a_step_sees_one_state(spark, folder, monkeypatch):
    table = cell_table.CellTable(spark, folder + "/t", files=2)
    layers = [_draw(1, 40, 10), _draw(2, 40, 10)]
    for rows in layers:
        table.upsert(spark.createDataFrame(rows, SCHEMA))
    reading = table.read()
    with monkeypatch.context() as patch:
        # The folded layer is written, its state is not.
        patch.setattr(table, "_commit", lambda names: None)
        table.compact()
        table.upsert(spark.createDataFrame(_draw(3, 40, 10), SCHEMA))
    assert len(table.layers()) == 2 and _rows(table.read()) == _model(layers)
    # A state that was not written to its end does not count.
    table._fs.mkdirs(table._path(f"{folder}/t/states/state.{99:012d}"))
    assert _rows(table.read()) == _model(layers)
    table.compact()
    # A plan made before the compaction still finds its layers, until they expire.
    assert _rows(reading) == _model(layers)
    table.expire()
    assert _rows(table.read()) == _model(layers) and len(table._states()) == 1


def test_the_second_of_two_writers_fails(spark, folder, monkeypatch):
    one = cell_table.CellTable(spark, folder + "/t", files=2)
    one.upsert(spark.createDataFrame(_draw(1, 10, 5), SCHEMA))
    states = one._states()
    one.upsert(spark.createDataFrame(_draw(2, 10, 5), SCHEMA))
    two = cell_table.CellTable(spark, folder + "/t", files=2)
    monkeypatch.setattr(two, "_states", lambda: states)
    with pytest.raises(Exception, match="(?i)exist"):
        two.upsert(spark.createDataFrame(_draw(3, 10, 5), SCHEMA))
    assert _rows(one.read()) == _model([_draw(1, 10, 5), _draw(2, 10, 5)])


def test_a_lookup_renders_like_the_plain_one(spark, folder):
    rows = spark.createDataFrame(_draw(4, 50, 10), SCHEMA)
    table = cell_table.CellTable(spark, folder + "/t", files=3)
    table.upsert(rows)
    keys = spark.createDataFrame([("k0001",), ("k0002",), ("k0001",)], "row_key string")
    plain = cells.lookup_cells(keys, cells.upsert_cells(rows.limit(0), rows))
    assert sorted(table.lookup(keys).collect()) == sorted(plain.collect())
