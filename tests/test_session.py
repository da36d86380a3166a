import pathlib
import time

import pytest

from pyspark.sql import functions as F

from clickloom import session
from clickloom.operators import metrics
from clickloom.plans import recommend, sites
from clickloom.queries import QUERIES


class FakeContext:
    """A context without any configured folder."""

    def __init__(self, master):
        self.master = master
        self.folder = None

    def getConf(self):  # noqa: N802
        return {}

    def getCheckpointDir(self):  # noqa: N802
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder


class FakeSession:
    def __init__(self, master):
        self.sparkContext = FakeContext(master)
        self.conf = {}


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1000]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        session.checkpoint_root(FakeSession(master))


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_a_local_master_gets_its_own_folder(master):
    fake = FakeSession(master)
    assert session.checkpoint_root(fake) == session.checkpoint_root(fake) != ""


def test_stages_can_be_discarded_but_nothing_else(spark, tmp_path):
    folder = session.fresh_folder(spark, "stage")
    assert session.cut_lineage(spark.range(5), folder).count() == 5
    session.discard(spark, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)
    with pytest.raises(ValueError):
        session.discard(spark, str(tmp_path))


def test_shuffle_files_go_once_a_stage_is_stored(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {f for d in dirs for f in pathlib.Path(str(d)).rglob("shuffle_*.data")}
    before, option = files(), next(iter(session.DROP_SHUFFLES))
    setting = spark.conf.get(option, None)
    shuffled = spark.range(1_000).repartition(3, "id")
    stored = session.cut_lineage(shuffled)
    until = time.time() + 30
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(option, None) == setting
    # The plan itself can run again.
    assert shuffled.count() == stored.count() == 1_000


def test_only_stages_that_are_still_read_stay(spark):
    with session.own_stages(spark) as outer:
        first = session.cut_lineage(spark.range(4))
        with session.own_stages(spark) as inner:
            second, third = session.cut_lineage(first), session.cut_lineage(spark.range(2))
            inner.keep(second.join(first, ["id"]))
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
            third.collect()
        outer.keep(second)
    assert second.count() == 4
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        first.collect()
    with pytest.raises(KeyError), session.own_stages(spark):
        fourth = session.cut_lineage(spark.range(3))
        raise KeyError
    assert fourth.count() == 3 and session._SCOPE.get() is None


def test_small_tasks_leave_the_session_as_it_was(spark):
    names = [*session.SMALL_TASKS, "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(n) for n in names]
    with pytest.raises(KeyError), session.small_tasks(spark):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= session.MOST_PARTITIONS
        raise KeyError
    assert [spark.conf.get(n) for n in names] == before


@pytest.mark.parametrize("step", ["pairs", "query", "group", "strong", "adjacency", "histogram"])
def test_steps_that_hold_groups_do_not_depend_on_the_session_partitions(spark, monkeypatch, tmp_path, step):
    # Tasks of 20 KB instead of 8 MB: the stored result lies in many more files than the session has partitions.
    monkeypatch.setitem(session.SMALL_TASKS, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    monkeypatch.setitem(session.SMALL_TASKS, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    monkeypatch.setattr(session, "MOST_PARTITIONS", 50)
    rows = spark.range(30_000).select(
        F.lit("d").alias("day"), F.expr("id div 3").alias("u"), F.lit("g").alias("g"), F.xxhash64("id").alias("item"))
    lines = rows.select(F.col("u").alias("l_orderkey"), F.col("item").alias("l_suppkey"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        stored = {
            "pairs": lambda: sites.site_pairs(rows, "u", "item", keys=["day"]),
            "query": lambda: QUERIES["pair_counts"](spark, str(tmp_path)),
            "group": lambda: recommend.group_pair_counts(rows, "day", "u", "g", "item"),
            "strong": lambda: sites.scored_neighbours(sites.site_pairs(rows, "u", "item"), 0, 1),
            "adjacency": lambda: metrics.adjacency_lines(rows.withColumn("n", F.lit(1)), "u", "item", "n"),
            "histogram": lambda: metrics.category_histogram(rows, "u", "item"),
        }[step]()
        assert len(stored.inputFiles()) > 4 and stored.count() >= 10_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
