"""Time-varying curriculum: mix sources to target weights and give each document its training position.

A source's target comes from its share of a word budget, filled up like water:
no target exceeds ``max_passes`` times the source's words, and what is cut off
goes to the other sources by weight. Inside a source, documents are ordered by
a hash of id and text. A source is passed over ``target / size`` times: whole
passes take every document, the last one those up to a cutoff key, found where
the running sum of words meets the rest of the target (within half a document).
Rows that repeat share a key; of those at the cutoff as many are taken as the rest
asks for, by a number that is given to these rows alone.

Each source also has a weight schedule over the training time 0..1, a straight
line from ``start`` to ``end``. Its integral, scaled to the target, is the
words that the source has supplied by a time; its inverse turns the place of a
document in its source (words in front of it) into a position. Places inside
one of 256 key ranges are interpolated. Range-sorting by position gives the
training order, and a document's places in it its row numbers there, one per pass.

Everything that is not per document is one row per source, so that a document
needs one join on ``source``; Spark broadcasts that table if it is small and
splits a hot source's rows if it is not.

Defined cases. Null text: size 0. Null source: a source of its own, ranked
last. Null id: hashed as null. Of repeated rows at the cutoff some are taken once
more, in the order of a hash of the whole row. A source without words has target 0 and is not passed over. An empty table gives
an empty result. The operator adds one struct column and leaves others alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import WORD, free_name, numbered, text_of
from clickloom.session import cut_lineage

WEIGHTS = (3.0, 1.0, 2.0)
# Schedule (weight at the start, weight at the end) of the sources of each weight.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
BUDGET = 1.5
MAX_PASSES = 2

# Keys have 63 bits. The cutoff is searched in 4,096 ranges, places are kept for 256.
_FINE_SHIFT, _COARSE_SHIFT, _COARSE = 51, 55, 256


def size_of(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def key_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The place of a document in its source's order: 63 bits, the same in each run."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, text), 1)


def fill_targets(sources: DataFrame, budget: float, max_passes: int) -> DataFrame:
    """Add ``target`` to one row per source (``weight``, ``source_size``).

    Each round reads one row of sums; a source that meets its cap stays there,
    so the level only rises and the rounds end.
    """
    level = 0.0
    cap = F.col("source_size") * max_passes
    while True:
        open_ = cap > F.col("weight") * level
        capped, weight = sources.agg(
            F.sum(F.when(~open_, cap).otherwise(0)), F.sum(F.when(open_, F.col("weight")))
        ).first()
        if not weight:
            break
        higher = (budget - capped) / weight
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * level))


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: tuple = WEIGHTS, schedules: tuple = SCHEDULES, budget: float = BUDGET,
             max_passes: int = MAX_PASSES) -> DataFrame:
    """One stored row per source: targets, passes, cutoff key, schedule and places by key range."""
    sizes = cut_lineage(docs.select(
        F.col(source).alias("source"), size_of(text).alias("size"), key_of(doc_id, text).alias("key"),
    ))
    ranges = cut_lineage(
        sizes.groupBy("source", F.shiftright("key", _FINE_SHIFT).alias("fine")).agg(F.sum("size").alias("words"))
        .withColumn("front", F.sum("words").over(
            Window.partitionBy("source").orderBy("fine").rowsBetween(Window.unboundedPreceding, -1)
        )).fillna(0, ["front"])
    )
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    turn = (rank % len(weights)).cast("int")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("turn") + 1)
    sources = cut_lineage(
        ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
        .withColumn("turn", turn).withColumn("weight", pick([float(w) for w in weights]))
        .withColumn("start", pick([float(a) for a, _ in schedules]))
        .withColumn("end", pick([float(b) for _, b in schedules])).drop("turn")
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    targets = fill_targets(sources, budget * total, max_passes)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("passes", passes.cast("int")).withColumn(
        "rest", F.col("target") - F.col("passes") * F.col("source_size")
    )

    same = F.col("s.source").eqNullSafe(F.col("r.source"))
    edge = targets.alias("s").join(ranges.alias("r"), same).where(
        (F.col("front") < F.col("rest")) & (F.col("rest") <= F.col("front") + F.col("words"))
    ).select("s.source", "rest", "fine", "front")
    # Rows of one key are counted first: a pile of copies is one row.
    keys = sizes.alias("d").join(
        edge.alias("e"),
        F.col("d.source").eqNullSafe(F.col("e.source")) & (F.shiftright("key", _FINE_SHIFT) == F.col("fine")),
    ).groupBy("e.source", "key", "rest", "fine", "front").agg(
        F.sum("size").alias("words"), F.count("*").alias("copies")
    )
    running = F.sum("words").over(Window.partitionBy("source").orderBy("key")) - F.col("words")
    # The j-th copy is taken while its middle, (j - 1/2) of its words from the first one, is within the rest.
    places = F.floor((F.col("rest") - F.col("front") - F.col("before")) * F.col("copies") / F.col("words") + 0.5)
    fitting = F.when(F.col("words") > 0, F.greatest(F.lit(0), F.least(places, F.col("copies")))).otherwise(
        F.when(F.col("front") + F.col("before") <= F.col("rest"), F.col("copies")).otherwise(0)
    )
    inside = keys.withColumn("before", running).withColumn("taken", fitting.cast("long"))
    # Where no document of the range fits, the cutoff lies in front of it.
    last = F.max(F.when(F.col("taken") > 0, F.struct("key", "taken", "copies")))
    cutoffs = inside.groupBy("source").agg(last.alias("last"), F.min("fine").alias("fine")).select(
        "source", F.coalesce("last.key", F.shiftleft("fine", _FINE_SHIFT) - 1).alias("cutoff"),
        F.coalesce("last.taken", F.lit(0)).alias("cut_taken"), F.coalesce("last.copies", F.lit(0)).alias("cut_copies"),
    )

    coarse = F.shiftright("fine", _COARSE_SHIFT - _FINE_SHIFT).cast("int")
    places = ranges.groupBy("source", coarse.alias("range")).agg(
        F.min("front").alias("front"), F.sum("words").alias("words")
    ).groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("range", F.struct("front", "words")))).alias("m"))
    places = places.select("source", F.transform(
        F.sequence(F.lit(0), F.lit(_COARSE - 1)), lambda i: F.col("m")[i]
    ).alias("places"))
    return cut_lineage(
        targets.alias("s").drop("rest")
        .join(cutoffs.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")), "left")
        .join(places.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")), "left")
        .select("s.*", F.coalesce("cutoff", F.lit(-1)).alias("cutoff"), F.coalesce("cut_taken", F.lit(0)).alias("cut_taken"),
                F.coalesce("cut_copies", F.lit(0)).alias("cut_copies"), "places")
    )


def _position(place: Column, plan: Column) -> Column:
    """Training time at which a source has supplied ``place`` words: the inverse of its integrated schedule."""
    share = F.least(place / plan["target"], F.lit(1.0))
    a, b = plan["start"], plan["end"]
    bend = b - a
    root = F.sqrt(a * a + bend * (a + b) * share)
    return F.when(F.abs(bend) < 1e-9, share).otherwise((root - a) / bend)


def mix(docs: DataFrame, plan: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        column: str = "mix") -> DataFrame:
    """``docs`` with a struct of size, source_size, target, passes, taken and positions (one per pass)."""
    names = [free_name(x, docs) for x in ("plan__", "key__", "size__", "copy__", "hash__")]
    held, key, size, copy, code = names
    per_source = plan.select(F.struct("*").alias(held))
    joined = docs.join(per_source, F.col(source).eqNullSafe(F.col(held)["source"]), "left")
    p = F.col(held)
    prepared = joined.withColumn(key, key_of(doc_id, text)).withColumn(size, size_of(text))
    if plan.where("cut_taken < cut_copies").isEmpty():
        prepared = prepared.withColumn(copy, F.lit(0).cast("long"))
    else:
        # Only rows at such a cutoff are numbered.
        at_cutoff = F.coalesce((F.col(key) == p["cutoff"]) & (p["cut_taken"] < p["cut_copies"]), F.lit(False))
        whole = F.xxhash64(*[F.col(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
        piles = prepared.where(at_cutoff).withColumn(code, whole).withColumn(f"{code}s", p["source"])
        placed = numbered(piles, [f"{code}s"], [F.asc(code)], copy).drop(code, f"{code}s")
        prepared = prepared.where(~at_cutoff).withColumn(copy, F.lit(0).cast("long")).unionByName(placed)
    once_more = (F.col(key) <= p["cutoff"]) & (F.col(copy) <= p["cut_taken"])
    passes = p["passes"] + F.coalesce(once_more, F.lit(False)).cast("int")
    span = F.lit(float(1 << _COARSE_SHIFT))
    piece = F.element_at(p["places"], F.shiftright(key, _COARSE_SHIFT).cast("int") + 1)
    inside = F.pmod(F.col(key), F.lit(1 << _COARSE_SHIFT)) / span
    place = piece["front"] + inside * piece["words"]
    turns = F.when(passes > 0, F.sequence(F.lit(0), passes - 1)).otherwise(F.array().cast("array<int>"))
    positions = F.transform(turns, lambda k: _position(k * p["source_size"] + place, p))
    return prepared.withColumn(column, F.struct(
        F.col(size).alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"),
        passes.alias("passes"), (passes * F.col(size)).alias("taken"), positions.alias("positions"),
    )).drop(held, key, size, copy)


def in_training_order(mixed: DataFrame, column: str = "mix") -> DataFrame:
    """One row per document and pass, range-partitioned and sorted by position."""
    rest, position = [c for c in mixed.columns if c != column], free_name("position__", mixed)
    turns = mixed.select(*rest, F.explode(F.col(column)["positions"]).alias(position))
    return turns.repartitionByRange(F.col(position)).sortWithinPartitions(position).withColumnRenamed(position, column)


def training_places(mixed: DataFrame, column: str = "mix", out: str = "places") -> DataFrame:
    """``mixed`` with the places (from 1, one per pass) of each row in the training order, as ``out``.

    The passes are range-sorted without the other columns, so ``mixed`` should be narrow: it is stored.
    Equal positions follow the other columns, whole rows that repeat any order.
    """
    row, part, front, n = (free_name(x, mixed) for x in ("row__", "part__", "front__", "n__"))
    stored = cut_lineage(mixed.withColumn(row, F.monotonically_increasing_id()))
    names = [f.name for f in mixed.schema.fields if f.name != column and "map<" not in f.dataType.simpleString()]
    tie = F.xxhash64(*names) if names else F.lit(0)
    ordered = in_training_order(stored.select(row, tie.alias(front), column), column)
    ranged = cut_lineage(ordered.withColumn(part, F.spark_partition_id()))
    # Equal positions lie in one range; one row per range is summed up.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    fronts = ranged.groupBy(part).agg(F.count("*").alias(n)).withColumn(n, F.coalesce(F.sum(n).over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(column, front, row))
    placed = ranged.withColumn(out, inside).join(fronts, part).select(row, (F.col(n) + F.col(out)).alias(out))
    # No more than the passes of a document, two by default.
    found = placed.groupBy(row).agg(F.array_sort(F.collect_list(out)).alias(out))
    joined = stored.join(found, [row], "left")
    return joined.select(*mixed.columns, F.coalesce(out, F.array().cast("array<bigint>")).alias(out))
