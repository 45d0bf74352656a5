"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Each source's documents, shuffled anew for each pass, lie end to end on a line of words that is
cut into blocks of equal size.  The schedule is a sequence of slots: slot i stands at the
i-th point of the golden-ratio sequence, and the interval of cumulative weights it falls
into names its source, so every stretch of the schedule holds the sources in nearly
their shares.  The slots of a source, ranked, take its blocks one after another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sorted_carry, stored

#: Words in a block.
BLOCK = 2048
#: The weights of the sources in their order, repeating, and the share of all words that the mix takes.
WEIGHTS, SHARE = (5, 2, 1), 1.5
#: Passes over a source, at most.
PASSES = 2
#: Points are integers below 2**BITS; STEP is the golden ratio's fraction of that, an odd number.
BITS, STEP = 40, 679_535_556_991

WORD = r"[^\x20\x09-\x0D]+"


def running(df: DataFrame, group: list[str], order: list[str], value: Column, out: str, name: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before each row in its group, by ``order``.

    Rows are range-partitioned by group and order, so a hot group spreads over many
    ranges; each range sums alone, and one row for each group and range hands the sums on.
    ``order`` must tell rows apart for a result that is the same in every run."""
    ranged = stored(df.withColumn("__value", value).repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id()), name)
    parts = ranged.groupBy(*group, "__range").agg(F.sum("__value").alias("__sum"))
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # a group has one row for each range it lies in: bounded by the number of partitions
    handed = parts.select(
        *[F.col(g).alias(f"__{g}") for g in group], F.col("__range").alias("__of"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    own = Window.partitionBy(*group, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("__range") == F.col("__of")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    summed = ranged.withColumn("__own", F.coalesce(F.sum("__value").over(own), F.lit(0)))
    return summed.join(handed, same).withColumn(out, F.col("__before") + F.col("__own")).drop(
        "__value", "__range", "__own", "__of", "__before", *[f"__{g}" for g in group])


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """(source, source_size, weight, target) of each source of ``sized`` (source, size), the null one last.

    Targets share ``share`` times all words by weight; those above ``passes`` times their
    source stop there and the excess is shared anew until none is above: with
    sources ordered by passes * size / weight, those before the first whose share of the
    rest fits are full, and all others get that share."""
    sums = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    turns = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = running(sums.withColumn("__none", F.col("source").isNull()).withColumn("__all", F.lit(0)), ["__all"], ["__none", "source"], F.lit(1), "rank", "source-ranks")
    ranked = ranked.withColumn("weight", turns).withColumn("most", F.col("source_size") * passes).withColumn("level", F.col("most") / F.col("weight"))
    order = ["level", "rank"]
    full = running(ranked, ["__all"], order, F.col("most"), "full_words", "source-fill")
    full = stored(running(full, ["__all"], order, F.col("weight"), "full_weight", "source-weight"), "source-levels")
    total = full.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    wanted, weight = share * (total["words"] or 0), total["weight"] or 0
    rest = (F.lit(wanted) - F.col("full_words")) / (F.lit(weight) - F.col("full_weight"))
    first = full.withColumn("rest", rest).filter("rest <= level").agg(F.min_by("rest", F.struct(*order)).alias("rest")).first()["rest"]
    # with no words at all no share fits, and every target is zero
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(first if first is not None else 0.0))
    return stored(full.select("source", "source_size", "weight", target.alias("target"), "rank"), "targets")


def point(slot: Column) -> Column:
    """The slot's point of the golden-ratio sequence, slot * STEP modulo 2**BITS, in two halves that fit 64 bits."""
    half = 1 << BITS // 2
    high, low = F.shiftright(slot, BITS // 2) % half, slot % half
    return (high * (STEP % half) % half * half + low * STEP) % (1 << BITS)


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source, block, words): the blocks of the mix in their order, ``slot`` from 0 without gaps.

    A source gets one slot for each block of its target, its last one shorter.  The
    points fall short of that or exceed it by the sequence's discrepancy, a few slots:
    those short follow at the end, those beyond are left out."""
    spark = targets.sparkSession
    plan = targets.withColumn("words", F.floor("target")).withColumn("blocks", F.ceil(F.col("words") / block)).withColumn("__all", F.lit(0))
    plan = running(plan, ["__all"], ["rank"], F.col("words"), "from", "weights-before")
    total, slots = plan.agg(F.sum("words"), F.sum("blocks")).first()
    starts = plan.filter("words > 0").select(
        F.floor(F.col("from") / F.lit(float(max(total or 0, 1))) * (1 << BITS)).alias("at"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("slot"), "rank")
    points = spark.range(slots or 0).select(point(F.col("id")).alias("at"), F.lit(1).alias("kind"), F.col("id").alias("slot"), F.lit(None).cast("long").alias("rank"))
    # a sweep over points and interval starts: no source table is sent to the tasks
    drawn = sorted_carry(starts.unionByName(points), ["at", "kind", "slot", "rank"], "rank", "of", "schedule-sweep").filter("kind = 1").select("slot", F.col("of").alias("rank"))
    counted = running(drawn, ["rank"], ["slot"], F.lit(1), "block", "slot-ranks")
    inside = stored(counted.join(plan.select("rank", "blocks"), "rank").filter("block < blocks").select("slot", "rank", "block"), "slots")
    met = inside.groupBy("rank").agg(F.count(F.lit(1)).alias("met"))
    short = plan.filter("blocks > 0").join(met, "rank", "left").withColumn("met", F.coalesce("met", F.lit(0))).filter("met < blocks")
    short = short.select(F.lit(slots or 0).cast("long").alias("slot"), "rank", F.explode(F.sequence("met", F.col("blocks") - 1)).alias("block"))
    every = inside.unionByName(short).withColumn("__all", F.lit(0))
    numbered = running(every, ["__all"], ["slot", "rank", "block"], F.lit(1), "place", "slot-places")
    words = F.least(F.lit(block), F.col("words") - F.col("block") * block)
    return numbered.join(plan.select("rank", "source", "words"), "rank").select(F.col("place").alias("slot"), "source", "rank", "block", words.alias("words"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, block: int = BLOCK, seed: int = 11,
) -> tuple[DataFrame, DataFrame]:
    """(rows, pieces) of a mix of ``docs`` (doc_id, text, source).

    ``rows``: row, doc_id, source, size, source_size, target of each row of ``docs``.
    ``pieces``: slot, offset (in the slot), row, doc_id, start, length: which words of
    which document the mix takes, in its order.  Null texts have no words; a null source
    is one, the last; a null doc_id is a document too; repeated rows are documents each.
    Documents without words are in no piece, so with no words at all there are none.
    The order of a pass depends on ids and texts alone; of rows that agree in both,
    either may come first.  A very long text lies in as many blocks as it fills.  Other
    columns are ignored; no documents give no rows."""
    told = docs.select(
        F.col("doc_id"), F.col("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))).alias("key"),
    ).withColumn("row", F.monotonically_increasing_id())
    told = stored(told, "mix-rows")
    targets = source_targets(told.select("source", "size"), weights, share, passes)
    told = told.join(targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "weight")
    # as many passes as the target needs, each in an order of its own
    needed = F.ceil(F.floor("target") / F.col("source_size")).cast("int")
    turns = told.filter("size > 0 and target >= 1").select(
        "row", "doc_id", "rank", "size", "key", F.floor("target").alias("words"), F.explode(F.sequence(F.lit(1), needed)).alias("turn"))
    mixed = F.md5(F.concat_ws(":", F.lit(seed), F.col("turn"), F.col("key")))
    line = running(turns.withColumn("mixed", mixed).drop("key"), ["rank"], ["turn", "mixed", "row"], F.col("size"), "at", "mix-line").filter("at < words")
    end = F.least(F.col("at") + F.col("size"), F.col("words"))
    cut = line.withColumn("end", end).withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("end") - 1) / block))))
    low, high = F.greatest("at", F.col("block") * block), F.least("end", (F.col("block") + 1) * block)
    parts = cut.select("rank", "block", "row", "doc_id", (low - F.col("at")).alias("start"), (high - low).alias("length"), (low - F.col("block") * block).alias("offset"))
    slots = stored(schedule(targets, block).select("slot", "rank", "block"), "schedule")
    pieces = parts.join(slots, ["rank", "block"]).select("slot", "offset", "row", "doc_id", "start", "length")
    return told.select("row", "doc_id", "source", "size", "source_size", "target"), pieces


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of each row of ``docs``: the words that a mix takes of it, repeats counted (see ``mix``)."""
    rows, pieces = mix(docs, **options)
    taken = pieces.groupBy(F.col("row").alias("__row")).agg(F.sum("length").alias("taken"))
    out = rows.join(taken, F.col("row") == F.col("__row"), "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
