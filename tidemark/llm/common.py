"""Helpers shared by the operators: table access, written intermediates, hashing, sweeps."""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table that outlives executors, keeps column pruning,
    and is deleted when the session's JVM ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


#: Rows up to which a stored table may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a stored table whose counted rows are few; any other table as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Numbers of a row of ``bits_of`` as a power of two, and rows up to which such a table may be broadcast (4 KB each).
BITS, BITS_ROWS = 15, 8192


def bits_of(numbers: DataFrame) -> DataFrame:
    """(__many, __bits): the non-negative whole numbers of the one column of ``numbers`` as bits, 2**BITS neighbouring numbers in a row."""
    n = F.col(numbers.columns[0])
    return numbers.groupBy(F.shiftright(n, BITS).alias("__many")).agg(F.bitmap_construct_agg(n.bitwiseAND((1 << BITS) - 1)).alias("__bits"))


def among(df: DataFrame, number: Column, bits: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``number`` is one of ``bits`` (stored): wide rows stay where they are, as the bits travel to them.

    Numbers that fill more than BITS_ROWS rows are met by a shuffle instead."""
    told = df.withColumns({"__number": number, "__many": F.shiftright(number, BITS)}).join(sized(bits, BITS_ROWS), "__many")
    octet = F.conv(F.hex(F.expr(f"substring(__bits, cast(shiftright(__number & {(1 << BITS) - 1}, 3) as int) + 1, 1)")), 16, 10).cast("int")
    return told.withColumn("__octet", octet).filter("shiftright(__octet, cast(__number & 7 as int)) & 1 = 1").select(*df.columns)


def vocabulary(key: tuple, load):
    """What ``load()`` gives, kept in this Python worker until another key is asked for: a worker holds one vocabulary at a time.

    It is kept beside the interpreter's own state, as module globals may travel with a task's function."""
    held = vars(sys).setdefault("_tidemark_vocabulary", {})
    if key not in held:
        held.clear()
        give_back()
        held[key] = load()
    return held[key]


def in_slices(texts: list, size: int = 2 << 20):
    """(start, end) of neighbouring texts of about ``size`` characters together, one text at least."""
    at = 0
    while at < len(texts):
        upto, n = at, 0
        while upto < len(texts) and (upto == at or n + len(texts[upto] or "") <= size):
            n += len(texts[upto] or "")
            upto += 1
        yield at, upto
        at = upto


def numbered(items: list) -> tuple[np.ndarray, list]:
    """A number for each item, equal ones alike, and the different items by number (``pandas.factorize`` ends strings at a zero character)."""
    seen: dict = {}
    codes = np.fromiter((seen.setdefault(x, len(seen)) for x in items), dtype=np.int64, count=len(items))
    return codes, list(seen)


def give_back() -> None:
    """Return the freed memory of a Python worker to the system; a worker lives on and would keep it through later stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lower_az(c: Column) -> Column:
    """Lower-case A-Z alone (``lower`` also changes letters beyond ASCII)."""
    return F.translate(c, UPPER, LOWER)


def text_key(c: Column) -> Column:
    """16-byte digest of a text; equal for equal texts, null counts as empty."""
    return F.unhex(F.md5(F.coalesce(c, F.lit(""))))


def sorted_carry(df: DataFrame, keys: list[str], event: str, out: str, name: str) -> DataFrame:
    """``out``: the last non-null ``event`` at or before each row in the global order of ``keys``.

    A sweep without a global window: rows are range-partitioned by ``keys`` (a hot
    leading key spreads over many ranges as long as the whole key is unique) and
    stored with their range number; each range sweeps alone, and one row per range
    hands the last event on to the ranges behind it."""
    ranged = stored(df.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()), name)
    at = F.struct(*[F.col(k) for k in keys])
    lasts = ranged.groupBy("__range").agg(
        F.max_by(F.col(event), F.when(F.col(event).isNotNull(), at)).alias("__last")
    )
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, so the window and the broadcast are bounded by the number of partitions
    handed = lasts.select("__range", F.last("__last", ignorenulls=True).over(before).alias("__handed"))
    own = Window.partitionBy("__range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    swept = ranged.withColumn("__own", F.last(event, ignorenulls=True).over(own))
    return (
        swept.join(F.broadcast(handed), "__range", "left")
        .withColumn(out, F.coalesce("__own", "__handed"))
        .drop("__range", "__own", "__handed")
    )
