"""Dense counters of fixed size, added up over tasks by a tree of bounded fan-in."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Counters in a slice, and pieces of one slice that a task adds up at once.
WIDTH, FAN = 1 << 16, 32


def packed(counts: np.ndarray) -> bytes:
    """Counters as bytes: the few that are not zero with their places, or all of them compressed."""
    full = np.flatnonzero(counts)
    if 16 * len(full) < len(counts):
        return b"s" + full.astype("<u4").tobytes() + counts[full].astype("<u8").tobytes()
    return b"%d" % counts.itemsize + zlib.compress(counts.tobytes(), 1)


def add_packed(total: np.ndarray, data: bytes) -> None:
    if data[:1] == b"s":
        n = (len(data) - 1) // 12
        total[np.frombuffer(data, "<u4", n, 1)] += np.frombuffer(data, "<u8", n, 1 + 4 * n)
    else:
        part = np.frombuffer(zlib.decompress(data[1:]), dtype=f"<u{data[:1].decode()}")
        total[: len(part)] += part


def added(pieces: Iterable[bytes], width: int = WIDTH) -> np.ndarray:
    total = np.zeros(width, dtype=np.uint64)
    for p in pieces:
        add_packed(total, p)
    return total


def sliced(counts: np.ndarray, width: int = WIDTH) -> Iterator[tuple[int, bytes]]:
    """(slice, packed counters) of the slices that hold any."""
    for k in range(0, len(counts), width):
        part = counts[k : k + width]
        if part.any():
            yield k // width, packed(part)


def tree_sum(pieces: DataFrame, name: str, width: int = WIDTH, fan: int = FAN) -> DataFrame:
    """(slice, counts): the sum of all ``counts`` of a slice; ``pieces`` are rows (slice int, counts binary) as each task sends them.

    A task adds at most ``fan`` pieces, in as many steps as the number of sending tasks needs."""

    def some(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": [batch["slice"].iloc[0]], "part": [batch["part"].iloc[0]], "counts": [packed(added(batch["counts"], width))]})

    pieces = stored(pieces.withColumn("part", F.spark_partition_id()), name)
    last = pieces.agg(F.max("part")).first()[0] or 0
    while last > 0:
        pieces = pieces.withColumn("part", F.floor(F.col("part") / fan).cast("int")).groupBy("slice", "part").applyInPandas(
            some, "slice int, part int, counts binary")
        last //= fan
    return pieces.select("slice", "counts")
