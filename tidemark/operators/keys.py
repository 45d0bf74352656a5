"""The set of indexed keys: its own table, bucketed and sorted by key, grown by merging.

Whether a document is indexed already is asked of this table alone: the stored side of
the anti join is bucketed by key, so only the documents are shuffled and no chunk is read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.epochs import Store

#: Buckets of the key table; a store keeps the number it was made with.
BUCKETS = 32
KEYS = "keys"


def _version(store: Store) -> str | None:
    """The published key table of the highest number."""
    return max((e for e in store.published() if e.startswith("keys-")), default=None)


def stored_keys(spark: SparkSession, store: Store, buckets: int = BUCKETS) -> DataFrame | None:
    """(key, kinds) of the indexed documents; None before the first merge.

    The session's catalog gets a nameless entry for the folder, which tells Spark how its files are bucketed."""
    version = _version(store)
    if version is None:
        return None
    name = f"keys_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} (key STRING, kinds ARRAY<STRING>) USING parquet "
        f"CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{store.folder(KEYS, version)}'")
    return spark.table(name)


def merge_keys(spark: SparkSession, store: Store, new: DataFrame, buckets: int = BUCKETS) -> str:
    """Publish a key table that unites the stored keys with ``new`` (key, kind); returns its version.

    Keys of several kinds of document are one set; ``kinds`` tells where a key came
    from.  Null keys are ignored and repeated ones count once.  Both sides are sorted
    by bucket, so the union is a merge: only the new keys are shuffled."""
    before = stored_keys(spark, store, buckets)
    fresh = new.filter("key is not null").groupBy("key").agg(F.array_sort(F.collect_set("kind")).alias("kinds_new"))
    if before is None:
        merged = fresh.select("key", F.col("kinds_new").alias("kinds"))
    else:
        both = before.join(fresh, "key", "full")
        none = F.array().cast("array<string>")
        merged = both.select("key", F.array_sort(F.array_union(F.coalesce("kinds", none), F.coalesce("kinds_new", none))).alias("kinds"))
    last = _version(store)
    version = f"keys-{int(last.split('-')[1]) + 1 if last else 0:09d}"
    name = f"keys_{uuid.uuid4().hex}"
    # one task a bucket, so that a bucket is one sorted file
    (merged.repartition(buckets, "key").write.mode("overwrite").bucketBy(buckets, "key").sortBy("key")
     .option("path", store.folder(KEYS, version)).format("parquet").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the files stay, the folder is the table's own
    store.publish(version)
    return version


def not_stored(docs: DataFrame, keys: DataFrame | None, key_col: str = "file_path") -> DataFrame:
    """Documents whose key isn't in the key table; a document without a key is never stored."""
    if keys is None:
        return docs
    return docs.join(keys.select(F.col("key").alias(key_col)), key_col, "left_anti")
