"""Append-only tables that are published an epoch at a time.

An epoch's files are written into a folder of its own; they count only once a manifest
entry names the epoch, and that entry is one small file that appears whole or not at all.
A run that dies in between leaves a folder that no reader sees and that the next
attempt of the same epoch replaces.  Several tables (chunks, failed documents, keys) of
one store are published by the same entry, so they never disagree.

::

    <store>/<table>/epoch=<name>/...parquet
    <store>/_published/<name>
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PUBLISHED = "_published"


def _path(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _path(spark, path)
    return fs.exists(hpath)


@dataclass
class Store:
    """A store of published epochs under ``root``, a folder that driver and executors share."""

    spark: SparkSession
    root: str

    def published(self) -> list[str]:
        """Names of the published epochs, in order of their names."""
        return self.marked(PUBLISHED[1:])

    def folder(self, table: str, epoch: str) -> str:
        return f"{self.root}/{table}/epoch={epoch}"

    def write(self, table: str, epoch: str, rows: DataFrame, partition_by: list[str] | None = None) -> None:
        """The files of one table of an epoch, replacing what a dead attempt left; unseen until :meth:`publish`."""
        self._note_schema(table, rows.schema)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.folder(table, epoch))

    def publish(self, epoch: str) -> None:
        """Make the epoch's files count, at once.  Publishing an epoch again changes nothing."""
        self.mark(PUBLISHED[1:], epoch)

    def mark(self, label: str, epoch: str) -> None:
        """Note something about an epoch, by an empty file that appears at once."""
        fs, entry = _path(self.spark, f"{self.root}/_{label}/{epoch}")
        if not fs.exists(entry):
            fs.createNewFile(entry)

    def marked(self, label: str) -> list[str]:
        fs, folder = _path(self.spark, f"{self.root}/_{label}")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(n for n in names if not n.startswith("."))

    def read(self, table: str, epochs: list[str] | None = None) -> DataFrame | None:
        """The rows of a table in all published epochs (or those of ``epochs`` that are), with their ``epoch``; None before the first."""
        names = self.published()
        folders = [f for e in names if epochs is None or e in epochs if exists(self.spark, f := self.folder(table, e))]
        if not folders:
            return None
        schema = T.StructType([*self._schema(table).fields, T.StructField("epoch", T.StringType())])
        return self.spark.read.option("basePath", f"{self.root}/{table}").schema(schema).parquet(*folders)

    def _schema(self, table: str) -> T.StructType:
        fs, file = _path(self.spark, f"{self.root}/{table}/_schema")
        if not fs.exists(file):
            return T.StructType([])
        stream = fs.open(file)
        try:
            return T.StructType.fromJson(json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _note_schema(self, table: str, schema: T.StructType) -> None:
        """Keep the columns of a table, those of earlier epochs first, so that epochs without rows can be read."""
        had = self._schema(table)
        fields = [*had.fields, *(f for f in schema.fields if f.name not in had.fieldNames())]
        if len(fields) > len(had.fields):
            fs, file = _path(self.spark, f"{self.root}/{table}/_schema")
            out = fs.create(file, True)
            out.write(bytearray(T.StructType(fields).json().encode()))
            out.close()
