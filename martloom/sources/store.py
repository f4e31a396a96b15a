"""Tables that a failed write cannot harm.

A new version is written beside the table, audited there, and only then put in its place. Until that moment
readers see the old rows, and whatever stops the write (a lost cluster, a fail rule, an audit) leaves them.

Folder tables change place by two renames: the old folder steps aside, the new one takes its name. If the second one fails,
the old folder goes back at once; if the process dies between the two, the next write or `open_folder` puts it
back. Renames are atomic on file systems such as HDFS. An object store copies instead: keep catalog tables there.
Catalog tables change place by renaming tables in the same order.

Staged and replaced folders start with an underscore, so that readers of the parent folder skip them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Audit = Callable[[DataFrame], None]


class AuditError(ValueError):
    """A staged table did not pass; the table it was to replace is as it was."""


class _Files:
    """The few file system calls a swap needs, on whatever file system the table is."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self.target = self.path(folder.rstrip("/"))
        self.fs = self.target.getFileSystem(spark._jsc.hadoopConfiguration())
        self.target = self.fs.makeQualified(self.target)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def beside(self, role: str):
        return self.path(f"{self.target.getParent().toString()}/_{role}-{self.target.getName()}-{uuid.uuid4().hex}")

    def others(self, role: str) -> list:
        """Folders of a role that belong to this table, oldest first."""
        parent = self.target.getParent()
        if not self.fs.exists(parent):
            return []
        start = f"_{role}-{self.target.getName()}-"
        found = [s for s in self.fs.listStatus(parent) if s.getPath().getName().startswith(start) and len(s.getPath().getName()) == len(start) + 32]
        return [s.getPath() for s in sorted(found, key=lambda s: s.getModificationTime())]

    def move(self, source, to) -> None:
        if not self.fs.rename(source, to):
            raise OSError(f"cannot rename {source} to {to}")

    def recover(self) -> None:
        """Put back what a swap that never ended had set aside."""
        aside = self.others("replaced")
        if aside and not self.fs.exists(self.target):
            self.move(aside[-1], self.target)

    def swap(self, staged) -> None:
        aside = None
        if self.fs.exists(self.target):
            aside = self.beside("replaced")
            self.move(self.target, aside)
        try:
            self.move(staged, self.target)
        except Exception:
            if aside is not None:
                self.move(aside, self.target)
            raise
        for old in self.others("replaced"):
            self.fs.delete(old, True)


def replace_folder(
    df: DataFrame, target: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (), audits: tuple[Audit, ...] = ()
) -> None:
    """Replace the folder table at `target` by `df`, which may read the old one.

    Each audit gets the staged rows, as read back from storage, and raises what it finds wrong.
    """
    spark = df.sparkSession
    files = _Files(spark, target)
    files.recover()
    staged = files.beside("staged")
    try:
        writer = df.write.format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(staged.toString())
        for audit in audits:
            audit(spark.read.format(fmt).schema(df.schema).load(staged.toString()))
        files.swap(staged)
    finally:
        files.fs.delete(staged, True)
    spark.catalog.refreshByPath(target)


def swap_folders(spark: SparkSession, source: str, target: str) -> None:
    """Move the folder `source` to the place of `target`, all at once; what was there goes."""
    files = _Files(spark, target)
    files.recover()
    files.swap(files.fs.makeQualified(files.path(source)))
    spark.catalog.refreshByPath(target)


def open_folder(spark: SparkSession, target: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read a folder table, after putting back what an interrupted swap left aside."""
    _Files(spark, target).recover()
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(target)


def _rename(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")


def _set_aside(spark: SparkSession, name: str) -> list[str]:
    database, _, table = name.rpartition(".")
    listed = spark.catalog.listTables(database or None, f"{table}__replaced_*")
    return sorted(f"{database}.{t.name}" if database else t.name for t in listed)


def recover_table(spark: SparkSession, name: str) -> None:
    """Put back the catalog table that an interrupted swap had renamed."""
    aside = _set_aside(spark, name)
    if aside and not spark.catalog.tableExists(name):
        _rename(spark, aside[-1], name)


def replace_table(
    df: DataFrame, name: str, fmt: str = "parquet", bucket_by: tuple[int, str] | None = None, audits: tuple[Audit, ...] = ()
) -> None:
    """Replace the catalog table `name` by `df`, which may read the old one. Buckets are kept by the renames."""
    spark = df.sparkSession
    recover_table(spark, name)
    token = uuid.uuid4().hex
    staged, aside = f"{name}__staged_{token}", f"{name}__replaced_{token}"
    try:
        writer = df.write.format(fmt)
        if bucket_by:
            buckets, key = bucket_by
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(staged)
        for audit in audits:
            audit(spark.table(staged))
        replaced = spark.catalog.tableExists(name)
        if replaced:
            _rename(spark, name, aside)
        try:
            _rename(spark, staged, name)
        except Exception:
            if replaced:
                _rename(spark, aside, name)
            raise
        for old in _set_aside(spark, name):
            spark.sql(f"DROP TABLE {old}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
