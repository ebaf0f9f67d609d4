"""Tables that are replaced safely: written beside the old ones, then switched by one small file.

A folder holds any number of tables. Every write of a table goes to a folder of its own; a
manifest, ``current.json``, names the folders that make up each table now. Readers look there first,
so a write that fails half-way, or is still running, changes nothing for them. Folders a switch
has replaced stay until the next switch, for readers that have looked them up before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starboard.session import together

MANIFEST = "current.json"


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    target, files = _path(spark, path)
    files.delete(target, True)


def _read(spark: SparkSession, folder: str) -> dict:
    target, files = _path(spark, f"{folder}/{MANIFEST}")
    if not files.exists(target):
        return {"tables": {}, "retired": [], "note": {}}
    stream = files.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _switch(spark: SparkSession, folder: str, manifest: dict) -> None:
    """Put the manifest in place of the old one in one step."""
    fresh, files = _path(spark, f"{folder}/{MANIFEST}.{uuid.uuid4().hex}")
    stream = files.create(fresh, True)
    try:
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    finally:
        stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    kind = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(fresh), files.makeQualified(fs.Path(f"{folder}/{MANIFEST}")),
                   options)


class Change:
    """Writes to the tables of a folder that readers see together, after ``commit``, or not at all.

    One change of a folder at a time; two that overlap leave the later one's manifest.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.written: dict[str, list[str]] = {}
        self.dropped: set[str] = set()

    def put(self, tables: Mapping[str, DataFrame | None]) -> None:
        """Write tables, side by side. None drops a table."""
        version = uuid.uuid4().hex

        def write(name: str) -> None:
            # Noted before it is written, so that a failure can clear up.
            self.written.setdefault(name, []).append(f"{name}/{version}")
            tables[name].write.parquet(f"{self.folder}/{name}/{version}")

        self.dropped |= {name for name, frame in tables.items() if frame is None}
        together([partial(write, name) for name, frame in tables.items() if frame is not None])

    def read(self, name: str) -> DataFrame | None:
        """What this change has written of a table."""
        if name not in self.written:
            return None
        return self.spark.read.parquet(*[f"{self.folder}/{part}" for part in self.written[name]])

    def commit(self, append: bool = False, note: Mapping[str, object] | None = None) -> None:
        """Let readers see what was put: in place of the old rows, or beside them."""
        before = _read(self.spark, self.folder)
        tables, retired = dict(before["tables"]), []
        for name in self.dropped - self.written.keys():
            retired += tables.pop(name, [])
        for name, parts in self.written.items():
            old = tables.get(name, [])
            retired += [] if append else old
            tables[name] = [*old, *parts] if append else parts
        _switch(self.spark, self.folder, {
            "tables": tables, "retired": retired, "note": {**before["note"], **(note or {})}})
        for part in before["retired"]:
            remove(self.spark, f"{self.folder}/{part}")

    def undo(self) -> None:
        """Remove what was written and not committed."""
        for parts in self.written.values():
            for part in parts:
                remove(self.spark, f"{self.folder}/{part}")

    def __enter__(self) -> Change:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()
        else:
            self.undo()


def replace(
    spark: SparkSession, folder: str, tables: Mapping[str, DataFrame | None], append: bool = False,
    note: Mapping[str, object] | None = None,
) -> None:
    """Write tables of a folder and switch to them, all at once. None drops a table."""
    change = Change(spark, folder)
    try:
        change.put(tables)
    except BaseException:
        change.undo()
        raise
    change.commit(append, note)


def current(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Table -> the folders that hold it now."""
    folder = folder.rstrip("/")
    return {name: [f"{folder}/{part}" for part in parts]
            for name, parts in _read(spark, folder)["tables"].items()}


def note(spark: SparkSession, folder: str) -> dict:
    """What the changes of a folder have noted."""
    return _read(spark, folder.rstrip("/"))["note"]


def current_of_all(spark: SparkSession, pattern: str, table: str) -> list[str]:
    """The folders that hold a table now in all folders that match a pattern."""
    target, files = _path(spark, f"{pattern}/{MANIFEST}")
    if not files.globStatus(target):
        return []
    manifests = spark.read.option("wholetext", True).text(f"{pattern}/{MANIFEST}")
    parts = F.from_json(F.get_json_object("value", "$.tables"), "map<string, array<string>>")
    found = manifests.select(
        F.regexp_replace("_metadata.file_path", f"/{MANIFEST}$", "").alias("folder"),
        F.explode(F.element_at(parts, F.lit(table))).alias("part"))
    return [f"{row['folder']}/{row['part']}" for row in found.collect()]
