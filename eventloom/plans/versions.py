"""Versions of a run's tables, and what each stage was made from.

A table is written to a folder of its own version; nothing is overwritten. When all
tables of a stage are there, its manifest is written beside and renamed into place: it
names the versions, the options and the inputs of the stage. So a stage that was
interrupted leaves the earlier one as it was, and a later run can tell by the
manifest whether a stage is still valid. All files are reached through the session's
file systems.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_manifests"


def digest(value: Any) -> str:
    """A digest of plain values, or of what they print as."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


class Versions:
    """The versioned tables under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._writing: dict[str, str] = {}

    # --- files ------------------------------------------------------------------------

    def _path(self, *parts: str):
        """A path under the folder, with its scheme, and its file system."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return files.makeQualified(path), files

    def _read_text(self, *parts: str) -> str | None:
        path, files = self._path(*parts)
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write_text(self, text: str, *parts: str) -> None:
        """Write beside and rename, so that a reader sees the old text or the new one."""
        path, files = self._path(*parts)
        beside, _ = self._path(*parts[:-1], f".{parts[-1]}-{uuid.uuid4().hex}")
        stream = files.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context, hadoop = self.spark.sparkContext, self.spark.sparkContext._jvm.org.apache.hadoop.fs
        options = context._gateway.new_array(hadoop.Options.Rename, 1)
        options[0] = hadoop.Options.Rename.OVERWRITE
        hadoop.FileContext.getFileContext(path.toUri(), context._jsc.hadoopConfiguration()).rename(beside, path, options)

    def input_digest(self, df: DataFrame) -> str:
        """What a table was read from: its files with sizes and times, and its columns."""
        files = []
        for name in sorted(df.inputFiles()):
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            status = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
            files.append((name, status.getLen(), status.getModificationTime()))
        return digest([files, df.dtypes])

    # --- tables -----------------------------------------------------------------------

    def manifest(self, stage: str) -> dict | None:
        text = self._read_text(MANIFESTS, f"{stage}.json")
        return json.loads(text) if text else None

    def begin(self) -> None:
        """From now on tables belong to a new stage."""
        self._writing = {}

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Write a new version of a table; it is seen by others once its stage is finished."""
        version = f"{table}/v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{version}")
        self._writing[table] = version
        return self.spark.read.parquet(f"{self.folder}/{version}")

    def finish(self, stage: str, options: Mapping[str, Any], inputs: Mapping[str, str]) -> dict:
        """Publish the tables written since :meth:`begin` as those of ``stage``."""
        found = {"options": digest(options), "inputs": dict(inputs), "tables": dict(self._writing)}
        self._write_text(json.dumps(found, sort_keys=True), MANIFESTS, f"{stage}.json")
        return found

    def valid(self, stage: str, options: Mapping[str, Any], inputs: Mapping[str, str]) -> bool:
        """Whether the finished stage was made with these options from these inputs, and all its tables are whole."""
        found = self.manifest(stage)
        if found is None or found["options"] != digest(options) or found["inputs"] != dict(inputs):
            return False
        return all(self._whole(version) for version in found["tables"].values())

    def _whole(self, version: str) -> bool:
        path, files = self._path(version, "_SUCCESS")
        return files.exists(path)

    def version_of(self, table: str, stages: tuple[str, ...]) -> str:
        """The version of a table that the last finished stage names."""
        if table in self._writing:
            return self._writing[table]
        for stage in stages:
            found = self.manifest(stage)
            if found and table in found["tables"]:
                return found["tables"][table]
        raise ValueError(f"no stage has finished the table {table!r} under {self.folder}")

    def clear_old(self, stages: tuple[str, ...]) -> list[str]:
        """Delete the versions that no manifest names, and return them; nobody may be writing or reading them."""
        named = {v for s in stages for v in (self.manifest(s) or {"tables": {}})["tables"].values()}
        root, files = self._path()
        gone = []
        folders = [root] if files.exists(root) else []
        while folders:
            for status in files.listStatus(folders.pop()):
                name = status.getPath().getName()
                if not status.isDirectory() or name == MANIFESTS:
                    continue
                if not name.startswith("v-"):
                    folders.append(status.getPath())
                elif f"{status.getPath().getParent().toUri().getPath().removeprefix(root.toUri().getPath()).lstrip('/')}/{name}" not in named:
                    files.delete(status.getPath(), True)
                    gone.append(name)
        return gone
