"""Versioned tables in a shared folder: a reader sees one version whole, a writer publishes the next.

Tables are written to folders of their own and never changed. A version is one small manifest file
that names the folders of every table and holds a few facts; it appears by a rename that fails where
another writer was first. A version that is no longer wanted goes with the folders that no kept
version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer has published the next version already."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jvm = spark._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def numbers(self) -> list[int]:
        """Numbers of the published versions, ascending."""
        folder = self._at("versions")
        if not self._fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("_"))

    def version(self, number: int) -> Version:
        stream = self._fs.open(self._at("versions", f"{number:010d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(**json.loads(text))

    def latest(self) -> Version:
        """The newest version; one without tables where nothing was published."""
        numbers = self.numbers()
        return self.version(numbers[-1]) if numbers else Version()

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
        """Write a table, or a part of it, and return its folder. No version has it yet."""
        folder = f"tables/{name}/part={uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{self.path}/{folder}")
        return folder

    def read(self, version: Version, name: str) -> DataFrame:
        """A table of a version; several folders are one scan."""
        return self.scan(version.tables[name])

    def scan(self, folders: Sequence[str], schema: str | None = None) -> DataFrame:
        """Folders that were written by one name as one table.

        With a schema, folders that got no rows and so no files are fine.
        """
        reader = self.spark.read.option("basePath", f"{self.path}/{folders[0].rsplit('/', 1)[0]}")
        reader = reader.schema(schema) if schema else reader
        return reader.parquet(*[f"{self.path}/{folder}" for folder in folders]).drop("part")

    def publish(self, base: Version, tables: dict[str, list[str]], facts: dict | None = None) -> Version:
        """Make the next version after `base`: its tables and facts with the given ones instead of its own.

        A table without folders goes. `Conflict` is raised if `base` is no longer the newest one, and
        nothing is changed then.
        """
        named = {name: folders for name, folders in (base.tables | tables).items() if folders}
        made = Version(base.number + 1, named, base.facts | (facts or {}))
        text = json.dumps({"number": made.number, "tables": made.tables, "facts": made.facts})
        draft = self._at("versions", f"_{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 0)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(self._at("versions", f"{made.number:010d}.json")), options)
        except Exception as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"version {made.number} exists") from error
            raise
        return made

    def clean(self, keep: int = 2) -> int:
        """Drop all but the newest versions, and the folders that only dropped ones name; gives their number.

        Folders that no version has named yet belong to a writer at work and stay.
        """
        numbers = self.numbers()
        old, kept = numbers[: max(0, len(numbers) - keep)], numbers[max(0, len(numbers) - keep) :]
        named = lambda ns: {folder for n in ns for folders in self.version(n).tables.values() for folder in folders}
        gone = named(old) - named(kept)
        for number in old:
            self._fs.delete(self._at("versions", f"{number:010d}.json"), False)
        for folder in sorted(gone):
            self._fs.delete(self._at(folder), True)
        return len(gone)
