"""Appended tables whose appends are commits.

A ledger is a folder of named tables. Rows are written to new data folders first; a commit then adds one small manifest
that lists the live data folders of every table. Manifests are numbered, and a number can be taken once (by a rename that
never replaces, or on a local folder a link, so the file system must offer one of these), so of two writers at once the second one sees the first one's rows before it commits, several tables
change together or not at all, and a crash leaves data folders that no manifest names. A reader takes the last manifest
and opens the folders it lists with the schema it holds: nothing is listed and no footer is opened for it.

Every append is one folder; when a table has more than ``MAX_FOLDERS``, the commit writes them as one, in files of
about ``FILE_BYTES``. Folders that no recent manifest names are deleted by :meth:`Ledger.vacuum`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import delete_path, file_system, path_exists

MAX_FOLDERS = 16
FILE_BYTES = 128 << 20
#: Attempts to find a free number before a commit gives up.
ATTEMPTS = 50


class Ledger:
    """``tables`` of a manifest: name -> {"folders": [...], "schema": json}; ``batches``: the finished batch names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------------------- reading
    def version(self) -> int:
        """The number of the last manifest, -1 before the first commit."""
        return max(self._numbers(), default=-1)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version < 0:
            return {"tables": {}, "batches": {}}
        return json.loads(self.spark.read.text(self._manifest_path(version), wholetext=True).first()["value"])

    def read(self, name: str, version: int | None = None) -> DataFrame | None:
        """The rows of a table, None if it has never been written."""
        table = self.manifest(version)["tables"].get(name)
        return self._rows(table) if table else None

    # ------------------------------------------------------------------------- writing
    def commit(self, rows: Mapping[str, DataFrame], unique: str | None = None, batch: tuple[str, int] | None = None) -> int:
        """Append to several tables in one step and return the version.

        A column that a stored table lacks is added, one that the new rows lack is null, known columns are cast to their
        stored types. With ``unique`` rows whose key the table already has are left out, also those of a writer
        that was faster. ``batch`` is (stream, number): a number that is not above the last one of its stream was
        committed before and changes nothing.
        """
        base = self.version()
        manifest = self.manifest(base)
        if batch and manifest["batches"].get(batch[0], -1) >= batch[1]:
            return base
        written = {name: self._write(self._fresh(df, manifest["tables"].get(name), unique)) for name, df in rows.items()}
        for _ in range(ATTEMPTS):
            following = {"tables": dict(manifest["tables"]), "batches": dict(manifest["batches"])}
            for name, folder in written.items():
                following["tables"][name] = self._with_folder(manifest["tables"].get(name), rows[name].schema, folder)
            if batch:
                following["batches"][batch[0]] = batch[1]
            if self._publish(base + 1, following):
                return base + 1
            earlier, base = manifest, self.version()
            manifest = self.manifest(base)
            if batch and manifest["batches"].get(batch[0], -1) >= batch[1]:
                return base
            if unique:
                for name, folder in written.items():
                    if folder and self._names(manifest, name) != self._names(earlier, name):
                        again = self.spark.read.schema(rows[name].schema).parquet(f"{self.path}/{folder}")
                        written[name] = self._write(self._fresh(again, manifest["tables"].get(name), unique))
        raise OSError(f"{self.path}: no free version after {ATTEMPTS} attempts")

    def vacuum(self, keep: int = 10) -> int:
        """Delete data folders that none of the last ``keep`` manifests names, and older manifests; returns how many folders.

        A commit under way has folders that no manifest names yet: run this when no writer is active.
        """
        numbers = sorted(self._numbers())
        live = {f for n in numbers[-keep:] for t in self.manifest(n)["tables"].values() for f in t["folders"]}
        dropped = [f for f in self._list("data") if f"data/{f}" not in live]
        for folder in dropped:
            delete_path(self.spark, f"{self.path}/data/{folder}")
        for number in numbers[:-keep]:
            delete_path(self.spark, self._manifest_path(number))
        return len(dropped)

    # ------------------------------------------------------------------------- helpers
    def _manifest_path(self, number: int) -> str:
        return f"{self.path}/log/{number:012d}.json"

    def _list(self, folder: str) -> list[str]:
        if not path_exists(self.spark, f"{self.path}/{folder}"):
            return []
        files, place = file_system(self.spark, f"{self.path}/{folder}")
        return [f.getPath().getName() for f in files.listStatus(place)]

    def _numbers(self) -> list[int]:
        return [int(name[:-5]) for name in self._list("log") if name.endswith(".json") and name[:-5].isdigit()]

    @staticmethod
    def _names(manifest: dict, name: str) -> list[str]:
        return manifest["tables"].get(name, {"folders": []})["folders"]

    def _rows(self, table: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        if not table["folders"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in table["folders"]])

    def _fresh(self, df: DataFrame, table: dict | None, unique: str | None) -> DataFrame:
        """New rows in the stored types, one per key and without the keys already there."""
        if table:
            stored = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(table["schema"])).fields}
            df = df.select(*[F.col(f"`{c}`").cast(stored[c]).alias(c) if c in stored else F.col(f"`{c}`") for c in df.columns])
        if unique:
            df = df.dropDuplicates([unique])
            if table and table["folders"]:
                df = df.join(self._rows(table).select(unique), unique, "left_anti")
        return df

    def _write(self, df: DataFrame) -> str | None:
        """The new data folder, None if there is no row."""
        folder, seen = f"data/{uuid.uuid4().hex}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.path}/{folder}")
        if seen.get["rows"]:
            return folder
        delete_path(self.spark, f"{self.path}/{folder}")
        return None

    def _with_folder(self, table: dict | None, schema: T.StructType, folder: str | None) -> dict:
        """The table with one more folder; too many folders become one."""
        fields = T.StructType.fromJson(json.loads(table["schema"])).fields if table else []
        known = {f.name for f in fields}
        merged = T.StructType([*fields, *[f for f in schema.fields if f.name not in known]])
        out = {"folders": [*(table["folders"] if table else []), *([folder] if folder else [])], "schema": merged.json()}
        if len(out["folders"]) > MAX_FOLDERS:
            size = sum(self._bytes(f) for f in out["folders"])
            whole = f"data/{uuid.uuid4().hex}"
            self._rows(out).coalesce(max(1, -(-size // FILE_BYTES))).write.parquet(f"{self.path}/{whole}")
            out["folders"] = [whole]
        return out

    def _bytes(self, folder: str) -> int:
        files, place = file_system(self.spark, f"{self.path}/{folder}")
        return files.getContentSummary(place).getLength()

    def _publish(self, number: int, manifest: dict) -> bool:
        """Take a number for a manifest; False if another writer has it."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        files, draft = file_system(self.spark, f"{self.path}/log/.{uuid.uuid4().hex}")
        _, final = file_system(self.spark, self._manifest_path(number))
        stream = files.create(draft, False)
        stream.write(json.dumps(manifest).encode())
        stream.close()
        draft, final = files.makeQualified(draft), files.makeQualified(final)
        try:
            if files.getUri().getScheme() == "file":  # a local rename replaces; a link to the draft does not
                paths = jvm.java.nio.file.Paths
                jvm.java.nio.file.Files.createLink(paths.get(final.toUri()), paths.get(draft.toUri()))
                files.delete(draft, False)
            else:
                options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf).rename(draft, final, options)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            files.delete(draft, False)
            return False


def append_parquet(df: DataFrame, path: str) -> None:
    """Append to a table of its own ledger, without reading the rows already there."""
    Ledger(df.sparkSession, path).commit({"rows": df})


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`append_parquet`."""
    rows = Ledger(spark, path).read("rows")
    if rows is None:
        raise FileNotFoundError(path)
    return rows
