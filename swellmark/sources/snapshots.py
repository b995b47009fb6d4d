"""Tables in versions: readers see one version or the next, never something in between.

Rows lie in folders that are written once and never changed. A version is an entry of the
table's log that names its folders; writing it is the moment the version begins. A writer
that fails before leaves a folder nobody names. Old versions can be read until they are cleaned up.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from swellmark.sources.commits import TRIES, CommitLog, Taken
from swellmark.sources.sinks import run_metrics

#: Folder names start with it; Spark reads the rest as a column, which is dropped.
WRITE = "write_id"

HISTORY = "version long, operation string, batch string, rows long, total_rows long, folders int"


class SnapshotTable:
    """A versioned table below `base` with the columns of `schema`."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, partition_by: Sequence[str] = ()):
        self.spark, self.base, self.schema = spark, base.rstrip("/"), schema
        self.partition_by = list(partition_by)
        self.log = CommitLog(spark, f"{self.base}/log")

    # ------------------------------------------------------------------ reading

    def version(self) -> int:
        """The newest version's number; 0 before the first."""
        numbers = self.log.numbers()
        return numbers[-1] if numbers else 0

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default; no rows before the first."""
        number = self.version() if version is None else version
        folders = self.log.read(number)["folders"] if number else []
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        # The folder's name is a partition column of its own; declared, so that nothing is inferred.
        fields = T.StructType([*self.schema.fields, T.StructField(WRITE, T.StringType())])
        reader = self.spark.read.schema(fields).option("basePath", f"{self.base}/data")
        return reader.parquet(*[f"{self.base}/data/{f['name']}" for f in folders]).select(*self.schema.fieldNames())

    def history(self) -> DataFrame:
        """A row per version: `version`, `operation`, `batch`, `rows` written, `total_rows`, `folders`."""
        rows = []
        for number in self.log.numbers():
            entry = self.log.read(number)
            total = sum(f["rows"] for f in entry["folders"])
            rows.append((number, entry["operation"], entry["batch"], entry["rows"], total, len(entry["folders"])))
        return self.spark.createDataFrame(rows, HISTORY)

    # ------------------------------------------------------------------ writing

    def replace(self, df: DataFrame, skip_empty: bool = False, batch: str | None = None) -> int:
        """A version with the rows of `df` alone; returns their number. With `skip_empty` no rows leave the table as it is."""
        return self._write(df, "replace", skip_empty, batch)

    def append(self, df: DataFrame, batch: str | None = None) -> int:
        """A version with the rows of `df` besides those there are; returns their number.

        A named batch is written once: if the log has it, nothing happens, so a job that is run again leaves the same table.
        """
        return self._write(df, "append", False, batch)

    def compact(self) -> int:
        """A version with the same rows in one folder; reading a version costs a listing per folder."""
        return self._write(self.read(), "compact", False, None)

    def _write(self, df: DataFrame, operation: str, skip_empty: bool, batch: str | None) -> int:
        if batch is not None:
            known = self.log.find("batch", batch)
            if known:
                return known["rows"]
        name = f"{WRITE}={uuid.uuid4().hex}"
        counted, seen = run_metrics(df.select(*self.schema.fieldNames()), f"snapshot-{uuid.uuid4().hex}")
        started = self.version()
        try:
            counted.write.partitionBy(*self.partition_by).parquet(f"{self.base}/data/{name}")
        except Exception:
            self._delete(name)
            raise
        rows = seen.get["rows"]
        if skip_empty and rows == 0:
            self._delete(name)
            return 0
        for _ in range(TRIES):
            last = self.version()
            if operation == "compact" and last != started:
                self._delete(name)
                raise Taken("the table was changed while it was compacted")
            kept = self.log.read(last)["folders"] if last and operation == "append" else []
            entry = {
                "operation": operation,
                "batch": batch,
                "rows": rows,
                "folders": [*kept, {"name": name, "rows": rows}],
                "written": int(time.time()),
            }
            try:
                self.log.commit(last + 1, entry)
                return rows
            except Taken:
                known = self.log.find("batch", batch) if batch is not None else None
                if known:  # another run of the same batch was faster
                    self._delete(name)
                    return known["rows"]
        self._delete(name)
        raise RuntimeError(f"{self.base} was overtaken {TRIES} times")

    # ------------------------------------------------------------------ cleaning

    def clean(self, keep: int = 1, min_age: float = 86_400.0) -> list[str]:
        """Delete folders that none of the newest `keep` versions names; returns their names.

        Folders younger than `min_age` seconds stay: a writer may be about to name them. Versions whose folders are gone can't be read.
        """
        fs, path = self.log._fs, self.log._path
        if not fs.exists(path(f"{self.base}/data")):
            return []
        named = {f["name"] for number in self.log.numbers()[-keep:] for f in self.log.read(number)["folders"]}
        gone = []
        for status in fs.listStatus(path(f"{self.base}/data")):
            name = status.getPath().getName()
            if name not in named and time.time() - status.getModificationTime() / 1000 >= min_age:
                self._delete(name)
                gone.append(name)
        return sorted(gone)

    def _delete(self, name: str) -> None:
        self.log._fs.delete(self.log._path(f"{self.base}/data/{name}"), True)
