"""Zones: folders of named tables.

A Parquet table is a folder of runs. A run is what one write left, in a folder of its own, and one small file, the pointer, names the runs that make up the table, its columns
and what the writer noted. A write becomes visible when the next pointer has its name, all at once: a write that fails, or a job that ends in the middle, leaves the
table as it was, and a table may be replaced by rows read from itself.
"""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NullType, StringType, StructField, StructType

from cityloom.session import hadoop_path, read_text, rename_new, write_bytes

log = logging.getLogger(__name__)

# Beside the files of a table that an earlier version wrote: its columns. Readers skip names with an underscore.
SCHEMA_FILE = "_columns.json"
RUNS = "_runs"
RUN_COLUMN = "_run"
_POINTER = re.compile(r"_pointer-(\d{12})\.json")
#: Files that lie in the table's folder itself, written by other programs.
_OWN = "."
#: Rows of a file: of few columns that repeat their values many millions fit few bytes, which one task would read.
FILE_ROWS = 2_000_000
#: Attempts to make a run current beside other writers.
ATTEMPTS = 100


@dataclass(frozen=True)
class Pointer:
    """What a table is made of: its runs, its columns, its partition column, what writers noted, and by run the tables kept beside it."""

    number: int = 0
    runs: tuple[str, ...] = ()
    columns: StructType | None = None
    partition_by: str | None = None
    notes: dict = field(default_factory=dict)
    beside: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def content(self) -> bytes:
        return json.dumps(
            {
                "runs": self.runs,
                "columns": json.loads(self.columns.json()) if self.columns is not None else None,
                "partition_by": self.partition_by,
                "notes": self.notes,
                "beside": self.beside,
            }
        ).encode()

    @classmethod
    def of(cls, number: int, content: str) -> Pointer:
        found = json.loads(content)
        columns = StructType.fromJson(found["columns"]) if found["columns"] else None
        return cls(number, tuple(found["runs"]), columns, found["partition_by"], found["notes"], {run: tuple(names) for run, names in found["beside"].items()})


@dataclass(frozen=True)
class Zone:
    """Tables below ``root``, Parquet unless another Spark format and its options are named; tables of other formats are plain folders without pointers."""

    spark: SparkSession
    root: str
    table_format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def exists(self, table: str) -> bool:
        files, path = hadoop_path(self.spark, self.path(table))
        return files.exists(path) and (self.table_format != "parquet" or bool(self._pointer(table).runs))

    def drop(self, table: str) -> bool:
        """Delete a table; False if there was none."""
        there = self.exists(table)
        files, path = hadoop_path(self.spark, self.path(table))
        return files.delete(path, True) and there

    def _pointer(self, table: str) -> Pointer:
        """The current pointer; of a table that another program wrote one to its own files, of none one without runs."""
        files, folder = hadoop_path(self.spark, self.path(table))
        for attempt in range(ATTEMPTS):
            if not files.exists(folder):
                return Pointer()
            names = [entry.getPath().getName() for entry in files.listStatus(folder)]
            found = max((name for name in names if _POINTER.fullmatch(name)), default=None)
            if not found:
                break
            try:
                return Pointer.of(int(_POINTER.fullmatch(found)[1]), read_text(self.spark, f"{self.path(table)}/{found}"))
            except Py4JJavaError as error:
                # A writer has put the next pointer in its place meanwhile.
                if attempt == ATTEMPTS - 1 or "FileNotFound" not in error.java_exception.getClass().getName():
                    raise
        if all(name.startswith(("_", ".")) for name in names):
            return Pointer()
        columns = StructType.fromJson(json.loads(read_text(self.spark, f"{self.path(table)}/{SCHEMA_FILE}"))) if SCHEMA_FILE in names else None
        return Pointer(0, (_OWN,), columns)

    def _run_path(self, table: str, run: str, beside: str = "") -> str:
        if run == _OWN:
            return self.path(table)
        # The name makes the run a partition of all runs, as Spark wants it of folders that are read together and are partitioned themselves.
        return f"{self.path(table)}/{RUNS}/" + (f"{beside}-{run}" if beside else f"{RUN_COLUMN}={run}")

    def runs(self, table: str) -> tuple[str, ...]:
        """Names of the writes that make up a Parquet table, in their order."""
        return self._pointer(table).runs

    def notes(self, table: str) -> dict:
        """What writers noted with a Parquet table; later ones win."""
        return self._pointer(table).notes

    def columns(self, table: str) -> StructType | None:
        """The columns written to a Parquet table so far, with their types; None if another program wrote it."""
        return self._pointer(table).columns if self.table_format == "parquet" else None

    def read(self, table: str, schema: StructType | str | None = None, runs: Iterable[str] | None = None) -> DataFrame:
        """The table with all columns that any run wrote, NULL in the rows of runs without them; with ``runs`` only the rows of these.

        Partition columns have the types they were written with, so a text like 01 stays a text.
        """
        reader = self.spark.read.format(self.table_format).options(**self.options)
        if self.table_format != "parquet":
            return (reader.schema(schema) if schema is not None else reader).load(self.path(table))
        pointer = self._pointer(table)
        chosen = pointer.runs if runs is None else [run for run in pointer.runs if run in set(runs)]
        schema = schema if schema is not None else pointer.columns
        if not pointer.runs or schema is None:
            return (reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")).load(self.path(table))
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        columns = [F.col(f"`{name}`") for name in schema.names]
        frames = [reader.schema(schema).load(self.path(table))] if _OWN in chosen else []
        paths = [self._run_path(table, run) for run in chosen if run != _OWN]
        if paths:
            named = StructType([*schema, StructField(RUN_COLUMN, StringType())])
            frames.append(reader.schema(named).option("basePath", f"{self.path(table)}/{RUNS}").load(paths).select(*columns))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], schema)

    def read_all(self, *tables: str) -> dict[str, DataFrame]:
        return {table: self.read(table) for table in tables}

    def read_beside(self, table: str, name: str) -> DataFrame | None:
        """Rows of a small table that runs keep beside their own rows, of all current runs together; None if none has it."""
        pointer = self._pointer(table)
        paths = [self._run_path(table, run, name) for run in pointer.runs if name in pointer.beside.get(run, ())]
        return self.spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None

    def as_views(self, *tables: str, prefix: str = "") -> None:
        """Make tables known to SQL text under their names."""
        for table in tables:
            self.read(table).createOrReplaceTempView(f"{prefix}{table}")

    def write(
        self,
        table: str,
        df: DataFrame,
        mode: str = "append",
        partition_by: str | None = None,
        notes: dict | None = None,
        beside: dict[str, DataFrame] | None = None,
        run: str | None = None,
    ) -> None:
        """Append to the table (created if missing), or replace it with ``mode='overwrite'``.

        Runs may differ in columns, but not in the type of a column they share nor in the partition column. A partitioned table is
        rebalanced on the partition column first: small partitions share a task, and a hot one is split into files of the advisory
        size. An empty text cannot be a partition and fails the write; NULL can. ``notes`` and the tables ``beside`` become visible together with the rows; ``run`` is a new
        name for the run where the caller needs to know it before.

        Of two writers that end together both are kept; this needs a file system whose renaming fails where the name is taken, as HDFS has it. After a replacement the old
        rows are deleted, so a query over them that still runs may fail.
        """
        if RUN_COLUMN in df.columns:
            raise ValueError(f"a table cannot have a column {RUN_COLUMN}")
        untyped = [f.name for f in df.schema if isinstance(f.dataType, NullType)]
        df = df.withColumns({name: F.col(f"`{name}`").cast("string") for name in untyped})
        if self.table_format == "parquet":
            # Checked before any work; once more when the run becomes current.
            self._with_run(self._known(table), "", df.schema, mode, partition_by, {}, ())
        if partition_by:
            if isinstance(df.schema[partition_by].dataType, StringType):
                value = F.col(f"`{partition_by}`")
                refused = F.raise_error(F.lit(f"{partition_by}: an empty text cannot be a partition")).cast("string")
                df = df.withColumn(partition_by, F.when(value == "", refused).otherwise(value))
            df = df.hint("rebalance", partition_by)
        writer = df.write.format(self.table_format).options(**({"maxRecordsPerFile": FILE_ROWS} | self.options))
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if self.table_format != "parquet":
            writer.mode(mode).save(self.path(table))
            return
        run = run or uuid.uuid4().hex
        try:
            writer.save(self._run_path(table, run))
            for name, rows in (beside or {}).items():
                rows.write.parquet(self._run_path(table, run, name))
        except Exception:
            for name in ("", *(beside or {})):
                files, path = hadoop_path(self.spark, self._run_path(table, run, name))
                files.delete(path, True)
            raise
        self._commit(table, run, lambda pointer: self._with_run(pointer, run, df.schema, mode, partition_by, notes or {}, tuple(beside or ())))

    def _known(self, table: str) -> Pointer:
        """The current pointer with the columns of the table, whoever wrote it."""
        pointer = self._pointer(table)
        if pointer.runs and pointer.columns is None:
            return Pointer(pointer.number, pointer.runs, self.read(table).schema, pointer.partition_by, pointer.notes, pointer.beside)
        return pointer

    @staticmethod
    def _with_run(pointer: Pointer, run: str, schema: StructType, mode: str, partition_by: str | None, notes: dict, beside: tuple[str, ...]) -> Pointer:
        """The pointer with one more run, or with that run alone."""
        if mode == "overwrite" or not pointer.runs:
            return Pointer(pointer.number + 1, (run,), schema, partition_by, notes, {run: beside})
        if mode != "append":
            raise ValueError(f"unknown mode {mode}")
        if pointer.runs != (_OWN,) and pointer.partition_by != partition_by:
            raise ValueError(f"the table is partitioned by {pointer.partition_by or 'nothing'}")
        kept = pointer.columns
        known = {f.name.lower(): f.dataType for f in kept}
        changed = [f.name for f in schema if _plain(known.get(f.name.lower(), f.dataType)) != _plain(f.dataType)]
        if changed:
            raise ValueError(f"table has other types in: {', '.join(changed)}")
        columns = StructType([*kept, *(f for f in schema if f.name.lower() not in known)])
        return Pointer(pointer.number + 1, (*pointer.runs, run), columns, partition_by, {**pointer.notes, **notes}, {**pointer.beside, run: beside})

    def _commit(self, table: str, run: str, change: Callable[[Pointer], Pointer]) -> None:
        """Make the pointer with a new run the current one, starting anew where another writer was faster; then delete what no pointer names any more."""
        for _ in range(ATTEMPTS):
            old = self._known(table)
            new = change(old)
            draft = f"{self.path(table)}/_draft-{uuid.uuid4().hex}"
            write_bytes(self.spark, draft, new.content())
            try:
                rename_new(self.spark, draft, f"{self.path(table)}/_pointer-{new.number:012d}.json")
            except Py4JJavaError as error:
                files, path = hadoop_path(self.spark, draft)
                files.delete(path, False)
                if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                    raise
                continue
            latest = self._pointer(table)
            if latest.number > new.number and run not in latest.runs:
                # Others were faster by several pointers, and had cleared away the one of this number.
                files, path = hadoop_path(self.spark, f"{self.path(table)}/_pointer-{new.number:012d}.json")
                files.delete(path, False)
                continue
            self._clear(table, old, new)
            return
        raise RuntimeError(f"{table}: other writers were always faster")

    def _clear(self, table: str, old: Pointer, new: Pointer) -> None:
        """Delete the runs and the pointer that the new pointer replaces."""
        files, folder = hadoop_path(self.spark, self.path(table))
        gone = [run for run in old.runs if run not in new.runs]
        paths = [self._run_path(table, run, name) for run in gone if run != _OWN for name in ("", *old.beside.get(run, ()))]
        if old.number:
            paths.append(f"{self.path(table)}/_pointer-{old.number:012d}.json")
        if _OWN in gone:
            names = [entry.getPath().getName() for entry in files.listStatus(folder)]
            paths += [f"{self.path(table)}/{name}" for name in names if not name.startswith("_") or name in (SCHEMA_FILE, "_SUCCESS")]
        for path in paths:
            files.delete(hadoop_path(self.spark, path)[1], True)


def _plain(kind: DataType) -> str:
    """A type without nullability."""
    return kind.simpleString()


def describe(zone: Zone, *tables: str) -> None:
    """Log the schema, the shape and the first rows of tables."""
    for table in tables:
        df = zone.read(table)
        log.info("%s: %d rows, %d columns, %s", table, df.count(), len(df.columns), df.schema.simpleString())
        for row in df.limit(5).collect():
            log.info("%s: %s", table, row.asDict())


def preview(df: DataFrame, *order: str, rows: int = 5) -> DataFrame:
    """The first rows in a stable order, each with the schema as text: what a log line shows."""
    return df.orderBy(*order).limit(rows).withColumn("frame_schema", F.lit(df.schema.simpleString()))
