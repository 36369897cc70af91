"""Loading only the landing files that a table does not have yet.

Beside the rows of each run a table keeps the files they came from, with length and time of change. The next load lists the landing folder, without reading any file, and takes those
that are not there. Rows, files and digests of a run become visible together, so a load that fails is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityloom.operators.incremental import append_distinct
from cityloom.session import stage
from cityloom.sources.landing import FEW_FILES, FORMATS, files_like, landing_frames, listing
from cityloom.sources.zones import Zone

FILES = "files"
_SCHEMA = "file string, length bigint, modified timestamp, folder string"
#: The folder that a file, or a file written by Spark as a folder of parts, lies in.
_FOLDER = r"/([^/]+)/[^/]+\.(?:csv|json|parquet)(?:/part-[^/]*)?$"


def listed_files(spark: SparkSession, root: str, layout: str) -> DataFrame:
    """The landing files below ``root``: (file, length, modified, folder). Contents are not read."""
    found = []
    for file_format in FORMATS:
        files = listing(spark, files_like(root, layout, file_format))
        if files is not None:
            found.append(files.withColumn("folder", F.regexp_extract("file", _FOLDER, 1)))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _SCHEMA)


def _differences(listed: DataFrame, loaded: DataFrame) -> tuple[DataFrame, bool]:
    """Files that were not loaded, and whether any loaded one has changed or is gone."""
    names = ["file", "length", "modified"]
    changed = loaded.select(*names).join(listed.select(*names), names, "left_anti")
    return stage(listed.join(loaded.select("file"), "file", "left_anti"), "new-files"), not changed.isEmpty()


def load_new(
    zone: Zone,
    table: str,
    root: str,
    shape: Callable[[list[DataFrame]], DataFrame],
    layout: str = "daily",
    schema: str | None = None,
    by_schema: bool = False,
    stamp: str = "",
    distinct: bool = False,
    partition_by: str | None = None,
) -> str:
    """Bring a table up to date with a landing folder: "nothing", "added", or "replaced" where all files were loaded.

    ``shape`` makes the table's rows from the frames that ``landing_frames`` finds in the files to be loaded. All files are loaded, and the table replaced, where it keeps no ledger, where ``stamp``, which
    stands for everything else that the rows follow from, is another one, where a loaded file was changed or removed, and where new files need another type for a known column. So the
    table is always what one load of all files gives, if ``shape`` treats each row alone; with ``distinct`` rows that repeat, within a load or over several, are kept once.
    """
    spark = zone.spark
    listed = stage(listed_files(spark, root, layout), "listed-files")
    loaded = zone.read_beside(table, FILES) if zone.exists(table) and zone.notes(table).get("stamp") == stamp else None
    if loaded is not None:
        new, changed = _differences(listed, loaded)
        if not changed:
            if new.isEmpty():
                return "nothing"
            folders = [row.folder for row in new.select("folder").distinct().limit(FEW_FILES + 1).collect()]
            rows = shape(landing_frames(spark, root, layout, schema, by_schema, folders, new))
            known = {f.name.lower(): f.dataType.simpleString() for f in zone.columns(table)}
            if all(known.get(f.name.lower(), f.dataType.simpleString()) == f.dataType.simpleString() for f in rows.schema):
                _write(zone, table, rows, "append", new, stamp, distinct, partition_by)
                return "added"
    rows = shape(landing_frames(spark, root, layout, schema, by_schema))
    _write(zone, table, rows, "overwrite", listed, stamp, distinct, partition_by)
    return "replaced"


def _write(zone: Zone, table: str, rows: DataFrame, mode: str, files: DataFrame, stamp: str, distinct: bool, partition_by: str | None) -> None:
    more = {"mode": mode, "partition_by": partition_by, "beside": {FILES: files}}
    if distinct:
        append_distinct(zone, table, rows, notes={"stamp": stamp}, **more)
    else:
        zone.write(table, rows, notes={"stamp": stamp}, **more)


def fingerprint(*frames: DataFrame) -> str:
    """A text that changes with the rows of small frames, whatever their order: what a ``stamp`` is made of."""
    sums = [df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*[F.col(f"`{name}`") for name in df.columns]).cast("decimal(38,0)"))).first() for df in frames]
    return " ".join(f"{rows}:{total}" for rows, total in sums)

