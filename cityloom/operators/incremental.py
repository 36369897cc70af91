"""De-duplication of new rows against what a table holds, without reading the rows it holds.

Of every row of the table a digest is kept beside it, in files bucketed by the digest. New rows are numbered and probed by their digests alone, which move once, with the number of the row. What is left are the
numbers of the rows to be kept. Whole new rows are only shuffled where both the rows to be kept and the others are many, and then by their numbers, without digests.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from cityloom.session import hadoop_path, stage
from cityloom.sources.zones import Zone

BUCKETS = 64
#: Bytes kept of a digest. Of 10**12 different rows two have the same 16 with a chance of 1.5 in 10**15. Tables that were begun with whole digests go on with these.
DIGEST_BYTES, WHOLE_BYTES = 16, 32
#: Numbers of new rows are broadcast up to so many.
BROADCAST_DIGESTS = 400_000
_ROW = "_row_number"
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a whole row, the same for equal rows and, but for odds that need not be counted, for no others.

    A column that is NULL counts as one that is not there, so rows of runs with other columns compare as in their union; the order of the columns plays no part. 0.0 equals -0.0.
    """
    fields = sorted(df.schema, key=lambda f: f.name.lower())
    values = [(F.col(f"`{f.name}`") + 0.0 if isinstance(f.dataType, DoubleType | FloatType) else F.col(f"`{f.name}`")).alias(f.name.lower()) for f in fields]
    return F.unhex(F.sha2(F.to_json(F.struct(*values), _TIMES).cast("binary"), 256))


@contextmanager
def _bucketed(spark: SparkSession, path: str, buckets: int) -> Iterator[str]:
    """A name under which Spark reads and writes the bucketed files of a folder; the files stay when the name goes."""
    name = f"cityloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (run STRING, digest BINARY) USING parquet CLUSTERED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


def _special(digests: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Digests of new rows that the table does not hold, each once, with the number of the first row that has it."""
    first = digests.groupBy("digest").agg(F.min(_ROW).alias(_ROW))
    return first if stored is None else first.join(stored.select("digest"), "digest", "left_anti")


def append_distinct(
    zone: Zone,
    table: str,
    rows: DataFrame,
    mode: str = "append",
    partition_by: str | None = None,
    notes: dict | None = None,
    beside: dict[str, DataFrame] | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Write the rows that a table does not hold yet, each once; with ``mode='overwrite'`` they replace it, and its digests go with the old rows.

    Rows are equal as in a full-row de-duplication. A table, or runs of one, without digests gets them first, which reads its rows once; so does one whose digests were deleted. ``buckets`` counts for a new table:
    with the rows of all loads in mind, some millions to a bucket.
    """
    there = zone.exists(table)
    append = mode == "append" and there
    earlier = zone.notes(table).get("digests") if there else None
    state = earlier if append and earlier and _folder_exists(zone, table, earlier) else None
    run = uuid.uuid4().hex
    kept_state = state is not None
    if state is None:
        state = {"folder": f"_digests-{run}", "buckets": buckets, "runs": [], "bytes": DIGEST_BYTES}
    try:
        kept, held = _unseen(zone, table, rows, state, run, append)
        noted = {**(notes or {}), "digests": {**state, "runs": [*held, run]}}
        zone.write(table, kept, mode, partition_by, noted, beside, run)
    except Exception:
        if not kept_state:
            _delete_folder(zone, table, state)
        raise
    if earlier and earlier["folder"] != state["folder"]:
        _delete_folder(zone, table, earlier)


def _unseen(zone: Zone, table: str, rows: DataFrame, state: dict, run: str, append: bool) -> tuple[DataFrame, list[str]]:
    """The rows that the table does not hold, each once, and the runs of the table; their digests are written for ``run``."""
    spark, width = zone.spark, state.get("bytes", WHOLE_BYTES)

    def digest(df: DataFrame) -> Column:
        return F.substring(row_digest(df), 1, width).alias("digest")

    with _bucketed(spark, f"{zone.path(table)}/{state['folder']}", state["buckets"]) as name:
        held = list(zone.runs(table)) if append else []
        for other in held:
            if other not in state["runs"]:
                old = zone.read(table, runs=[other])
                _insert(spark, old.select(digest(old)).distinct(), other, name)
        # Digests of runs that were written but never became part of the table do not count.
        stored = spark.table(name).where(F.col("run").isin(held)) if held else None
        new = stage(rows.withColumn(_ROW, F.monotonically_increasing_id()), "new-rows")
        found = stage(_special(new.select(digest(new.drop(_ROW)), _ROW), stored), "new-digests")
        _insert(spark, found.select("digest"), run, name)
    return _numbered(new, found.select(_ROW)).select(*[f"`{column}`" for column in rows.columns]), held


def _numbered(new: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose numbers are to be kept. The counts are in the files' footers."""
    n_kept = kept.count()
    n_left = new.count() - n_kept
    if not n_left:
        return new
    if n_kept <= BROADCAST_DIGESTS:
        return new.join(F.broadcast(kept), _ROW, "left_semi")
    if n_left <= BROADCAST_DIGESTS:
        return new.join(F.broadcast(new.select(_ROW).join(kept, _ROW, "left_anti")), _ROW, "left_anti")
    return new.join(kept, _ROW, "left_semi")


def _folder_exists(zone: Zone, table: str, state: dict) -> bool:
    files, path = hadoop_path(zone.spark, f"{zone.path(table)}/{state['folder']}")
    return files.exists(path)


def _delete_folder(zone: Zone, table: str, state: dict) -> None:
    files, path = hadoop_path(zone.spark, f"{zone.path(table)}/{state['folder']}")
    files.delete(path, True)


def _insert(spark: SparkSession, digests: DataFrame, run: str, name: str) -> None:
    digests.select(F.lit(run).alias("run"), "digest").write.insertInto(name)
