"""Landing files as DataFrames with provenance.

A landing folder holds CSV (with header), JSON-lines and Parquet files side by side; anything
else in it is ignored. Files may differ in schema. All files of one format and schema are read
by one scan, never one frame per file, and their schemas are found by one pass over the files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyarrow.parquet import ParquetFile
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from cityloom.operators.skew import balanced_join
from cityloom.session import stage

FORMATS = ("csv", "json", "parquet")
SOURCE = "source_entry"
# A scan names its files up to this many.
FEW_FILES = 1_000
_FILE = "_source_file"

# How deep the files lie below the landing folder, and which part of the path names the entry.
# An entry may be a folder written by Spark, also one named ``column=value``: the value counts.
LAYOUTS = {
    "flat": ("*", r"/(?:[^/=]+=)?([^/]+\.(?:csv|json|parquet))(?:/part-[^/]*)?$"),
    "daily": ("*/*", r"/(?:[^/=]+=)?([^/]+)/[^/]+\.(?:csv|json|parquet)(?:/part-[^/]*)?$"),
}


# Names of folders that stand for themselves in a path pattern.
_PLAIN_NAME = re.compile(r"[\w.+ =-]+")


def files_like(root: str, layout: str, file_format: str, folders: Sequence[str] | None = None) -> str:
    """Path pattern of the files of one format below ``root``; of a daily layout only those in some ``folders``, where these are few and have plain names."""
    depth, _ = LAYOUTS[layout]
    if layout == "daily" and folders and len(folders) <= FEW_FILES and all(map(_PLAIN_NAME.fullmatch, folders)):
        depth = "{" + ",".join(folders) + "}/*"
    return f"{root.rstrip('/')}/{depth}.{file_format}"


def listing(spark: SparkSession, pattern: str) -> DataFrame | None:
    """The files a path pattern matches, contents unread, as (file, length, modified), the names as scans report them; None if nothing matches."""
    try:
        found = spark.read.format("binaryFile").load(pattern)
        return found.select(F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def as_path(name: str) -> str:
    """A file name as Spark reports it, usable as a path again."""
    # Names come back encoded as URLs, and a reader would take some characters as a pattern.
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(name))


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the matching files, usable as paths again."""
    found = listing(spark, pattern)
    return [] if found is None else [as_path(name) for name in sorted(found.inputFiles())]


def entry_name(layout: str) -> Column:
    """File name (flat layout) or day-folder name (daily layout) of the row's file."""
    return entry_of(F.col("_metadata.file_path"), layout)


def entry_of(path: Column, layout: str) -> Column:
    _, pattern = LAYOUTS[layout]
    # The pattern looks at three names at most, the end of the path; trying it all along the path costs more than the rest of a row.
    end = F.substring_index(path, "/", -4)
    name = F.regexp_extract(end, pattern, 1)
    # Only special characters are encoded in the path, and a plus sign is not one of them.
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(name, F.lit("%")), decoded).otherwise(name)


def read_files(
    spark: SparkSession, file_format: str, files: list[str] | str, schema: StructType | str | None = None, by_position: bool = False
) -> DataFrame:
    """One scan over ``files``. CSV values stay strings; a CSV header that contradicts the schema fails, unless columns go ``by_position``."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if file_format == "csv":
        return reader.csv(files, header=True, enforceSchema=by_position)
    if file_format == "parquet":
        return reader.option("mergeSchema", schema is None).parquet(*([files] if isinstance(files, str) else files))
    return reader.json(files)


def _headers(spark: SparkSession, pattern: str) -> DataFrame:
    """Header line of each CSV file, as (file, kind); files of blank lines only are left out.

    One pass: the header is the first line with content, as for the reader, in the piece that begins a file, and row ids grow within a piece. A file whose first piece is
    blank, but not those after it, has the kind NULL.
    """
    lines = spark.read.text(pattern).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value", F.monotonically_increasing_id().alias("at")
    )
    header = F.expr("min_by(value, at) FILTER (WHERE begin = 0)")
    return lines.where("trim(value) <> ''").groupBy("file").agg(header.alias("kind"))


def _json_types(spark: SparkSession, pattern: str) -> DataFrame:
    """Schema of each JSON file, as (file, kind), aggregated from its lines in one pass; files of empty objects have an empty one."""
    lines = spark.read.text(pattern).where("trim(value) <> ''")
    types = F.schema_of_variant_agg(F.try_parse_json("value"))
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(types.alias("kind"))


def _json_schema(kind: str) -> StructType:
    """A schema from the text in which variants name it; what differs within a file is text."""
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", kind)
    ddl = re.sub(r"\bDECIMAL\(\d+,\d+\)", "DOUBLE", ddl)
    ddl = re.sub(r": (?:VARIANT|VOID)\b", ": STRING", ddl)
    ddl = re.sub(r"<(?:VARIANT|VOID)>", "<STRING>", ddl)
    return StructType.fromDDL(ddl[len("STRUCT<") : -1]) if ddl.startswith("STRUCT<") and ddl != "STRUCT<>" else StructType([])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The schema of each Parquet file as its footer has it, with the writer's notes on types."""
    for batch in batches:
        files = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array([_footer(name) for name in files], pa.string())], ["file", "kind"])


def _footer(name: str) -> str:
    system, path = FileSystem.from_uri(name)
    with system.open_input_file(path) as file:
        schema = ParquetFile(file).schema_arrow
    notes = sorted((schema.metadata or {}).items())
    return f"{schema.remove_metadata()} {[value for key, value in notes if key.startswith(b'org.apache.spark')]}"


def _parquet_kinds(spark: SparkSession, pattern: str) -> DataFrame:
    """Footer of each Parquet file, as (file, kind): read by tasks over the listed files.

    Where the file system is one that only Spark reaches, the driver asks for one schema after another, a small job each; declare a schema where there are many files then.
    """
    files = listing(spark, pattern).select("file")
    some = files.first()
    try:
        _footer(some.file) if some else None
    except (OSError, pa.ArrowException):
        names = list_files(spark, pattern)
        with ThreadPoolExecutor(16) as pool:
            schemas = pool.map(lambda name: read_files(spark, "parquet", [name]).schema.json(), names)
        return spark.createDataFrame(list(zip([quote(name, safe="/:=") for name in names], schemas, strict=True)), "file string, kind string")
    return files.mapInArrow(_footers, "file string, kind string")


def _groups(spark: SparkSession, file_format: str, pattern: str) -> list[tuple[StructType, DataFrame]]:
    """The schemas of the files and, for each, the names of its files; the number of jobs follows that of the schemas.

    One JSON file may hold only empty arrays or partial structs, so nested types are taken from all files. A CSV file with content in which no header is found is an error.
    """
    kinds = stage({"csv": _headers, "json": _json_types, "parquet": _parquet_kinds}[file_format](spark, pattern), "file-kinds")
    if lost := kinds.where("kind IS NULL").first():
        raise ValueError(f"no header at the beginning of {lost.file}")
    found = []
    shared = {}
    if file_format == "json":
        shared = {f.name: f for f in read_files(spark, file_format, pattern).schema if isinstance(f.dataType, ArrayType | StructType)}
    for row in kinds.groupBy("kind").agg(F.min("file").alias("sample")).orderBy("sample").collect():
        if file_format != "json":
            schema = read_files(spark, file_format, [as_path(row.sample)]).schema
        else:
            schema = StructType([shared.get(f.name, f) for f in _json_schema(row.kind)])
        found.append((schema, kinds.where(F.col("kind") == row.kind).select("file")))
    merged: dict[str, tuple[StructType, DataFrame]] = {}
    for schema, files in found:
        known = merged.get(schema.json())
        merged[schema.json()] = (schema, known[1].union(files) if known else files)
    return list(merged.values())


def _grouped(
    spark: SparkSession, file_format: str, pattern: str, layout: str, declared: StructType | None = None, only: DataFrame | None = None
) -> list[DataFrame]:
    """One frame per schema of the files, each with the column ``source_entry``. With a ``declared`` schema it has the declared types of the columns the files have."""
    groups = _groups(spark, file_format, pattern)
    if only is not None:
        groups = [(schema, balanced_join(files, only, ["file"], "left_semi")) for schema, files in groups]
    frames = []
    for schema, files in groups:
        if declared is not None:
            own = {name.lower() for name in schema.names}
            schema = StructType([f for f in declared if f.name.lower() in own]) if file_format != "csv" else schema
        named = files.limit(FEW_FILES + 1).collect()
        few = len(named) <= FEW_FILES
        paths = [as_path(row.file) for row in named] if few and len(groups) > 1 else pattern
        if schema.fields:
            frame = read_files(spark, file_format, paths, schema, by_position=not few and len(groups) > 1)
        else:
            frame = spark.read.text(paths).where("trim(value) <> ''").select()
        columns = [F.col(f"`{name}`") for name in frame.columns]
        if declared is not None and file_format == "csv":
            types = {f.name.lower(): f.dataType for f in declared}
            columns = [F.col(f"`{name}`").try_cast(types[name.lower()]).alias(name) for name in frame.columns if name.lower() in types]
        frame = frame.select(*columns, entry_name(layout).alias(SOURCE), F.col("_metadata.file_path").alias(_FILE))
        if only is not None or not few and len(groups) > 1:
            # Every file is read and those of other schemas are left out: file names are too many for one plan.
            frame = balanced_join(frame, files.withColumnRenamed("file", _FILE), [_FILE], "left_semi")
        frames.append(frame.drop(_FILE))
    return frames


def landing_frames(
    spark: SparkSession,
    root: str,
    layout: str = "flat",
    schema: StructType | str | None = None,
    by_schema: bool = False,
    folders: Sequence[str] | None = None,
    only: DataFrame | None = None,
) -> list[DataFrame]:
    """One frame per format and distinct schema, each with the column ``source_entry``.

    With a declared ``schema`` each format is one scan without any discovery. Without one, JSON
    columns are inferred over all files together, Parquet footers are merged (falling back to
    groups when types conflict), and CSV files are grouped by header. ``by_schema`` forces grouping
    for every format, so that files lacking a column can be told apart from files with NULLs; a declared schema then gives
    the types of the columns that a file has. ``folders`` are the only day folders looked at, and ``only`` has the only files whose rows are kept, in a column ``file``.
    """
    frames = []
    for file_format in FORMATS:
        pattern = files_like(root, layout, file_format, folders)
        there = listing(spark, pattern)
        if there is None or there.isEmpty():
            continue
        if by_schema:
            declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
            found = _grouped(spark, file_format, pattern, layout, declared, only)
        elif schema is not None:
            found = [read_files(spark, file_format, pattern, schema)]
        elif file_format == "csv":
            found = _grouped(spark, file_format, pattern, layout, only=only)
        else:
            try:
                found = [read_files(spark, file_format, pattern)]
            except Exception as error:
                if file_format != "parquet" or "CANNOT_MERGE_SCHEMA" not in str(error):
                    raise
                found = _grouped(spark, file_format, pattern, layout, only=only)
        if only is not None:
            chosen, sourced = only.select(F.col("file").alias(_FILE)), [frame.select("*", F.col("_metadata.file_path").alias(_FILE)) for frame in found if SOURCE not in frame.columns]
            kept = [balanced_join(frame, chosen, [_FILE], "left_semi") for frame in sourced]
            found = [frame for frame in found if SOURCE in frame.columns] + [frame.select("*", entry_of(F.col(_FILE), layout).alias(SOURCE)).drop(_FILE) for frame in kept]
        frames += [frame if SOURCE in frame.columns else frame.select("*", entry_name(layout).alias(SOURCE)) for frame in found]
    return frames


def with_year(df: DataFrame, name: str = "year") -> DataFrame:
    """Year as text: the first four characters of the file name."""
    return df.withColumn(name, F.substring(SOURCE, 1, 4))


def with_day(df: DataFrame, name: str = "date") -> DataFrame:
    """Date from the ``yyyy_MM_dd`` start of the folder name; NULL where it is none."""
    return df.withColumn(name, F.try_to_date(F.substring(SOURCE, 1, 10), "yyyy_MM_dd"))
