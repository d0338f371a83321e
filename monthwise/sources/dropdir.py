"""Directories into which files are dropped, as batch and as stream.

CSV lines that do not fit the schema are kept in the column ``malformed`` instead of failing
the job, and every row carries the file it came from in ``source_file``.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.config import FILE_GLOB
from monthwise.functions.text import record_key
from monthwise.session import materialise

MALFORMED = "malformed"
SOURCE_FILE = "source_file"

# Separators by character code.
COMMA, SEMICOLON = chr(44), chr(59)


def csv_options(sep: str = COMMA, encoding: str = "UTF-8", glob: str = FILE_GLOB) -> dict:
    """Header line, permissive parsing, and only an empty field (not ``""``) read as null.

    Every field is parsed even if a query needs few: with pruning, a line with too few or too
    many fields would pass as sound whenever the columns asked for happen to be there.
    """
    return {
        "header": "true",
        "sep": sep,
        "encoding": encoding,
        "pathGlobFilter": glob,
        "nullValue": "\u0001",
        "emptyValue": "",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": MALFORMED,
        "columnPruning": "false",
    }


def header_schema(spark: SparkSession, path: str, **options: str) -> T.StructType:
    """The header of a directory's files as string columns. Reads no records."""
    return spark.read.options(**csv_options(**options)).csv(path).schema


def list_files(spark: SparkSession, path: str, glob: str = FILE_GLOB) -> list[str]:
    """The files of a directory that fit ``glob``, or the one file."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    status = files.getFileStatus(where)
    if not status.isDirectory():
        return [status.getPath().toString()]
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(where, glob)) or []
    return sorted(s.getPath().toString() for s in found if s.isFile())


#: Bytes up to which files are packed into tasks to see their first lines, and bytes of one split of a longer one.
SMALL, SPLIT = 1 << 20, 128 << 20


def first_lines(spark: SparkSession, paths: Sequence[str], small: bool) -> DataFrame:
    """``path, line`` of the first line of each small, or each longer, file that has one, as bytes.

    Tasks find them, and nothing is opened on the driver. Small files are packed into tasks, in which a line whose
    file is another than that of the line before is a first one. Every split of a longer file is a task of its own,
    where it is the line at the start; the rest of the split is only cut into lines, a third of the work of reading it
    as CSV.
    """
    session = spark
    if not small:
        session = spark.newSession()
        for name in ("maxPartitionBytes", "openCostInBytes"):
            session.conf.set(f"spark.sql.files.{name}", str(SPLIT))
    size, start = F.col("_metadata.file_size"), F.col("_metadata.file_block_start")
    read = session.read.option("ignoreCorruptFiles", "true")
    lines = read.text(list(paths)).where(size <= SMALL if small else size > SMALL).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("line"),
        start.alias("start"),
    )
    if not small:
        place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
        return lines.where((place == 0) & (F.col("start") == 0)).select("path", "line")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            path = batch.column("path")
            begins = pc.not_equal(path, pa.concat_arrays([path.slice(0, 1), path.slice(0, len(path) - 1)]))
            begins = pa.concat_arrays([pa.array([path[0].as_py() != before]), begins.slice(1)])
            yield batch.filter(pc.and_(begins, pc.equal(batch.column("start"), 0)))
            before = path[-1].as_py()

    return lines.mapInArrow(first, lines.schema).select("path", "line")


def _kinds(spark: SparkSession, paths: Sequence[str]) -> list[bool]:
    """Whether there may be small files, and longer ones. Of few files the lengths are looked up, which saves a job."""
    if len(paths) > 100:
        return [True, False]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return sorted({w.getFileSystem(conf).getFileStatus(w).getLen() <= SMALL for w in where}, reverse=True)


def _plain(path: str) -> str:
    """A path without its scheme and host, to compare names that come from different places."""
    return re.sub(r"/+", "/", re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", path))


def file_headers(
    spark: SparkSession, paths: Sequence[str], sep: str = COMMA, encoding: str = "UTF-8"
) -> tuple[dict[tuple[str, ...], list[str]], dict[str, str]]:
    """Files by header, and unreadable files with the reason.

    Tasks read the headers; the driver gets each distinct first line with the files that begin with it.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    refused: dict[str, str] = {}
    given = {_plain(p): p for p in paths}
    if not given:
        return groups, refused
    rows = [
        row for small in _kinds(spark, paths)
        for row in first_lines(spark, paths, small)
        .groupBy("line").agg(F.collect_list("path").alias("files")).collect()
    ]
    for row in rows:
        files = [given.pop(unquote(_plain(f))) for f in row["files"]]
        try:
            line = bytes(row["line"]).decode(encoding)
        except UnicodeDecodeError as problem:
            refused |= {f: f"unreadable file: {problem}"[:200] for f in files}
            continue
        names = next(csv.reader([line.lstrip("\ufeff")], delimiter=sep), [])
        if not any(names):
            refused |= {f: "no header" for f in files}
        elif len(set(names)) < len(names):
            refused |= {f: "repeated column name" for f in files}
        else:
            groups.setdefault(tuple(names), []).extend(files)
    refused |= {f: "no header" for f in given.values()}  # no line at all, or none that could be unpacked
    return {names: sorted(files) for names, files in groups.items()}, refused


def read_csv_files(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | None = None,
    sep: str = COMMA,
    encoding: str = "UTF-8",
    key: str | None = None,
) -> tuple[DataFrame | None, dict[str, str]]:
    """Rows of files whose columns come in any order and number, matched by name; and the files
    that can't be read, with the reason.

    Each header is read with a schema of its own. Without ``schema`` the columns are those of all
    files, as strings; with one, exactly its columns, in its types. A column that a file lacks is
    null there; if it lacks all of them, its lines are malformed. ``key`` adds the hash of the columns that the own file has. None instead of rows if no
    file can be read.
    """
    groups, refused = file_headers(spark, paths, sep, encoding)
    declared = {f.name: f for f in schema.fields} if schema else {}
    rows = None
    for names, files in sorted(groups.items()):
        own = T.StructType([declared.get(n, T.StructField(n, T.StringType())) for n in names])
        options = csv_options(sep, encoding) | {"pathGlobFilter": "*"}
        if declared and not declared.keys() & set(names):
            # Nothing of the file can be used, so all its lines are misfits.
            options |= {"sep": "\u0001", "quote": ""}
            part = _with_file(spark.read.schema(f"{MALFORMED} string").options(
                **{k: v for k, v in options.items() if k != "columnNameOfCorruptRecord"}
            ).csv(files))
            names = (MALFORMED,)
        else:
            part = _with_file(
                spark.read.schema(with_malformed(own)).options(**options).csv(files)
            )
        if key:
            part = part.withColumn(key, record_key(part, names))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    if rows is not None and schema:
        have = rows.columns
        rows = rows.select(
            *[F.col(f"`{n}`") if n in have else F.lit(None).cast(f.dataType).alias(n)
              for n, f in declared.items() if n not in (MALFORMED, SOURCE_FILE)],
            MALFORMED, SOURCE_FILE, *([key] if key else []),
        )
    return rows, refused


def refused_files(spark: SparkSession, refused: dict[str, str]) -> DataFrame:
    """``source_file, reason`` of unreadable files."""
    return spark.createDataFrame(sorted(refused.items()), f"{SOURCE_FILE} string, reason string")


def stream_files(
    spark: SparkSession,
    path: str,
    glob: str = FILE_GLOB,
    archive_dir: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """``path`` of each new file once, without reading it. The directory may still be empty.

    What the files hold is read batch by batch, by the names of their columns; see
    :class:`monthwise.streaming.jobs.CsvJob`. ``archive_dir`` moves files there after they were processed.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob)
    return reader.options(**file_stream_options(archive_dir, files_per_batch)).load(path).select("path")


def with_malformed(schema: T.StructType) -> T.StructType:
    if MALFORMED in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])


def _with_file(df: DataFrame) -> DataFrame:
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """All matching files of a directory, or one file, their columns matched by name as in
    :func:`read_csv_files`. Fails on files that can't be read; that function lists them instead."""
    glob = options.pop("glob", FILE_GLOB)
    rows, refused = read_csv_files(spark, list_files(spark, path, glob), schema, **options)
    if refused:
        raise ValueError(f"files that can't be read: {refused}")
    if rows is None:
        raise ValueError(f"no file in {path} fits {glob}")
    return rows


def file_stream_options(archive_dir: str | None, files_per_batch: int | None) -> dict:
    options = {}
    if archive_dir:
        options.update(cleanSource="archive", sourceArchiveDir=archive_dir)
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    return options


def _reader(spark: SparkSession, streaming: bool, glob: str):
    reader = spark.readStream if streaming else spark.read
    return reader.option("pathGlobFilter", glob)


def json_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    streaming: bool = False,
    glob: str = "*.json",
) -> DataFrame:
    """One JSON object per line with a declared schema; broken lines go to ``malformed``."""
    reader = _reader(spark, streaming, glob).schema(with_malformed(schema))
    return _with_file(reader.option("columnNameOfCorruptRecord", MALFORMED).json(path))


def json_variants(
    spark: SparkSession, path: str, streaming: bool = False, glob: str = "*.json"
) -> DataFrame:
    """One JSON value per line without a schema: ``record`` is a variant, null if broken."""
    lines = _with_file(_reader(spark, streaming, glob).text(path))
    return lines.withColumn("record", F.try_parse_json("value"))


def text_lines(
    spark: SparkSession, path: str, streaming: bool = False, glob: str = "*"
) -> DataFrame:
    """Each line of each file as ``value``."""
    return _with_file(_reader(spark, streaming, glob).text(path))


def log_lines(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """Lines of extended-log files (plain or gzip)."""
    return text_lines(spark, path, glob=glob)


def parse_log(
    lines: DataFrame, fields: dict[str, str], file: str = SOURCE_FILE, value: str = "value"
) -> DataFrame:
    """Extended-log lines to typed columns.

    Each file names its columns in a ``#Fields:`` line; other ``#`` lines are comments, a lone
    ``-`` is null, double quotes keep blanks together. ``fields`` maps the wanted names to
    types. ``reason`` is set for lines whose file has no or contradicting ``#Fields:`` lines
    and for lines with a wrong number of values.

    The header side has one row per file. It is written first, so its size is known when the join
    is planned: below the broadcast limit the lines stay where they are, beyond it they are joined by
    file name and adaptive execution splits the partition of a huge file.
    """
    is_header = F.col(value).startswith("#Fields:")
    names = F.split(F.trim(F.regexp_replace(value, "^#Fields:", "")), r"\s+")
    headers = (
        lines.filter(is_header)
        .groupBy(file)
        .agg(F.min(names).alias("names"), F.max(names).alias("other_names"))
    )
    headers = materialise(headers, "log-headers")
    tokens = F.regexp_extract_all(value, F.lit(r'("(?:[^"]|"")*"|\S+)'), F.lit(1))
    tokens = F.transform(tokens, _log_value)
    records = (
        lines.filter(~F.col(value).startswith("#") & (F.trim(F.col(value)) != ""))
        .withColumn("tokens", tokens)
        .join(headers, file, "left")
    )
    reason = (
        F.when(F.col("names").isNull(), "no fields line")
        .when(F.col("names") != F.col("other_names"), "contradicting fields lines")
        .when(F.size("names") != F.size("tokens"), "wrong number of values")
    )
    checked = records.withColumn("reason", reason)
    row = F.when(F.col("reason").isNull(), F.map_from_arrays("names", "tokens"))
    typed = [
        F.col("row").getItem(name).try_cast(kind).alias(name) for name, kind in fields.items()
    ]
    kept = [c for c in lines.columns if c not in (file, value)]
    return checked.withColumn("row", row).select(file, *kept, value, *typed, "reason")


def _log_value(token: Column) -> Column:
    quoted = F.substring(token, 1, 1) == '"'
    inner = F.regexp_replace(F.regexp_replace(token, '^"|"$', ""), '""', '"')
    return F.when(quoted, inner).when(token != "-", token)


def write_lines(
    lines: DataFrame, column: str, header: str, path: str, compression: str = "none"
) -> None:
    """Write raw text lines as ``.csv`` files that each start with ``header``.

    For producing drop files from tables; lines are written as they are, broken ones included.
    """
    one = lines.select(F.col(column).alias(header))
    one.write.options(
        header="true", sep="\u0002", quote="\u0000", comment="\u0003", escapeQuotes="false", emptyValue="",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", compression=compression,
    ).csv(path)
