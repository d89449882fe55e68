"""Delimited-text sources. Every column is read as text."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from territory import schemas, settings


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, on any Hadoop file system."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def first_existing(spark: SparkSession, *paths: str) -> str | None:
    """First path that exists: plain text before its gzip copy, say."""
    return next((p for p in paths if path_exists(spark, p)), None)


#: Separators to tell apart; the first of equally good ones holds.
SEPARATORS = (",", ";", "\t", "|")
#: Lines of a file that its separator is told by.
SNIFFED_LINES = 200


def separator_of(lines: Sequence[str], quote: str = '"') -> str:
    """The separator that divides most lines into as many fields as the first one, two at least.

    Separators inside quotes do not count. Among equals the one with more
    fields holds, then the order of ``SEPARATORS``, which also gives the
    answer for a single column. Blank lines are passed over.
    """
    def fields(line: str, sep: str) -> int:
        try:
            return len(next(csv.reader([line], delimiter=sep, quotechar=quote, strict=True)))
        except csv.Error:  # a quote that ends before something else than this separator
            return 0

    best, chosen = (0, 0), SEPARATORS[0]
    solid = [line for line in lines if line.strip()]
    for sep in SEPARATORS if solid else ():
        counts = [fields(line, sep) for line in solid]
        fit = sum(n == counts[0] for n in counts), counts[0]
        if counts[0] > 1 and fit > best:
            best, chosen = fit, sep
    return chosen


def detect_separator(spark: SparkSession, path: str, quote: str = '"', encoding: str = "UTF-8") -> str:
    """Separator of a text table, told by its first lines; a few are read, through gzip and in any encoding."""
    # A separator that no text holds gives whole lines.
    raw = spark.read.options(header=False, sep="\x00", quote="", encoding=encoding).schema("line string").csv(path)
    return separator_of([(r["line"] or "").lstrip("\ufeff") for r in raw.limit(SNIFFED_LINES).collect()], quote)


def read_text_table(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str | None = ",",
    quote: str = '"',
    encoding: str = "UTF-8",
    skip_malformed: bool = False,
    spread: int | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Header file with every column as text; gzip is read by its suffix.

    Without ``sep`` the separator is told by the first lines (of the first file). Short rows are padded with nulls, or dropped when ``skip_malformed``.
    A gzip file is one task: ``spread`` deals its rows to that many tasks when
    few large archives would otherwise keep most tasks idle. A quoted field may
    hold line breaks with ``multiline``; a file is then one task too.
    """
    if sep is None:
        sep = detect_separator(spark, path if isinstance(path, str) else path[0], quote, encoding)
    reader = spark.read.options(
        header=True, inferSchema=False, sep=sep, quote=quote, escape=quote, encoding=encoding,
        mode="DROPMALFORMED" if skip_malformed else "PERMISSIVE", multiLine=multiline,
    )
    if skip_malformed:
        # A row can only be checked against the header if all of it is parsed.
        reader = reader.option("columnPruning", False)
    df = reader.csv(path)
    return df.repartition(spread) if spread else df


#: Files whose headers one job reads.
HEADERS_PER_JOB = 64


def header_groups(spark: SparkSession, paths: Sequence[str], **options) -> list[list[str]]:
    """Files grouped by identical header: the column names as Spark reads them.

    A limit of one row ends each file's scan at its first line, on any file
    system, in any encoding and through gzip.
    """
    reader_options = {"sep": options.get("sep", ","), "quote": options.get("quote", '"'), "escape": options.get("quote", '"')}
    reader = spark.read.options(header=False, encoding=options.get("encoding", "UTF-8"), **reader_options)
    groups: dict[tuple, list[str]] = {}
    for start in range(0, len(paths), HEADERS_PER_JOB):
        block = list(paths[start : start + HEADERS_PER_JOB])
        firsts = []
        for n, path in enumerate(block):
            line = reader.csv(path).limit(1)
            names = F.array(*[F.col(f"`{c}`") for c in line.columns])
            firsts.append(line.select(F.lit(n).alias("n"), names.alias("names")))
        # One short row per file of the caller's list.
        for row in reduce(DataFrame.unionByName, firsts).collect():
            names = tuple((name or "").lstrip("\ufeff") for name in row["names"])
            groups.setdefault(names, []).append(block[row["n"]])
    return [sorted(files) for _, files in sorted(groups.items())]


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_many_by_name(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    """Files with differing headers as one table; malformed rows are skipped.

    Spark applies one header to all files of a read, so files are read per
    header, however many files share it. With ``sep`` None the first file's
    separator is told by its lines, and holds for all.
    """
    options.setdefault("skip_malformed", True)
    if options.get("sep", ",") is None:
        told = {k: options[k] for k in ("quote", "encoding") if k in options}
        options["sep"] = detect_separator(spark, paths[0], **told)
    groups = header_groups(spark, paths, **options)
    return union_by_name([read_text_table(spark, files, **options) for files in groups])


def read_raw(spark: SparkSession, table: str, *paths: str) -> DataFrame:
    """Raw table from the first path that exists, else an empty table with
    the same columns (and a notice)."""
    path = first_existing(spark, *paths)
    if path is None:
        print(f"{table}: no file, skipped")
        return spark.createDataFrame([], schemas.raw_schema(table))
    return read_text_table(spark, path, spread=spread_of(spark, [path]), **schemas.RAW_FORMATS[table])


def spread_of(spark: SparkSession, paths: Sequence[str]) -> int | None:
    """Tasks to deal the rows of gzip archives to; None where no file is one."""
    if not any(path.endswith(".gz") for path in paths):
        return None
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";") -> DataFrame:
    """Header file with stated types; a malformed value becomes null."""
    return spark.read.schema(schema).options(header=True, sep=sep, enforceSchema=False).csv(path)


def zone_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Department to zone; codes are text, so leading zeros stay."""
    if path is not None:
        return spark.read.schema(schemas.ZONE_SCHEMA).csv(path, header=True)
    return spark.createDataFrame(list(settings.ZONES), schemas.ZONE_SCHEMA)
