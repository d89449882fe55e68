"""Watermark-incremental load with replacement by key."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from territory.operators.joins import exclude


#: Folder name for rows without a date.
NO_YEAR = "none"


def newer_than_stored(existing: DataFrame, incoming: DataFrame, ts: Column | str, stored: str) -> DataFrame:
    """Incoming rows dated strictly after the stored maximum; all of them when
    nothing is stored yet."""
    when = F.col(ts) if isinstance(ts, str) else ts
    mark = existing.select(F.max(stored)).scalar()
    return incoming.filter(mark.isNull() | (when > mark))


def replace_by_key(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Drop every old row of a key that comes again, add all its new rows.

    Columns that only one side has are null on the other.
    """
    return exclude(existing, new, key).unionByName(new, allowMissingColumns=True)


def incremental_load(
    existing: DataFrame, incoming: DataFrame, ts: str, key: str
) -> DataFrame:
    """New state of the table: old rows, less replaced keys, plus new rows."""
    return replace_by_key(existing, newer_than_stored(existing, incoming, ts, ts), key)


def _manifest(spark: SparkSession, root: str, version: int) -> dict[str, str]:
    """Folder of each year of a version: one entry per year."""
    rows = spark.read.parquet(f"{root}/manifest/v{version}").collect()
    return {r["year"]: r["folder"] for r in rows}


def _read(spark: SparkSession, root: str, folders: dict[str, str]) -> DataFrame:
    """Rows of some years, each with its year."""
    frames = [
        spark.read.parquet(f"{root}/{folder}").withColumn("_year", F.lit(year)) for year, folder in folders.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The rows of a version, whichever loads wrote them."""
    return _read(spark, root, _manifest(spark, root, version)).drop("_year")


#: Bits of a key filter per key, bits that a key sets, and bits of the word that they lie in.
BITS_PER_KEY = 16
KEY_BITS = 3
WORD_BITS = 64


def _mask(key: Column) -> Column:
    bits = [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(WORD_BITS)) for i in range(1, KEY_BITS + 1)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int")) for bit in bits])


def _word(key: Column, words: Column) -> Column:
    return F.pmod(F.xxhash64(key), words)


def write_key_filters(spark: SparkSession, root: str, version: int, key: str) -> None:
    """What the files that a load wrote can hold: smallest and largest key, and a filter of their keys.

    A filter is a row per word of bits; all bits of a key lie in one word, told by the key's hash. Words
    (a power of two) are enough for ``BITS_PER_KEY`` bits per key. Rows are numbers only, so a task
    adds them up in a hash table of some bytes per key, whatever the size of its files.
    """
    place = F.regexp_extract("_metadata.file_path", f"^.*/(data/v{version}/.*)$", 1)
    stored = spark.read.parquet(f"{root}/data/v{version}").filter(F.col(key).isNotNull())
    keys = stored.select(F.col(key).alias("key"), F.xxhash64(place).alias("id"), place.alias("file"))
    needed = F.greatest(F.count(F.lit(1)) * BITS_PER_KEY / WORD_BITS, F.lit(1.0))
    words = F.pow(F.lit(2.0), F.ceil(F.log2(needed))).cast("long")
    files = keys.groupBy("id", "file").agg(F.min("key").alias("low"), F.max("key").alias("high"), words.alias("words"))
    files.write.mode("overwrite").parquet(f"{root}/keys/v{version}/files")
    sized = keys.select("key", "id").join(spark.read.parquet(f"{root}/keys/v{version}/files").select("id", "words"), "id")
    placed = sized.select("id", "words", _word(F.col("key"), F.col("words")).alias("word"), _mask(F.col("key")).alias("mask"))
    filters = placed.groupBy("id", "words", "word").agg(F.bit_or("mask").alias("bits"))
    filters.write.mode("overwrite").parquet(f"{root}/keys/v{version}/filters")


def files_with_keys(spark: SparkSession, root: str, folders: Iterable[str], keys: DataFrame) -> list[str]:
    """Files of ``folders`` that can hold one of ``keys`` (one column), relative to ``root``.

    Some may hold none; none that holds one is missing. Only the statistics
    are read: a key meets the words of filters that it falls in, by an equi-join.
    """
    listed = sorted(folders)
    versions = sorted({folder.split("/")[1] for folder in listed})

    def of(kind: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [spark.read.parquet(f"{root}/keys/{v}/{kind}") for v in versions])

    name = keys.columns[0]
    keys = keys.filter(F.col(name).isNotNull()).select(F.col(name).alias("key")).distinct()
    ends = keys.agg(F.min("key").alias("first"), F.max("key").alias("last")).first()
    if not listed or ends["first"] is None:
        return []
    near = of("files").filter(F.regexp_extract("file", "^(.*)/[^/]*$", 1).isin(listed))
    near = near.filter((F.col("high") >= F.lit(ends["first"])) & (F.col("low") <= F.lit(ends["last"])))
    sizes = [r["words"] for r in near.select("words").distinct().collect()]  # powers of two: some 40 at most
    if not sizes:
        return []
    asked = keys.withColumn("words", F.explode(F.array(*[F.lit(n).cast("long") for n in sorted(sizes)])))
    asked = asked.withColumn("word", _word(F.col("key"), F.col("words")))
    met = asked.join(of("filters").join(near.select("id", "file", "low", "high"), "id"), ["words", "word"])
    mask = _mask(F.col("key"))
    held = F.col("key").between(F.col("low"), F.col("high")) & (F.col("bits").bitwiseAND(mask) == mask)
    return sorted(r["file"] for r in met.filter(held).select("file").distinct().collect())  # a row per file to open


def drop_version(spark: SparkSession, root: str, version: int) -> None:
    """Take back the newest version: nothing that an older one lists is touched."""
    for part in ("manifest", "keys", "data"):
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{part}/v{version}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def load_version(
    spark: SparkSession, root: str, incoming: DataFrame, ts: str, key: str, version: int
) -> DataFrame:
    """Version ``version`` of the table under ``root``: the previous one and the new rows.

    Rows lie in a folder per year, and a version is a list of such folders. A
    load takes the watermark from the newest year, finds the years that the
    new rows or the rows they replace lie in (for the latter the key column of
    those files is read that can hold one of the new keys), and writes these
    years anew; all others are listed as they are, so a daily load costs what it
    touches. Nothing that an older
    version lists is changed. The first load has version 1; a load that is
    repeated gives the same version again.
    """
    year = F.coalesce(F.year(ts).cast("string"), F.lit(NO_YEAR))
    stored = _manifest(spark, root, version - 1) if version > 1 else {}
    dated = sorted(y for y in stored if y != NO_YEAR)
    if dated:
        mark = _read(spark, root, {dated[-1]: stored[dated[-1]]}).agg(F.max(ts)).first()[0]
        incoming = incoming.filter(F.col(ts) > F.lit(mark))
    new = incoming.withColumn("_year", year)
    touched = set(stored)
    if stored:
        years = new.select("_year")
        files = files_with_keys(spark, root, stored.values(), incoming.select(key))
        if files:
            year_of = F.regexp_extract("_metadata.file_path", "/_year=([^/]*)/[^/]*$", 1)
            old_keys = spark.read.parquet(*[f"{root}/{f}" for f in files]).select(key, year_of.alias("_year"))
            years = years.union(old_keys.join(incoming.select(key).distinct(), key, "left_semi").select("_year"))
        touched = {r["_year"] for r in years.distinct().collect()}  # a row per year
    again = {y: folder for y, folder in stored.items() if y in touched}
    state = replace_by_key(_read(spark, root, again), new, key) if again else new
    if stored and not touched:
        folders = stored
    else:
        data = f"data/v{version}"
        # Rows of a year meet in tasks of the advised size, so a year is a few large files.
        state.hint("rebalance", "_year").write.mode("overwrite").partitionBy("_year").parquet(f"{root}/{data}")
        write_key_filters(spark, root, version, key)
        written = spark.read.option("recursiveFileLookup", False).schema("_year string").parquet(f"{root}/{data}")
        years = [r["_year"] for r in written.distinct().collect()]
        folders = {y: f for y, f in stored.items() if y not in touched} | {y: f"{data}/_year={y}" for y in years}
    rows = sorted(folders.items())
    manifest = spark.createDataFrame(rows, "year string, folder string")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/v{version}")
    return read_version(spark, root, version)
