"""FPR1: an order-insensitive content fingerprint of a table.

A row's text holds every column's name and either its value or a null mark, so that a
value that moves to another column, or a column that is renamed, changes it.  The sum of
the rows' hashes (60 bits of an MD5, as ``decimal(38,0)``) does not depend on row order
or partitioning.  Use it to key reuse of persisted intermediates.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "\x1f"


def _on_grid(c: Column, places: int) -> Column:
    """A double as a whole number of steps of ``places`` decimal places: one multiplication
    and one rounding (half to even) that every engine does alike.  What has no such number
    (beyond 2^62 steps, NaN) is written as it is."""
    steps = F.rint(c * F.lit(10.0 ** places))
    return F.when(F.abs(steps) < F.lit(2.0 ** 62), steps.cast("bigint").cast("string")).otherwise(c.cast("string"))


def _exact(c: Column) -> Column:
    """A double as two whole numbers that are together its exact value and that every
    engine prints alike: steps of 2^-20, and what is left in steps of 2^-82.  What has no
    such numbers (under 2^-30 but not 0, from 2^42 on, NaN) is written as it is."""
    scaled = c * F.lit(2.0 ** 20)
    steps = scaled.cast("bigint")
    rest = ((scaled - steps.cast("double")) * F.lit(2.0 ** 62)).cast("bigint")
    fits = (F.abs(c) < F.lit(2.0 ** 42)) & ((F.abs(c) >= F.lit(2.0 ** -30)) | (c == 0))
    return F.when(fits, F.concat(steps.cast("string"), F.lit(":"), rest.cast("string"))).otherwise(c.cast("string"))


def _cell(f: T.StructField, places: int | None, portable: bool) -> Column:
    c = F.col(f"`{f.name}`")
    if places is not None and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        value = _on_grid(c.cast("double"), places)
    elif portable and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        value = _exact(c.cast("double"))
    elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(c)
    else:
        value = c.cast("string")
    return F.coalesce(F.concat(F.lit(f"{f.name}="), value), F.lit(f"{f.name}!"))


def row_key(df: DataFrame, places: int | None = None, portable: bool = False) -> Column:
    """A key of a row's content: the MD5 of its text.  Equal rows have equal keys."""
    return F.md5(F.concat_ws(SEPARATOR, *[_cell(f, places, portable) for f in df.schema.fields]))


def _row_hash(df: DataFrame, places: int | None, portable: bool = False) -> Column:
    return F.conv(F.substring(row_key(df, places, portable), 1, 15), 16, 10).cast("bigint").cast("decimal(38,0)")


def _total(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("decimal(38,0)")).cast("string")


def fingerprint(df: DataFrame, places: int | None = None, portable: bool = False) -> DataFrame:
    """One row: ``rows`` and ``fingerprint`` (the sum of the row hashes, as text).  With
    ``places`` doubles count as equal that agree when rounded to so many decimal places;
    without, only equal ones do.  ``portable`` writes equal ones as other engines can too,
    not as this Java version prints them."""
    hashed = df.select(_row_hash(df, places, portable).alias("h"))
    return hashed.agg(F.count(F.lit(1)).alias("rows"), _total("h").alias("fingerprint"))


FILE_SUMS = "about string, file string, size long, time timestamp, rows long, h decimal(38,0)"
_FILE = {"file": "file_path", "size": "file_size", "time": "file_modification_time"}


def _with_file(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(f"_metadata.{c}") for name, c in _FILE.items()})


def fingerprint_files(spark: SparkSession, path: str, store: str, *, places: int | None = None, fmt: str = "parquet",
                      max_paths: int = 10_000, **options) -> DataFrame:
    """``fingerprint`` of a folder of files, hashing only files that ``store`` does not know.

    The fingerprint is a sum over rows, so a file has a sum of its own.  ``store`` (a
    Parquet folder) keeps it by the file's path, size and time and by the schema and
    ``places`` it was hashed with; files that are gone or were rewritten simply find no
    match.  An append is read alone; more than ``max_paths`` new files are not passed by
    name but picked out of the whole folder.  Returns one row: rows, fingerprint, files,
    files_hashed.  An entry that is written twice (by a repeated job) counts once."""
    whole = spark.read.format(fmt).options(**options).load(path)
    about = hashlib.md5(json.dumps([whole.schema.jsonValue(), fmt, places], sort_keys=True).encode()).hexdigest()
    keys = list(_FILE)
    # Only the listing: the files' content is not read.
    listed = _with_file(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)).select(*keys)
    listed = listed.where(~F.element_at(F.split("file", "/"), -1).rlike("^[._]"))

    def known() -> DataFrame:
        try:
            held = spark.read.schema(FILE_SUMS).parquet(store)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            held = spark.createDataFrame([], FILE_SUMS)
        return held.where(F.col("about") == about).drop("about").dropDuplicates(keys)

    new = listed.join(known(), keys, "left_anti")
    n_new = new.count()
    if n_new:
        if n_new <= max_paths:
            names = [r["file"] for r in new.select("file").collect()]
            rows = _with_file(spark.read.schema(whole.schema).format(fmt).options(**{"basePath": path, **options}).load(names))
        else:
            rows = _with_file(whole).join(new, keys, "left_semi")
        sums = rows.select(*keys, _row_hash(whole, places).alias("h")).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum("h").alias("h"))
        done = new.join(sums, keys, "left").select(F.lit(about).alias("about"), *keys, F.coalesce("rows", F.lit(0)).alias("rows"),
                                                   F.coalesce("h", F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").alias("h"))
        done.write.mode("append").parquet(store)
    return listed.join(known(), keys).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), _total("h").alias("fingerprint"),
                                          F.count(F.lit(1)).alias("files")).withColumn("files_hashed", F.lit(n_new).cast("bigint"))


def fingerprint_key(df: DataFrame, params: dict | None = None) -> str:
    """The content, the schema and the parameters of what is computed from it, as a key."""
    r = fingerprint(df).first()
    about = json.dumps([df.schema.jsonValue(), params or {}], sort_keys=True, default=str)
    return f"{r['rows']}-{r['fingerprint']}-{hashlib.md5(about.encode()).hexdigest()}"


def memoize(df: DataFrame, fn: Callable[[DataFrame], DataFrame], store_dir: str, name: str,
            params: dict | None = None) -> DataFrame:
    """Reuse ``fn(df)`` across runs: the result is written once to
    ``store_dir/name/<key of input and params>`` (a shared folder, e.g. under the
    cluster's checkpoint directory) and read back on later calls.  ``params`` must hold
    whatever else ``fn`` depends on.  Only a missing result is computed; any other read
    error is raised."""
    path = os.path.join(store_dir, name, fingerprint_key(df, params))
    spark = df.sparkSession
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    fn(df).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
