"""SRC1-SRC5: sales sources.

Landed files are read as text by the names they carry (a CSV header, JSON fields), so a
reordered, missing or extra column is seen as such, bad values can be reported instead
of silently nulled by inference, and a line that does not parse is kept whole in
``_corrupt_record``.  JDBC reads are split into parallel range partitions when a
partition column is given.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesforge.errors import PipelineError
from salesforge.functions.schema import ValidationConfig
from salesforge.functions.semantics import num, ts
from salesforge.operators.validate import gate, require_columns

log = logging.getLogger(__name__)

#: The column that holds a line which does not have the file's columns; NULL otherwise.
CORRUPT = "_corrupt_record"


def _missing_path(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, CORRUPT] if n])


def csv_columns(spark: SparkSession, path: str, **options) -> list[str]:
    """The column names of a CSV header (reads one line)."""
    return spark.read.options(header=True, inferSchema=False, **options).csv(path).columns


def csv_headers(spark: SparkSession, path: str, **options) -> dict[str, list[str]]:
    """The files of a landing by the text of their first line.  The driver reads one line
    of each file, 32 files at a time; empty files are left out."""
    listing = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter")}
    files = sorted(spark.read.options(**listing).text(path).inputFiles())
    hadoop, java = spark._jvm.org.apache.hadoop, spark._jvm.java
    conf = spark._jsc.hadoopConfiguration()
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(uri: str) -> str | None:
        where = hadoop.fs.Path(java.net.URI(uri))
        raw = where.getFileSystem(conf).open(where)
        try:
            codec = codecs.getCodec(where)
            stream = raw if codec is None else codec.createInputStream(raw)
            return java.io.BufferedReader(java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            raw.close()

    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(32) as pool:
        for uri, line in zip(files, pool.map(first_line, files)):
            if line is not None:
                found.setdefault(line, []).append(uri)
    return found


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """SRC1: CSV with a header, every column of the file as text under its own name, and
    ``_corrupt_record``.  Files with different headers (order, missing or further columns)
    are read by the names they have and united, a column that a file lacks being NULL.
    ``schema`` skips reading the headers; its columns must be those of every file.  A
    missing path raises ``FileNotFoundError``."""
    def read(columns: T.StructType, paths: str | list[str]) -> DataFrame:
        return spark.read.schema(columns).options(
            header=True, mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord=CORRUPT, **options).csv(paths)

    try:
        if schema is not None:
            return read(schema, path)
        groups = csv_headers(spark, path, **options)
        if len(groups) <= 1:
            return read(text_schema(csv_columns(spark, path, **options)), path)
        parts = [read(text_schema(csv_columns(spark, files[0], **options)), files) for files in groups.values()]
        whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return whole.select(*[c for c in whole.columns if c != CORRUPT], CORRUPT)
    except AnalysisException as e:
        if _missing_path(e):
            raise FileNotFoundError(f"CSV file not found: {path}") from e
        raise


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False,
              sampling_ratio: float = 1.0) -> DataFrame:
    """SRC3: JSON lines (an array within one line is its records), or with ``multi_line``
    documents that span lines, each file one task.  Fields become text columns under the
    names the records have, found in one pass over ``sampling_ratio`` of them; ``schema``
    skips that pass.  Records that do not parse are kept in ``_corrupt_record``."""
    reader = spark.read.options(multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                                primitivesAsString=True, samplingRatio=sampling_ratio)
    try:
        if schema is None:
            names = [c for c in reader.json(path).columns if c != CORRUPT]
            schema = text_schema(names)
        return reader.schema(schema).json(path)
    except AnalysisException as e:
        if _missing_path(e):
            raise FileNotFoundError(f"JSON path not found: {path}") from e
        raise


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              properties: dict | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetchsize: int = 10_000) -> DataFrame:
    """SRC2: a table or a SQL query over JDBC.  With ``partition_column`` and bounds the
    read is split into ``num_partitions`` parallel range queries; a query is then read as
    a derived table."""
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None and partition_column is None:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", f"({query}) q" if query is not None else table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return r.load()


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parse_sales(df: DataFrame) -> DataFrame:
    """Text landing -> typed sales columns (bad values become NULL; use the gates or
    ``validate_sales(mode='quarantine')`` to report them)."""
    cols = {}
    if "date" in df.columns:
        cols["date"] = ts(df, "date")
    for c in ("quantity", "unit_price", "discount", "total_sales"):
        if c in df.columns:
            cols[c] = num(df, c)
    return df.withColumns(cols)


def warn_if_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():  # a one-row probe, not a count
        log.warning("Empty DataFrame extracted from %s", what)
    return df


def read_sales(spark: SparkSession, source_type: str, source_identifier: str | None = None,
               validation: ValidationConfig | None = None, **kw) -> DataFrame:
    """SRC4: dispatch on ``csv`` / ``database`` / ``api`` / ``parquet`` (case-insensitive)
    and run the SCH1-SCH3 gates when a ``validation`` config is given; the required
    columns are checked on the source's own columns either way.  A database identifier
    with a blank in it is a query, any other a table."""
    kind = (source_type or "").lower()
    if kind == "csv":
        df = read_csv(spark, source_identifier, **kw)
    elif kind == "database":
        is_query = source_identifier is not None and len(source_identifier.split()) > 1
        name = "query" if is_query else "table"
        df = read_jdbc(spark, kw.pop("url"), **({name: source_identifier} if source_identifier else {}), **kw)
    elif kind == "api":
        df = read_json(spark, source_identifier, **kw)
    elif kind == "parquet":
        df = read_parquet(spark, source_identifier)
    else:
        raise PipelineError(f"Unsupported source type: {source_type}", "EXTRACT_001",
                            {"source_type": source_type})
    if validation is not None:
        return gate(df, validation)
    return require_columns(df, ValidationConfig().required_columns)


def sample_sales(spark: SparkSession, n: int = 100, seed: int = 42, as_of: datetime | None = None) -> DataFrame:
    """SRC5: synthetic sales for demos: one row per day back from ``as_of``; quantity
    1..99, price 10..1000, discount 0..0.3, exact totals."""
    as_of = as_of or datetime(2024, 1, 1)
    base = spark.range(n)
    q = (F.floor(F.rand(seed) * 99) + 1).cast("double")
    p = F.lit(10.0) + F.rand(seed + 1) * F.lit(990.0)
    d = F.rand(seed + 2) * F.lit(0.3)
    out = base.select(
        (F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz") - F.make_interval(days=F.col("id").cast("int")))
        .alias("date"),
        F.format_string("PROD_%03d", F.col("id") + 1).alias("product_id"),
        q.alias("quantity"), p.alias("unit_price"), d.alias("discount"))
    return out.withColumn("total_sales", F.col("quantity") * F.col("unit_price") * (F.lit(1) - F.col("discount")))
