"""SNK1-SNK7: sales sinks.

Loads write the typed ``sales_records`` projection; rows that cannot be typed go to a
quarantine output instead of being dropped silently.  A load runs under a run id: staged
once, written, and committed by one step that enters the id in a ledger, so it can be
repeated after a failure.  Writes are partition-parallel (no per-row Python, no driver
loop); JDBC uses ``batchsize``.  Archive paths are keyed by a run timestamp and never overwritten, and
per-run outputs are written whole by one job, so a retried job rewrites the same path.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesforge.errors import PipelineError
from salesforge.functions.schema import SALES_RECORDS_DDL, UPLOAD_REQUIRED
from salesforge.functions.semantics import num, ts
from salesforge.scratch import Scratch

RECORD_COLUMNS = ["date", "product_id", "quantity", "unit_price", "discount", "total_sales"]
DEFAULT_BATCH = 1000
LEDGER_DDL = "accepted BIGINT, rejected BIGINT"


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """SNK1: CSV with a header and no index column (one directory of part files)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def timestamped(base_dir: str, prefix: str, run_ts: datetime) -> str:
    return os.path.join(base_dir, f"{prefix}_{run_ts.strftime('%Y%m%d_%H%M%S')}")


def tag_records(df: DataFrame) -> DataFrame:
    """The rows with their typed values (struct ``typed``) and the reason of a reject.
    Every value is parsed once, in a projection of its own; the reason looks at what came
    out."""
    pid = F.regexp_replace(F.col("product_id").cast("string"), "P", "").try_cast("int")
    q = num(df, "quantity")
    typed = {"date": F.to_date(ts(df, "date")), "product_id": pid,
             "quantity": F.when(q.isNotNull() & (F.abs(q) < F.lit(2.0 ** 31)), q.cast("int")),
             "unit_price": num(df, "unit_price"), "discount": num(df, "discount"), "total_sales": num(df, "total_sales")}
    parsed = df.select("*", *[v.alias(f"_typed_{c}") for c, v in typed.items()])
    got = {c: F.col(f"_typed_{c}") for c in typed}
    bad = [(c, got[c].isNull()) for c in ["date", "product_id", "quantity", "unit_price", "total_sales"]]
    bad.append(("discount", F.col("discount").isNotNull() & got["discount"].isNull()))
    reason = F.coalesce(*[F.when(b, F.lit(f"{c}_invalid")) for c, b in bad], F.lit(None).cast("string"))
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns], F.struct(*[v.alias(c) for c, v in got.items()]).alias("typed"), reason.alias("reason"))


def accepted_records(tagged: DataFrame) -> DataFrame:
    return (tagged.where(F.col("reason").isNull()).select("typed.*")
            .withColumn("discount", F.coalesce(F.col("discount"), F.lit(0.0)))
            .withColumn("created_at", F.current_timestamp()))


def rejected_records(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reason").isNotNull()).drop("typed")


def to_sales_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SNK2 projection: (records, rejects).  date -> DATE, 'P123' -> 123, quantity ->
    INT, a missing discount -> 0; a row with a value that does not type is rejected with
    all its values as they came and a reason."""
    tagged = tag_records(df)
    return accepted_records(tagged), rejected_records(tagged)


@dataclass
class LoadResult:
    accepted: int
    rejected: int


def _run(run_id: str | None) -> str:
    run_id = run_id or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9_.:-]{1,200}", run_id):
        raise PipelineError(f"Run id has other characters than letters, digits and _.:- : {run_id!r}", "LOAD_400")
    return run_id


def _staged(df: DataFrame, scratch: Scratch) -> tuple[DataFrame, LoadResult]:
    """The tagged rows, computed once and written, and their counts.  Every output of a
    load reads these files, so a source that changes or repeats its rows differently
    cannot put a row into both outputs or into none."""
    tagged = scratch.table(tag_records(df), "load")
    seen = tagged.agg(F.count_if(F.col("reason").isNull()), F.count_if(F.col("reason").isNotNull())).first()
    return tagged, LoadResult(*seen)


def _replace_run(rows: DataFrame, table: str, run_id: str, ddl: str | None = None) -> None:
    """Make ``rows`` the run's partition of ``table`` (created if absent), whatever an
    earlier attempt has left there."""
    spark = rows.sparkSession
    fields = ddl or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({fields}, run_id STRING) USING parquet PARTITIONED BY (run_id)")
    names = [c for c in spark.table(table).columns if c != "run_id"]
    if set(names) != set(rows.columns):
        raise PipelineError(f"Table {table} has columns {names}, the load has {rows.columns}", "LOAD_409")
    view = f"run_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (run_id = '{run_id}') SELECT {', '.join(f'`{c}`' for c in names)} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def load_to_table(df: DataFrame, table: str, quarantine_table: str | None = None,
                  analyze: str | None = "noscan", run_id: str | None = None) -> LoadResult:
    """SNK2 into a catalog table (created if absent); rejects go to ``quarantine_table``,
    ``<table>_rejects`` by default.

    A load is repeatable: its rows are staged once, both tables are partitioned by
    ``run_id`` and a run replaces its own partitions, and ``<table>_loads`` gets the run's
    counts last, which commits it.  A load that was killed anywhere and is run again under
    the same id leaves the same rows as one that was not; a committed id is not loaded
    again but returns its counts.  ``committed`` reads committed runs only.  Without
    ``run_id`` every call is a run of its own.  ``analyze``: ``"noscan"`` refreshes size
    statistics from file metadata (cheap at any size), ``"full"`` recomputes row
    statistics with a scan of the table, ``None`` skips it."""
    spark, run_id, ledger = df.sparkSession, _run(run_id), f"{table}_loads"
    if spark.catalog.tableExists(ledger):
        done = spark.table(ledger).where(F.col("run_id") == run_id).first()
        if done:
            return LoadResult(done["accepted"], done["rejected"])
    scratch = Scratch(spark)
    try:
        tagged, counts = _staged(df, scratch)
        _replace_run(rejected_records(tagged), quarantine_table or f"{table}_rejects", run_id)
        _replace_run(accepted_records(tagged), table, run_id, SALES_RECORDS_DDL)
        _replace_run(spark.createDataFrame([(counts.accepted, counts.rejected)], LEDGER_DDL), ledger, run_id, LEDGER_DDL)
    finally:
        scratch.release()
    if analyze:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (" NOSCAN" if analyze == "noscan" else ""))
    return counts


def committed(spark: SparkSession, table: str, of: str | None = None) -> DataFrame:
    """The rows of ``table`` (or of ``of``, its quarantine) whose load is committed; only
    their partitions are read."""
    runs = spark.table(f"{table}_loads").select("run_id")
    return spark.table(of or table).join(runs, "run_id", "left_semi")


def _connection(spark: SparkSession, url: str, properties: dict):
    if "driver" in properties:
        spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    settings = spark._jvm.java.util.Properties()
    for k, v in properties.items():
        settings.setProperty(k, str(v))
    return spark._jvm.java.sql.DriverManager.getConnection(url, settings)


def _execute(con, sql: str, *values) -> None:
    statement = con.prepareStatement(sql)
    try:
        for i, v in enumerate(values):
            statement.setString(i + 1, v) if isinstance(v, str) else statement.setLong(i + 1, v)
        statement.execute()
    finally:
        statement.close()


def _has_table(con, name: str) -> bool:
    try:
        _execute(con, f"SELECT 1 FROM {name} WHERE 1 = 0")
        return True
    except Py4JJavaError:
        return False


def _ledger_entry(con, ledger: str, run_id: str) -> LoadResult | None:
    statement = con.prepareStatement(f"SELECT accepted, rejected FROM {ledger} WHERE run_id = ?")
    try:
        statement.setString(1, run_id)
        found = statement.executeQuery()
        return LoadResult(found.getLong(1), found.getLong(2)) if found.next() else None
    finally:
        statement.close()


def load_to_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                 batch_size: int = DEFAULT_BATCH, *, quarantine_path: str, run_id: str | None = None) -> LoadResult:
    """SNK2 over JDBC, repeatable.  Rows are staged once; executors write them in batches
    into a stage table of this run, rejects replace ``quarantine_path/run_id=<id>``, and one
    transaction of the database moves the stage into ``table`` and enters the run in
    ``<table>_LOADS`` (its primary key).  A load that is killed before that transaction
    leaves ``table`` as it was; a committed run id is not loaded again."""
    spark, run_id, properties = df.sparkSession, _run(run_id), properties or {}
    ledger, stage = f"{table}_LOADS", f"{table}_S{uuid.uuid5(uuid.NAMESPACE_URL, run_id).hex[:12].upper()}"
    con = _connection(spark, url, properties)
    scratch = Scratch(spark)
    try:
        if not _has_table(con, ledger):
            _execute(con, f"CREATE TABLE {ledger} (run_id VARCHAR(200) NOT NULL PRIMARY KEY, accepted BIGINT, rejected BIGINT)")
        done = _ledger_entry(con, ledger, run_id)
        if done:
            return done
        tagged, counts = _staged(df, scratch)
        records = accepted_records(tagged).select(*RECORD_COLUMNS)
        settings = {**properties, "batchsize": str(batch_size)}
        rejected_records(tagged).write.mode("overwrite").parquet(f"{quarantine_path}/run_id={run_id}")
        records.write.mode("overwrite").jdbc(url, stage, properties=settings)
        if not _has_table(con, table):
            records.limit(0).write.mode("append").jdbc(url, table, properties=settings)
        _commit_stage(con, stage, table, ledger, run_id, counts)
        return counts
    finally:
        scratch.release()
        con.close()


def _commit_stage(con, stage: str, table: str, ledger: str, run_id: str, counts: LoadResult) -> None:
    quote = con.getMetaData().getIdentifierQuoteString().strip()
    names = ", ".join(f"{quote}{c}{quote}" for c in RECORD_COLUMNS)
    con.setAutoCommit(False)
    try:
        _execute(con, f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}")
        _execute(con, f"INSERT INTO {ledger} (run_id, accepted, rejected) VALUES (?, ?, ?)", run_id, counts.accepted, counts.rejected)
        con.commit()
    except Exception:
        con.rollback()
        raise
    finally:
        con.setAutoCommit(True)
    _execute(con, f"DROP TABLE {stage}")


def load_to_warehouse(df: DataFrame, table: str, partition_by: tuple[str, ...] = ("year", "month"),
                      fmt: str = "parquet") -> None:
    """SNK3: append into a table partitioned by calendar parts (partition pruning for
    date-bounded reads)."""
    out = df
    if "year" in partition_by and "year" not in df.columns:
        out = out.withColumn("year", F.year("date"))
    if "month" in partition_by and "month" not in df.columns:
        out = out.withColumn("month", F.month("date"))
    # Rows of a month meet in a few tasks (large months are split), not in a file per task.
    out = out.hint("rebalance", *partition_by)
    out.write.mode("append").format(fmt).partitionBy(*partition_by).saveAsTable(table)


def archive(df: DataFrame, base_dir: str, run_ts: datetime, fmt: str = "parquet") -> str:
    """SNK4: write-once copy under ``run_ts=...``; an existing archive is an error."""
    path = os.path.join(base_dir, f"run_ts={run_ts.strftime('%Y%m%d_%H%M%S')}")
    df.write.mode("errorifexists").format(fmt).save(path)
    return path


def write_report(spark: SparkSession, report: dict | str, path: str) -> str:
    """SNK6: a report (already report-sized) as one JSON document, written by Spark so
    that any file system it knows will do."""
    text = report if isinstance(report, str) else json.dumps(report, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def write_frames_json(frames: dict[str, DataFrame], base_dir: str) -> dict[str, str]:
    """SNK6 for DataFrame reports: each frame as JSON lines under its own folder."""
    out = {}
    for name, f in frames.items():
        p = os.path.join(base_dir, name)
        f.repartition(1).write.mode("overwrite").json(p)  # one file; what makes the frame stays parallel
        out[name] = p
    return out


def upload_sales(spark: SparkSession, records: list[dict] | DataFrame, table: str,
                 quarantine_table: str | None = None, run_id: str | None = None) -> dict:
    """SNK5: validate an upload (non-empty, six required columns) and load it, once for
    each ``run_id``.  Returns accepted and rejected counts (the reference reports the input
    size)."""
    df = records if isinstance(records, DataFrame) else (
        spark.createDataFrame(records) if records else None)
    if df is None or df.isEmpty():
        raise PipelineError("No data provided", "UPLOAD_400")
    missing = [c for c in UPLOAD_REQUIRED if c not in df.columns]
    if missing:
        raise PipelineError(f"Missing required columns: {missing}", "UPLOAD_400", {"columns": missing})
    res = load_to_table(df, table, quarantine_table, run_id=run_id)
    return {"message": "Data uploaded successfully", "records_accepted": res.accepted,
            "records_rejected": res.rejected}
