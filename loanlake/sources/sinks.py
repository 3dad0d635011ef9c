"""Sinks: table versions published by atomic commits, CSV export, quality evidence.

Spark cannot overwrite a path it is reading, and a plain Parquet overwrite is not atomic. A table
here is a set of immutable versions ``<root>/<name>/v=<stamp>``; which version is current is said by
the commit log ``<root>/_commits``. A commit is one file that Spark's committer renames into place:
it carries the current version of *every* table and the incremental marks, so a job publishes all of
its outputs and its mark in one step. A writer that dies before its commit changes nothing that
readers see; versions it left behind are removed by ``vacuum``.

Only a missing commit log means "nothing written yet". Any other failure to read it is raised, so an
unreadable log can never be mistaken for an empty store.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import uuid
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.sources import segments

COMMIT_SCHEMA = ("seq long, id string, committed_at timestamp, tables map<string,string>, "
                 "marks map<string,timestamp_ntz>")


def _version_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def _is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _commit_rows(spark: SparkSession, root: str) -> DataFrame | None:
    """The commit log; None only where it does not exist."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(f"{root.rstrip('/')}/_commits")
    except AnalysisException as e:
        if _is_missing_path(e):
            return None
        raise


def _is_manifest(path: str) -> bool:
    return path.rstrip("/").rsplit("/", 1)[-1].startswith("m=")


def _catalog_name(path: str) -> str:
    """Name of a bucketed version in the session's catalog: versions are never written twice."""
    return "loanlake_" + hashlib.md5(path.encode()).hexdigest()


def _row_schema(manifest: list) -> T.StructType:
    return T.StructType.fromJson(json.loads(next(e["row_schema"] for e in manifest if e["segment"] is None)))


@dataclass
class Snapshot:
    """What the newest commit says: current version paths and marks by name."""
    seq: int = 0
    tables: dict[str, str] = field(default_factory=dict)
    marks: dict[str, dt.datetime] = field(default_factory=dict)


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    log = _commit_rows(spark, root)
    # one row per commit (kept few by ``vacuum``); the newest by number, then by id
    row = log.orderBy(F.desc("seq"), F.desc("id")).first() if log is not None else None
    if row is None:
        return Snapshot()
    return Snapshot(row["seq"], dict(row["tables"] or {}), dict(row["marks"] or {}))


class Publication:
    """Table versions of one job, published together.

    ``write`` adds a version that nobody sees; ``commit`` makes all of them and the given marks current in
    one step. Jobs over one root run one at a time, as for any store without a lock service.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.base = snapshot(spark, root)
        self.tables: dict[str, str] = {}

    def write(self, df: DataFrame, name: str, audit_col: str | None = None,
              partition_by: list[str] | None = None) -> str:
        """Write ``df`` as a new version of ``name``. ``audit_col`` adds a write-time stamp (e.g.
        ``staged_at``); ``partition_by`` lays files out by a low-cardinality column (month, not day)."""
        if audit_col:
            df = df.withColumn(audit_col, F.current_timestamp())
        path = f"{self.root}/{name}/v={_version_id()}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        self.tables[name] = path
        return path

    def write_bucketed(self, df: DataFrame, name: str, key: str, buckets: int) -> None:
        """Write ``df`` as a new version of ``name`` in ``buckets`` buckets of ``key``, a sorted file for each, for
        ``read_bucketed``. A bucket is one task's work, so hot keys have to be kept out of it."""
        path = f"{self.root}/{name}/v={_version_id()}"
        (df.repartition(buckets, key).write.format("parquet").mode("errorifexists").option("path", path)
         .bucketBy(buckets, key).sortBy(key).saveAsTable(_catalog_name(path)))
        self.tables[name] = path

    def read_bucketed(self, name: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
        """A bucketed version, with its buckets known to Spark: the session's catalog gets an entry for its files
        where it has none."""
        path = self.path(name)
        table = _catalog_name(path)
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            place = path.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                           f"INTO {buckets} BUCKETS LOCATION '{place}'")
        return self.spark.table(table)

    def write_segments(self, df: DataFrame, name: str, segment: Column, keys: list[str] | None = None,
                       audit_col: str | None = None, replace: set[str] | None = None,
                       without: list[str] | None = None) -> set[str]:
        """Write ``df`` (``without`` the columns that only ``segment`` needs) as segments of ``name`` (see
        ``segments.py``), indexed by the ``keys`` columns, and return their names. They take the place of the whole table or, if ``replace`` is given, of the segments
        it names; the files of all others are not touched."""
        old = [] if replace is None else [e for e in self.entries(name) if e[0] not in replace]
        if audit_col:
            df = df.withColumn(audit_col, F.current_timestamp())
        named = df.withColumn(segments.SEGMENT, segment).drop(*(without or []))
        schema = T.StructType([f for f in named.schema.fields if f.name != segments.SEGMENT])
        path = self.write(named.hint("rebalance", segments.SEGMENT), name, partition_by=[segments.SEGMENT])
        new = segments.describe(self.spark, path, schema, list(keys or []))
        manifest = f"{self.root}/{name}/m={_version_id()}"
        about = (None, None, None, None, None, schema.json())
        (self.spark.createDataFrame([*map(tuple, old), *new, about], segments.ENTRY).coalesce(1)
         .write.parquet(manifest))
        self.tables[name] = manifest
        return {e[0] for e in new}

    def _manifest(self, name: str) -> list:
        path = self.path(name)
        if path is None or not _is_manifest(path):
            return []
        return self.spark.read.schema(segments.ENTRY).parquet(path).collect()  # a row per segment

    def entries(self, name: str) -> list:
        """Manifest entries of a segmented table; none for others."""
        return [e for e in self._manifest(name) if e["segment"] is not None]

    def read_segments(self, name: str, names: set[str] | None = None) -> DataFrame:
        """Rows of the named (default: all) segments, hidden ones included, with their segment."""
        rows = self._manifest(name)
        chosen = [e for e in rows if e["segment"] is not None and (names is None or e["segment"] in names)]
        return segments.read(self.spark, chosen, _row_schema(rows), named=True)

    def holding(self, name: str, values: DataFrame) -> set[str]:
        """Segments of ``name`` that hold any of ``values`` (key, value)."""
        rows = self._manifest(name)
        return segments.holding(self.spark, [e for e in rows if e["segment"] is not None], _row_schema(rows), values)

    def path(self, name: str) -> str | None:
        """The version this job wrote, else the current one."""
        return self.tables.get(name) or self.base.tables.get(name)

    def read(self, name: str) -> DataFrame:
        path = self.path(name)
        if path is None:
            raise FileNotFoundError(f"{self.root}/{name} has no current version")
        if _is_manifest(path):
            rows = self._manifest(name)
            shown = [e for e in rows if e["segment"] is not None and not segments.hidden(e["segment"])]
            return segments.read(self.spark, shown, _row_schema(rows))
        return self.spark.read.parquet(path)

    def commit(self, marks: dict[str, dt.datetime] | None = None) -> Snapshot:
        done = Snapshot(self.base.seq + 1, {**self.base.tables, **self.tables},
                        {**self.base.marks, **(marks or {})})
        row = (done.seq, uuid.uuid4().hex, dt.datetime.now(), done.tables, done.marks)
        (self.spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{self.root}/_commits"))
        self.base, self.tables = done, {}
        return done


def write_table(df: DataFrame, root: str, name: str, audit_col: str | None = None,
                partition_by: list[str] | None = None) -> str:
    """Write and publish one table; returns its version path."""
    p = Publication(df.sparkSession, root)
    path = p.write(df, name, audit_col, partition_by)
    p.commit()
    return path


def current_path(spark: SparkSession, root: str, name: str) -> str | None:
    """Path of the current version; None if the table was never published."""
    return snapshot(spark, root).tables.get(name)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return Publication(spark, root).read(name)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete versions that none of the newest ``keep`` commits names, directly or by a manifest; returns the
    number of versions removed. A version of which some segments are still named stays. Run it when no job
    writes and no reader holds an old version. The file system is the one ``pyarrow`` opens for ``root``."""
    log = _commit_rows(spark, root)
    if log is None:
        return 0
    newest = log.orderBy(F.desc("seq"), F.desc("id")).limit(keep).collect()  # ``keep`` rows
    used = set()
    for path in {path.rstrip("/") for r in newest for path in (r["tables"] or {}).values()}:
        used.add("/".join(path.rsplit("/", 2)[-2:]))
        if _is_manifest(path):
            entries = spark.read.schema(segments.ENTRY).parquet(path).where("path IS NOT NULL").select("path").collect()
            used |= {"/".join(e["path"].rsplit("/", 3)[-3:-1]) for e in entries}
    where, base = fs.FileSystem.from_uri(root if "://" in root else os.path.abspath(root))
    removed = 0
    for table in where.get_file_info(fs.FileSelector(base)):
        if table.type != fs.FileType.Directory or table.base_name.startswith("_"):
            continue
        for version in where.get_file_info(fs.FileSelector(table.path)):
            if version.base_name[:2] in ("v=", "m=") and f"{table.base_name}/{version.base_name}" not in used:
                where.delete_dir(version.path)
                removed += 1
    return removed


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header and comma delimiter; a directory of part files unless ``single_file``."""
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", True).option("delimiter", ",").csv(path)


def quality_markdown(rows: list) -> str:
    """Markdown evidence for the (<= 30) collected quality-report rows."""
    passed = sum(1 for r in rows if r["passed"])
    lines = ["# Data quality evidence", "",
             f"Run: {dt.datetime.now():%Y-%m-%d %H:%M:%S}", "",
             "| Total checks | Passed | With findings |", "|---|---|---|",
             f"| {len(rows)} | {passed} | {len(rows) - passed} |", "",
             "| Table | Check | Status | Rows affected | Threshold | Detail |", "|---|---|---|---|---|---|"]
    for r in sorted(rows, key=lambda r: r["seq"]):
        status = "PASS" if r["passed"] else "WARN"
        lines.append(f"| {r['table_name']} | {r['check_name']} | {status} | {r['failed_count']} | "
                     f"{r['threshold']} | {r['detail']} |")
    return "\n".join(lines) + "\n"


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """Write a small text document to (shared) storage as a single part file."""
    spark.createDataFrame([(line,) for line in text.splitlines()], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)
