"""Relational copies of the table and their audit trail (K6-K9).

A copy target is written by the executors in parallel (``DataFrameWriter``);
no row goes through the driver. ``JdbcTarget`` writes to a database table,
``ParquetTarget`` to a folder on shared storage (same overwrite / append
semantics, handy where no database is reachable).

A copy changes in one step. Rows first go to a staging place of their own; a write
that fails leaves the copy as it was. ``overwrite`` then puts the staged rows in
the copy's place; ``append_once`` adds them under a name, and does nothing if the copy
has rows of that name already, so that a repeated sync adds nothing twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, move_path, scratch_path, sql_connection
from ..session import path_exists as fs_exists
from ..sources.literals import empty_rows


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` on ``df`` and return how many rows it wrote, counted by
    observed metrics in the stage that writes: only the successful attempt of each
    of its tasks counts, and no extra pass is made."""
    obs = Observation(f"copy-{uuid.uuid4().hex[:8]}")
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


ROW, LOAD, WRITE = "_copy_row", "_copy_load", "write"


@dataclass(frozen=True)
class JdbcTarget:
    """A database table reached over JDBC. ``num_partitions`` caps the number of
    concurrent connections of a write, for a database that takes no more: the rows
    are dealt to that many writers by a shuffle, so what computes them keeps its
    own parallelism. By default every partition writes over its own connection.

    A write evaluates its rows once into Parquet, numbered, and the executors load that
    into the table ``<table>_STAGED``. A task that is run again after its rows were
    committed loads them twice, with the same numbers; a random number that every
    load of a row draws anew tells which of them counts. What follows is one
    transaction on one connection, of statements only:

    - overwrite: the staged rows fill the new table ``<table>_NEW``, the old table is
      dropped, the new one renamed (``rename``), the ledger emptied. A database whose
      transactions do not cover DROP and RENAME (MySQL, Oracle) commits these one by
      one: readers then miss the table for a moment, but never see half of it.
    - append_once: the name goes into the ledger table ``<table>_APPENDS`` (its primary
      key) and the staged rows into the copy, or neither.

    ``table`` is written as in SQL; a name the database would have to quote is not
    supported."""

    url: str
    table: str
    properties: dict = field(default_factory=dict)
    num_partitions: int | None = None
    batch_size: int = 10_000
    rename: str | None = None  # statement with {old} and {new}

    def _options(self) -> dict:
        opts = dict(self.properties)
        opts["batchsize"] = str(self.batch_size)
        return opts

    def rows_to_write(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.num_partitions) if self.num_partitions else df

    def write(self, df: DataFrame, mode: str) -> int:
        """Write ``df`` with ``mode`` (overwrite or append); returns the number of rows
        written. An append of this kind is one step, but not known by a name."""
        if mode == "overwrite":
            return self._replace(df)
        if mode != "append":
            raise ValueError(f"mode is {mode!r}, not overwrite or append")
        return self.append_once(df, f"unnamed-{uuid.uuid4().hex}")

    def append_once(self, df: DataFrame, name: str) -> int | None:
        """Append ``df`` under ``name``; returns the number of rows, or None if the copy
        has rows of that name."""
        spark = df.sparkSession
        if self.appended(spark, name) is not None:
            return None
        with self._staged(df) as n, self._connection(spark) as db:
            if not db.exists(self._ledger()):
                db.run(f"CREATE TABLE {self._ledger()} (name VARCHAR(200) NOT NULL PRIMARY KEY, row_count BIGINT NOT NULL)")
            if not db.exists(self.table):
                self._create(df, self.table)
            with db.transaction():
                db.run(f"INSERT INTO {self._ledger()} VALUES (?, ?)", name, n)
                db.run(self._insert(db, df, self.table))
            return n

    def appended(self, spark: SparkSession, name: str) -> int | None:
        """How many rows were appended under ``name``; None if none ever were."""
        with self._connection(spark) as db:
            if not db.exists(self._ledger()):
                return None
            return db.number(f"SELECT row_count FROM {self._ledger()} WHERE name = ?", name)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.jdbc(self.url, self.table, properties=dict(self.properties))

    def _ledger(self) -> str:
        return f"{self.table}_APPENDS"

    def _replace(self, df: DataFrame) -> int:
        new = f"{self.table}_NEW"
        with self._staged(df) as n, self._connection(df.sparkSession) as db:
            self._create(df, new)
            with db.transaction():
                db.run(self._insert(db, df, new))
                if db.exists(self.table):
                    db.run(f"DROP TABLE {self.table}")
                db.run(self._rename().format(old=new, new=self.table.rsplit(".", 1)[-1]))
                if db.exists(self._ledger()):
                    db.run(f"DELETE FROM {self._ledger()}")
            return n

    def _rename(self) -> str:
        if self.rename:
            return self.rename
        return "RENAME TABLE {old} TO {new}" if self.url.startswith("jdbc:derby:") else "ALTER TABLE {old} RENAME TO {new}"

    def _create(self, df: DataFrame, table: str) -> None:
        """An empty table with the columns of ``df``."""
        empty_rows(df.sparkSession, df.schema).write.jdbc(self.url, table, mode="overwrite", properties=self._options())

    def _insert(self, db: "_Database", df: DataFrame, table: str) -> str:
        names, staged = [db.quoted(c) for c in df.columns], f"{self.table}_STAGED"
        row, load = db.quoted(ROW), db.quoted(LOAD)
        one = f"SELECT {row}, MIN({load}) AS {load} FROM {staged} GROUP BY {row}"
        return (f"INSERT INTO {table} ({', '.join(names)}) SELECT {', '.join('s.' + c for c in names)} "
                f"FROM {staged} s JOIN ({one}) o ON s.{row} = o.{row} AND s.{load} = o.{load}")

    @contextmanager
    def _staged(self, df: DataFrame) -> Iterator[int]:
        """Loads ``df``, its rows numbered, into the staging table; gives their number."""
        spark, staging = df.sparkSession, f"{self.table}_STAGED"
        path = scratch_path(spark, "jdbc-copy")
        try:
            numbered = self.rows_to_write(df).withColumn(ROW, F.monotonically_increasing_id())
            n = counted_write(numbered, lambda d: d.write.parquet(path))
            rows = spark.read.schema(numbered.schema).parquet(path)
            if self.num_partitions:
                rows = rows.coalesce(self.num_partitions)
            rows = rows.withColumn(LOAD, F.xxhash64(F.reflect(F.lit("java.util.UUID"), F.lit("randomUUID"))))
            rows.write.jdbc(self.url, staging, mode="overwrite", properties=self._options())
            yield n
        finally:
            delete_path(spark, path)
            with self._connection(spark) as db:
                if db.exists(staging):
                    db.run(f"DROP TABLE {staging}")

    @contextmanager
    def _connection(self, spark: SparkSession) -> Iterator["_Database"]:
        connection = sql_connection(spark, self.url, self.properties)
        try:
            yield _Database(connection)
        finally:
            connection.close()


class _Database:
    """Statements over one JDBC connection of the driver (none of them returns rows of
    a copy)."""

    def __init__(self, connection: JavaObject) -> None:
        self.connection = connection

    def run(self, sql: str, *values) -> int:
        statement = self.connection.prepareStatement(sql)
        try:
            for i, v in enumerate(values, 1):
                statement.setObject(i, v)
            return statement.executeUpdate()
        finally:
            statement.close()

    def number(self, sql: str, *values) -> int | None:
        statement = self.connection.prepareStatement(sql)
        try:
            for i, v in enumerate(values, 1):
                statement.setObject(i, v)
            rows = statement.executeQuery()
            return rows.getLong(1) if rows.next() else None
        finally:
            statement.close()

    def quoted(self, name: str) -> str:
        mark = self.connection.getMetaData().getIdentifierQuoteString().strip()
        return f"{mark}{name}{mark}"

    def exists(self, table: str) -> bool:
        meta = self.connection.getMetaData()
        if meta.storesUpperCaseIdentifiers():
            table = table.upper()
        elif meta.storesLowerCaseIdentifiers():
            table = table.lower()
        schema, _, name = table.rpartition(".")
        found = meta.getTables(None, schema or None, name, None)
        try:
            return bool(found.next())
        finally:
            found.close()

    @contextmanager
    def transaction(self) -> Iterator[None]:
        self.connection.setAutoCommit(False)
        try:
            yield
            self.connection.commit()
        except BaseException:
            self.connection.rollback()
            raise
        finally:
            self.connection.setAutoCommit(True)


@dataclass(frozen=True)
class ParquetTarget:
    """A folder with one sub-folder for each write (``write=<name>``), all of one schema.

    A write goes to a folder beside the copy and is renamed into it when all its rows
    are there. An overwrite renames a whole new copy into the place of the old one:
    between the two renames there is no copy, never half of one."""

    path: str

    def write(self, df: DataFrame, mode: str) -> int:
        """Write ``df`` with ``mode`` (overwrite or append); returns the number of rows
        written."""
        if mode == "append":
            return self.append_once(df, f"unnamed-{uuid.uuid4().hex}")
        if mode != "overwrite":
            raise ValueError(f"mode is {mode!r}, not overwrite or append")
        new = self._beside()
        n = self._load(df, f"{new}/{WRITE}=first", new)
        delete_path(df.sparkSession, self.path)
        move_path(df.sparkSession, new, self.path)
        return n

    def append_once(self, df: DataFrame, name: str) -> int | None:
        """As `JdbcTarget.append_once`."""
        if self.appended(df.sparkSession, name) is not None:
            return None
        new = self._beside()
        n = self._load(df, new, new)
        move_path(df.sparkSession, new, self._folder(name))
        return n

    def appended(self, spark: SparkSession, name: str) -> int | None:
        """How many rows were appended under ``name``; None if none ever were."""
        if not fs_exists(spark, self._folder(name)):
            return None
        return spark.read.parquet(self._folder(name)).count()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(WRITE)

    def _folder(self, name: str) -> str:
        return f"{self.path}/{WRITE}={name}"

    def _beside(self) -> str:
        return f"{self.path.rstrip('/')}-new-{uuid.uuid4().hex[:12]}"

    @staticmethod
    def _load(df: DataFrame, path: str, top: str) -> int:
        try:
            return counted_write(df, lambda d: d.write.parquet(path))
        except BaseException:
            delete_path(df.sparkSession, top)
            raise


# The columns of the audit table.
AUDIT_SCHEMA = T.StructType([
    T.StructField("snapshot_id", T.LongType()),
    T.StructField("batch_label", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])


def path_exists(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    known = fs_exists(spark, path)
    if known is not None:
        return known
    try:
        spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc.getCondition() or exc):
            return False
        raise
    return True


def ensure_audit_table(spark: SparkSession, path: str) -> None:
    """Create the empty audit table if it does not exist yet."""
    if not path_exists(spark, path, AUDIT_SCHEMA):
        empty_rows(spark, AUDIT_SCHEMA).write.mode("append").parquet(path)


def record(spark: SparkSession, path: str, snapshot_id: int, batch_label: str, record_count: int,
           status: str = "done") -> None:
    """Append one audit row stamped with the current time."""
    row = spark.range(1).select(
        F.lit(snapshot_id).cast("bigint").alias("snapshot_id"),
        F.lit(batch_label).alias("batch_label"),
        F.lit(record_count).cast("bigint").alias("record_count"),
        F.lit(status).alias("status"),
        F.current_timestamp().alias("created_at"),
    )
    row.write.mode("append").parquet(path)


def is_recorded(spark: SparkSession, path: str, snapshot_id: int, batch_label: str, record_count: int) -> bool:
    """Whether the audit table has such a row."""
    if not path_exists(spark, path, AUDIT_SCHEMA):
        return False
    same = (F.col("snapshot_id") == snapshot_id) & (F.col("batch_label") == batch_label) & (F.col("record_count") == record_count)
    return not read_audit(spark, path).where(same).isEmpty()


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)
