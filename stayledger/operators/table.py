"""A versioned, partitioned Parquet table with a commit log and a row changelog.

Layout of a table at ``path``::

    state/_v=<n>/_p=<partition>/*.parquet     rows written by commit n, with a _slot column
    segments/commit_id=<n>/*.parquet          one row per partition commit n wrote
    commits/commit_id=<n>/*.parquet           one row per commit, written last
    _staging/...                              sources evaluated once, removed after the commit

A commit rewrites only the partitions that hold a matched key (copy-on-write
per partition); a partition that only receives new rows gets one more
segment with just those rows. A commit of one batch by key (``key_where``) rewrites
only the segments that hold a matched key and names them as replaced: the segments
of other batches stay as they are. Every row a commit writes carries a slot:
``kept`` (unchanged row of a rewritten partition or segment), ``insert``, ``update``
(after image) or ``before`` (before image of an updated row).

Both reads are one scan of ``state``. The state keeps the segments at or after
the last rewrite of their partition that no later commit replaced (a semi join with
the small segment table, on folder columns, so that pruning picks the folders) minus
``before`` rows; the
changelog of a range is the versions of the range minus ``kept`` rows. No row is
written twice. ``_p`` is the partition value as text with a letter in front
(``v``), or ``n`` for null, so that an empty string is a value like any other;
the partition column itself stays in the files.

Counts come from the version as written (its folder and slot columns), not from
metrics below a shuffle, which a retried task could count twice. The commit row
is written last, so readers never see a half-written version; a failed commit
leaves folders that the next attempt overwrites. One writer at a time is assumed.

Upsert semantics follow SQL MERGE with ``UPDATE SET *`` / ``INSERT *``:
keys compare with ``=`` (a null key never matches and is always inserted),
two source rows matching one target row raise ``MergeCardinalityError``,
unmatched source rows are all inserted, and each matched target row is
replaced by its source row (unconditionally).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import MergeCardinalityError, TableWriteError
from ..session import delete_path, list_dirs, path_exists

SLOT, PART, VERSION = "_slot", "_p", "_v"
STATE_SLOTS = ("kept", "insert", "update")
CHANGE_TYPES = {"insert": "INSERT", "update": "UPDATE_AFTER", "before": "UPDATE_BEFORE"}
CHANGE_COLUMNS = ["_change_type", "_change_ordinal", "_commit_snapshot_id"]

COMMITS_SCHEMA = T.StructType([
    T.StructField("commit_id", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("operation", T.StringType()),
    T.StructField("source_rows", T.LongType()),
    T.StructField("inserted", T.LongType()),
    T.StructField("updated", T.LongType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("wrote_version", T.BooleanType()),
    T.StructField("schema_json", T.StringType()),
    T.StructField("txn", T.StringType()),
])
# ``replaced``: the versions whose segments of the partition this one replaces, null for all
_SEGMENTS = "part STRING, rewritten BOOLEAN, inserted BIGINT, updated BIGINT, replaced ARRAY<BIGINT>, commit_id BIGINT"

_TRANSFORMS = {"identity", "month", "year"}


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives, its merge key and how it is partitioned.

    ``partition_transform`` is ``identity`` (one folder per value of
    ``partition_column``), ``month`` or ``year`` (of a date, so that a daily
    date does not explode into thousands of small folders).
    """

    path: str
    key: str = "transaction_id"
    partition_column: str = "check_in_date"
    partition_transform: str = "identity"

    def __post_init__(self) -> None:
        if self.partition_transform not in _TRANSFORMS:
            raise ValueError(f"partition_transform must be one of {sorted(_TRANSFORMS)}")

    def partition(self) -> Column:
        """The folder value of a row: never null and never empty."""
        c = F.col(self.partition_column)
        if self.partition_transform != "identity":
            c = F.trunc(c, self.partition_transform)
        return F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))

    @property
    def commits_path(self) -> str:
        return f"{self.path}/commits"

    @property
    def state_path(self) -> str:
        return f"{self.path}/state"

    @property
    def segments_path(self) -> str:
        return f"{self.path}/segments"

    def version_path(self, n: int) -> str:
        return f"{self.state_path}/{VERSION}={n}"

    def staging_path(self, name: str) -> str:
        return f"{self.path}/_staging/{name}"


@dataclass(frozen=True)
class CommitResult:
    commit_id: int
    operation: str
    source_rows: int
    inserted: int
    updated: int
    row_count: int


# --- commit log -------------------------------------------------------------------

def commits(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The commit log; raises ``AnalysisException`` if the table does not exist."""
    return (spark.read.schema(COMMITS_SCHEMA).parquet(spec.commits_path)
            .select(*COMMITS_SCHEMA.fieldNames()))


def _commit_dir(spec: TableSpec, n: int) -> str:
    return f"{spec.commits_path}/commit_id={n}"


def _listed_ids(spark: SparkSession, spec: TableSpec) -> list[int] | None:
    """Commit ids from the folder names of the log (no file is opened)."""
    names = list_dirs(spark, spec.commits_path)
    if names is None:
        return None
    ids = [n.split("=", 1)[1] for n in names if n.startswith("commit_id=")]
    return sorted(int(i) for i in ids if i.isdigit())


def _read_commit(spark: SparkSession, spec: TableSpec, n: int) -> Row | None:
    rows = (spark.read.option("basePath", spec.commits_path).schema(COMMITS_SCHEMA)
            .parquet(_commit_dir(spec, n)).select(*COMMITS_SCHEMA.fieldNames()).collect())
    return rows[0] if rows else None


def table_exists(spark: SparkSession, spec: TableSpec) -> bool:
    """True when the table has at least one commit."""
    return _latest(spark, spec) is not None


def _commit_row(spark: SparkSession, spec: TableSpec, commit_id: int | None = None) -> Row | None:
    """The given commit, or the latest one: read from its own folder, found by
    listing folder names, so the cost does not grow with the number of commits.
    A folder left by a failed commit-row write holds no row and is passed over."""
    ids = _listed_ids(spark, spec)
    if ids is not None:
        wanted = ids[::-1] if commit_id is None else [n for n in ids if n == commit_id]
        return next((row for n in wanted if (row := _read_commit(spark, spec, n)) is not None), None)
    log = commits(spark, spec)
    if commit_id is not None:
        log = log.where(F.col("commit_id") == commit_id)
    rows = log.orderBy(F.col("commit_id").desc()).limit(1).collect()
    return rows[0] if rows else None


def _latest(spark: SparkSession, spec: TableSpec) -> Row | None:
    """Latest commit row, or None when the table does not exist."""
    if path_exists(spark, spec.commits_path) is False:
        return None
    try:
        return _commit_row(spark, spec)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc.getCondition() or exc):
            return None
        raise


def latest_commit(spark: SparkSession, spec: TableSpec) -> Row | None:
    """The latest commit row, or None when the table does not exist."""
    return _latest(spark, spec)


def first_last_commit(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """(first_commit, last_commit): oldest and newest commit by commit time,
    ties broken by commit id."""
    order = F.struct("committed_at", "commit_id")
    return commits(spark, spec).agg(
        F.min_by("commit_id", order).alias("first_commit"),
        F.max_by("commit_id", order).alias("last_commit"),
    )


def committed(spark: SparkSession, spec: TableSpec, txn: str) -> Row | None:
    """The commit that recorded transaction ``txn``, or None (also when the
    table does not exist yet)."""
    if _latest(spark, spec) is None:
        return None
    rows = commits(spark, spec).where(F.col("txn") == txn).limit(1).collect()
    return rows[0] if rows else None


def _result(row: Row) -> CommitResult:
    return CommitResult(row.commit_id, row.operation, row.source_rows, row.inserted,
                        row.updated, row.row_count)


def _append_commit(spark: SparkSession, spec: TableSpec, n: int, **values) -> CommitResult:
    """Write the commit row of commit ``n``, stamped with the current time (the id
    is the folder's value). A retried commit overwrites its folder."""
    cols = [(F.current_timestamp() if f.name == "committed_at" else F.lit(values.get(f.name)))
            .cast(f.dataType).alias(f.name) for f in COMMITS_SCHEMA.fields if f.name != "commit_id"]
    spark.range(1).select(*cols).write.mode("overwrite").parquet(_commit_dir(spec, n))
    return CommitResult(n, *(values[k] for k in ("operation", "source_rows", "inserted", "updated", "row_count")))


# --- reads ------------------------------------------------------------------------

def _data_schema(row: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(row.schema_json))


def _scan(spark: SparkSession, spec: TableSpec, data_schema: T.StructType) -> DataFrame:
    """All rows of all versions, with slot and folder columns: one file scan."""
    schema = T.StructType(data_schema.fields + [
        T.StructField(SLOT, T.StringType()), T.StructField(VERSION, T.LongType()),
        T.StructField(PART, T.StringType())])
    return spark.read.schema(schema).parquet(spec.state_path)


def segments(spark: SparkSession, spec: TableSpec, commit_id: int | None = None) -> DataFrame:
    """(part, version): what the state at the latest (or given) commit is made of."""
    row = _commit_row(spark, spec, commit_id)
    log = spark.read.schema(_SEGMENTS).parquet(spec.segments_path).where(F.col("commit_id") <= row.commit_id)
    per_part = log.groupBy("part").agg(
        F.max(F.when(F.col("rewritten") & F.col("replaced").isNull(), F.col("commit_id"))).alias("since"),
        F.flatten(F.collect_list("replaced")).alias("gone"),
        F.collect_list("commit_id").alias("ids"))
    live = F.filter("ids", lambda i: (i >= F.coalesce(F.col("since"), F.lit(0))) & ~F.array_contains("gone", i))
    return per_part.select("part", F.explode(live).alias("version"))


def _state(spark: SparkSession, spec: TableSpec, row: Row, parts: DataFrame | None = None) -> DataFrame:
    """State at commit ``row`` with its folder columns; optionally only the
    partitions (column ``part``) or segments (``part``, ``version``) listed in ``parts``."""
    live = segments(spark, spec, row.commit_id)
    if parts is not None:
        live = live.join(parts, parts.columns, "left_semi")
    rows = _scan(spark, spec, _data_schema(row)).where(F.col(SLOT).isin(*STATE_SLOTS))
    on = (rows[PART] == live["part"]) & (rows[VERSION] == live["version"])
    return rows.join(live, on, "left_semi")


def read_table(spark: SparkSession, spec: TableSpec, commit_id: int | None = None) -> DataFrame:
    """Table state at the latest (or the given) commit, columns in stored order."""
    row = _commit_row(spark, spec, commit_id)
    if row is None:
        raise TableWriteError(f"table {spec.path} has no commit {commit_id or ''}".strip())
    return _state(spark, spec, row).select(*_data_schema(row).fieldNames())


def changes(spark: SparkSession, spec: TableSpec, start_exclusive: int | None = None,
            end_inclusive: int | None = None) -> DataFrame:
    """Row changes of the commits in (start_exclusive, end_inclusive].

    Columns: the table columns plus ``_change_type`` (INSERT, UPDATE_BEFORE,
    UPDATE_AFTER), ``_change_ordinal`` (0-based position of the commit in the
    range) and ``_commit_snapshot_id`` (the commit id). One scan, pruned to the
    range's version folders: commit ids have no holes, so the ordinal follows
    from the folder."""
    latest = _latest(spark, spec) if end_inclusive is None else _commit_row(spark, spec, end_inclusive)
    if latest is None:
        raise TableWriteError(f"table {spec.path} has no commit {end_inclusive}")
    start = start_exclusive or 0
    change_type = F.element_at(F.create_map(*[F.lit(x) for kv in CHANGE_TYPES.items() for x in kv]), F.col(SLOT))
    schema = _data_schema(latest)
    return (_scan(spark, spec, schema)
            .where((F.col(VERSION) > start) & (F.col(VERSION) <= latest.commit_id) & F.col(SLOT).isin(*CHANGE_TYPES))
            .select(*schema.fieldNames(), change_type.alias("_change_type"),
                    (F.col(VERSION) - start - 1).cast("int").alias("_change_ordinal"),
                    F.col(VERSION).alias("_commit_snapshot_id")))


def inserts(changelog: DataFrame, include_updates: bool = False) -> DataFrame:
    """Inserted rows of a changelog (optionally also update after images),
    without the change columns."""
    types = ["INSERT", "UPDATE_AFTER"] if include_updates else ["INSERT"]
    return changelog.where(F.col("_change_type").isin(*types)).drop(*CHANGE_COLUMNS)


# --- writes -----------------------------------------------------------------------

def _write_version(spec: TableSpec, df: DataFrame, n: int, replaced: DataFrame | None = None) -> tuple[int, int]:
    """Write commit n's rows, clustered by partition, and the table of its segments;
    returns (inserted, updated), counted from what was written. ``replaced`` lists the
    segments (``part``, ``version``) it rewrites, where these are not whole partitions.

    The rebalance hint shuffles by the partition value; adaptive execution
    then splits a hot partition over several tasks and merges small ones, so
    one busy day does not become one straggler task. Within a task rows are
    sorted by partition, then slot, so a slot filter skips the other slots' row
    groups by their statistics."""
    (df.withColumn(PART, spec.partition())
       .hint("rebalance", PART)
       .sortWithinPartitions(PART, SLOT)
       .write.mode("overwrite")
       .partitionBy(PART)
       .parquet(spec.version_path(n)))
    spark, path = df.sparkSession, f"{spec.segments_path}/commit_id={n}"
    written = spark.read.schema(f"{SLOT} STRING, {PART} STRING").parquet(spec.version_path(n))
    per_part = written.groupBy(F.col(PART).alias("part")).agg(
        F.max(F.col(SLOT).isin("kept", "before")).alias("rewritten"),
        F.count_if(F.col(SLOT) == "insert").alias("inserted"),
        F.count_if(F.col(SLOT) == "update").alias("updated"))
    if replaced is None:
        per_part = per_part.withColumn("replaced", F.lit(None).cast("array<bigint>"))
    else:
        per_part = per_part.join(replaced.groupBy("part").agg(F.collect_set("version").alias("replaced")), "part", "left")
    per_part.write.mode("overwrite").parquet(path)
    total = spark.read.schema(per_part.schema).parquet(path).agg(F.sum("inserted"), F.sum("updated")).first()
    return int(total[0] or 0), int(total[1] or 0)


def _checked_source(spec: TableSpec, row: Row, source: DataFrame) -> DataFrame:
    """``source`` in the table's column order; raises when its types differ."""
    schema = _data_schema(row)
    problems = _same_types(schema, source.schema)
    if problems:
        raise TableWriteError(f"source does not match table {spec.path}: {problems}")
    return source.select(*schema.fieldNames())


def create_table(spark: SparkSession, spec: TableSpec, df: DataFrame,
                 _checked: bool = False, txn: str | None = None,
                 check: Callable[[DataFrame], None] | None = None) -> CommitResult:
    """Create the table from ``df`` as commit 1 (every row an INSERT).

    ``check`` runs on the written rows before the commit row is written: if
    it raises, nothing is committed and the table stays absent (the written
    folder is unreferenced and a retry overwrites it). This checks data on
    its way in without evaluating it into a staging copy first."""
    if not _checked and _latest(spark, spec) is not None:
        raise TableWriteError(f"table {spec.path} already exists")
    for needed in (spec.key, spec.partition_column):
        if needed not in df.columns:
            raise TableWriteError(f"column '{needed}' is missing from the rows to write")
    if clash := {SLOT, PART, VERSION} & set(df.columns):
        raise TableWriteError(f"columns {sorted(clash)} are the table's own")
    n, _ = _write_version(spec, df.withColumn(SLOT, F.lit("insert")), 1)
    if check is not None:
        check(_scan(spark, spec, df.schema).where(F.col(VERSION) == 1).select(*df.columns))
    return _append_commit(spark, spec, 1, operation="create", source_rows=n, inserted=n, updated=0,
                          row_count=n, wrote_version=True, schema_json=df.schema.json(), txn=txn)


def _same_types(a: T.StructType, b: T.StructType) -> list[str]:
    want = {f.name: f.dataType for f in a.fields}
    have = {f.name: f.dataType for f in b.fields}
    problems = [f"missing column '{c}'" for c in want if c not in have]
    problems += [f"extra column '{c}'" for c in have if c not in want]
    problems += [f"column '{c}' is {have[c].simpleString()}, table has {t.simpleString()}"
                 for c, t in want.items() if c in have and have[c] != t]
    return problems


def append_new_keys(spark: SparkSession, spec: TableSpec, source: DataFrame,
                    _prev: Row | None = None) -> CommitResult:
    """Commit rows whose keys the caller knows are not in the table yet.

    Same result as ``upsert`` under that guarantee (every row is an
    insert), without reading the table. Used for key-hashed batches on a table
    the same run created, where disjoint key sets hold by construction."""
    prev = _prev or _latest(spark, spec)
    if prev is None:
        raise TableWriteError(f"table {spec.path} does not exist")
    n = prev.commit_id + 1
    rows = _checked_source(spec, prev, source).withColumn(SLOT, F.lit("insert"))
    inserted, _ = _write_version(spec, rows, n)
    return _append_commit(spark, spec, n, operation="upsert", source_rows=inserted, inserted=inserted,
                          updated=0, row_count=prev.row_count + inserted, wrote_version=inserted > 0,
                          schema_json=prev.schema_json)


def _merge_rows(tgt: DataFrame, src: DataFrame, key: str, cols: list[str],
                key_where: Column | None = None, matched_keys: DataFrame | None = None,
                updates: DataFrame | None = None) -> DataFrame:
    """Rows of a merge commit: every target row of the rewritten partitions
    as ``kept`` or as ``before`` plus ``update`` (its source row, which may
    land in another partition), and every source row no target row matches
    as ``insert``. The source holds at most one row per matched key
    (checked before); every source key satisfies ``key_where``.
    ``matched_keys`` is the distinct set of source keys that target rows
    hold (by default, computed here from the target); ``updates`` the
    source rows of those keys, stored (``upsert`` stages both), so that the
    left join reads plain scans on both sides and can split a hot target key.

    Only rows that can match are shuffled: target rows with a null key (or
    failing ``key_where``) are kept as they are read, and source rows with a
    null key are inserts, so a hot null key never reaches a shuffle. The two
    key joins keep the big side on the left, which adaptive skew-join
    handling can split: a target key held by a third of all rows is spread
    over many tasks, and no row is multiplied inside one task. Source rows
    meet the matched keys in a semi join (updates, at most one row per key)
    and an anti join (inserts), the source on the left: a new key held by a
    third of the source is split there too, and the left join's right side
    holds only update rows."""
    out = [c for c in cols if c != SLOT]
    can_match = F.col(key).isNotNull()
    if key_where is not None:
        can_match = can_match & F.coalesce(key_where, F.lit(False))
    tgt_in, tgt_out = tgt.where(can_match), tgt.where(~can_match)
    src_in, src_null = src.where(F.col(key).isNotNull()), src.where(F.col(key).isNull())

    keys = matched_keys if matched_keys is not None else tgt_in.select(key).distinct()
    upd = updates if updates is not None else src_in
    after = upd.select(key, F.lit(True).alias("_m"),
                       *[F.col(c).alias(f"_new_{c}") for c in out if c != key])
    joined = tgt_in.join(after, key, "left")
    matched = F.col("_m").isNotNull()
    old_image = F.struct(*[F.col(c) for c in out],
                         F.when(matched, F.lit("before")).otherwise(F.lit("kept")).alias(SLOT))
    new_image = F.struct(*[F.col(c if c == key else f"_new_{c}").alias(c) for c in out],
                         F.lit("update").alias(SLOT))
    old_rows = joined.select(F.inline(F.when(matched, F.array(old_image, new_image))
                                      .otherwise(F.array(old_image))))
    new_rows = src_in.join(keys, key, "left_anti").withColumn(SLOT, F.lit("insert"))
    return (old_rows.select(*cols)
            .unionByName(tgt_out.withColumn(SLOT, F.lit("kept")).select(*cols))
            .unionByName(new_rows.select(*cols))
            .unionByName(src_null.withColumn(SLOT, F.lit("insert")).select(*cols)))


def upsert(spark: SparkSession, spec: TableSpec, source: DataFrame,
           stage_source: bool = True, _prev: Row | None = None, txn: str | None = None,
           key_where: Column | None = None) -> CommitResult:
    """MERGE ``source`` into the table on ``spec.key`` as a new commit.

    Only partitions holding a matched key are rewritten (their old rows are
    kept or become before images); a partition that only receives new rows
    gets one more segment holding just those rows, so an insert-only commit
    writes O(source), not O(state).

    With ``stage_source`` the source is evaluated once into the table's
    staging folder, so every later step reads the same rows (this also cuts
    the source's lineage). Pass ``False`` for a source that is already a
    cheap, deterministic Parquet read.

    ``key_where`` is a predicate on the key that every source key satisfies
    (say ``pmod(key, 5) = 2`` for one key-hashed batch): target rows failing
    it cannot match, so they are dropped before the key joins shuffle, and a
    batch shuffles only its share of the table's keys. Of the partitions with a matched
    key only the segments that hold one are then rewritten: where the table was loaded
    in such batches, that is this batch's share of the rows.
    """
    prev = _prev or _latest(spark, spec)
    if prev is None:
        raise TableWriteError(f"table {spec.path} does not exist")
    n, key = prev.commit_id + 1, spec.key
    src = _checked_source(spec, prev, source)
    staged = []

    def stage(df: DataFrame, what: str) -> DataFrame:
        staged.append(spec.staging_path(f"commit_id={n}-{what}"))
        df.write.mode("overwrite").parquet(staged[-1])
        return spark.read.schema(df.schema).parquet(staged[-1])

    try:
        if stage_source:
            src = stage(src, "source")
        # The matched keys with the segments that hold them. Both sides are
        # aggregated before they meet, with map-side partial aggregation: a hot
        # target key is one row per map task and partition, not a third of the table.
        src_keys = src.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n_src"))
        tgt_keys = _state(spark, spec, prev).where(F.col(key).isNotNull())
        if key_where is not None:
            tgt_keys = tgt_keys.where(key_where)
        tgt_keys = tgt_keys.groupBy(key, PART, VERSION).agg(F.count(F.lit(1)).alias("_rows"))
        matched = stage(tgt_keys.join(src_keys, key), "keys")
        meta = matched.agg(F.max("_n_src"), F.sum("_rows")).first()
        if (meta[0] or 0) > 1:
            raise MergeCardinalityError(
                f"MERGE into {spec.path}: a target row is matched by more than one source row")
        replaced = None
        if not meta[1]:
            rows = src.withColumn(SLOT, F.lit("insert"))
        else:
            cols = _data_schema(prev).fieldNames() + [SLOT]
            parts = matched.select(F.col(PART).alias("part"), F.col(VERSION).alias("version")).distinct()
            if key_where is not None:
                replaced = parts = stage(parts, "segments")
            tgt = _state(spark, spec, prev, parts if replaced is not None else parts.select("part").distinct())
            keys = matched.select(key).distinct()
            # the source rows of matched keys (at most one per key), stored so the
            # left join's right side is a plain scan
            updates = stage(src.join(keys, key, "left_semi").select(*src.columns), "updates")
            rows = _merge_rows(tgt, src, key, cols, key_where, stage(keys, "matched"), updates)
        inserted, updated = _write_version(spec, rows, n, replaced)
        source_rows = src.count()
    finally:
        for path in staged:  # committed or failed: not read again
            delete_path(spark, path)
    return _append_commit(spark, spec, n, operation="upsert", source_rows=source_rows, inserted=inserted,
                          updated=updated, row_count=prev.row_count + inserted,
                          wrote_version=inserted + updated > 0, schema_json=prev.schema_json, txn=txn)


def write(spark: SparkSession, spec: TableSpec, df: DataFrame, stage_source: bool = True,
          txn: str | None = None, key_where: Column | None = None) -> CommitResult:
    """Create the table on first use, upsert on every later call.

    ``txn`` names the write (say a stream and its micro-batch id): it is
    stored in the commit row, and a write whose ``txn`` is the latest
    commit's is skipped and returns that commit, so a replayed batch commits
    once. The latest commit is enough with one writer at a time, as a retry
    or a stream replays only its last write (``foreachBatch`` hands over at
    most the last micro-batch again); it is already read here, so the check
    costs nothing. ``committed`` searches the whole log."""
    prev = _latest(spark, spec)
    if prev is not None:
        if txn is not None and prev.txn == txn:
            return _result(prev)
        return upsert(spark, spec, df, stage_source=stage_source, _prev=prev, txn=txn,
                      key_where=key_where)
    return create_table(spark, spec, df, _checked=True, txn=txn)


def stage(spark: SparkSession, spec: TableSpec, df: DataFrame, name: str) -> DataFrame:
    """Evaluate ``df`` once into the table's staging folder and read it back:
    later steps see identical rows and a short, columnar lineage. The caller
    removes the folder (``unstage``) once what read it is committed."""
    path = spec.staging_path(name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession, spec: TableSpec, name: str) -> None:
    """Remove a staging folder made by ``stage``."""
    delete_path(spark, spec.staging_path(name))
