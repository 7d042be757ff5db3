"""Small DataFrame helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayledger.session import collect_garbage, scratch_path, ship_package, shared_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder. Queries start here, so their code is sent, and small
    batches of texts are asked for, too."""
    ship_package(spark)
    whole_texts(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def whole_texts(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows, where the session has Spark's default of 10,000:
    rows are whole texts here, and executor and Python worker each hold a batch
    or two of them outside the heap. Only the registered queries and the pipeline ask for
    this; the operators leave the session as it is."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed to the shared folder: its lineage ends there, and a
    lost executor costs a re-read, not a recomputation. Use on narrow rows."""
    shared_root(df.sparkSession)  # names the checkpoint dir where a test set none
    return df.checkpoint(eager=True)


def spill(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: as `cut`, and its size is
    known to the planner, which then broadcasts what is small. Its path is appended to
    ``paths``, for a caller that removes the table when nothing reads it any more."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the files of shuffles that nothing refers to any more: its
    cleaner notices them when the driver's JVM collects garbage. Called where a large
    shuffle has just been written out as a table."""
    collect_garbage(spark)


def let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def part_of(array: Column, first: Column, n: int) -> Column:
    """Up to ``n`` values of a non-empty array from number ``first`` (0-based, within it) on,
    in time that does not grow with the array, as that of ``slice`` does."""
    last = F.least(first + n, F.size(array)) - 1
    return F.transform(F.sequence(first, last), lambda i: F.get(array, i))


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def doc_key(doc_id: Column, text: Column) -> Column:
    """64-bit key of a document: its id and text. Rows that repeat both are one
    document; rows without an id still differ by text."""
    return F.xxhash64(doc_id.cast("string"), text)
