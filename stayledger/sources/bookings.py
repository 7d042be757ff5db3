"""Raw booking records: one JSON object per line (scan S1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DataExtractionError

CORRUPT = "_corrupt_record"
ROWS_PER_FILE = 250_000  # about 100 MB of lines
NOT_AS_DECLARED = "record does not have the declared form"


def with_corrupt_record(schema: T.StructType | str) -> T.StructType:
    """The declared schema with the column the parser puts a record into that does
    not fit it (a text where a number is declared, a line that is no JSON)."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def refuse_corrupt(df: DataFrame) -> DataFrame:
    """``df`` without its corrupt-record column; reading a row that has one set
    fails, so no leaf of it can turn into a silent null."""
    message = F.concat(F.lit(f"{NOT_AS_DECLARED}: "), F.substring(CORRUPT, 1, 200))
    fine = F.when(F.col(CORRUPT).isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    # the parser refuses to be asked for this column alone (say, by a count)
    other = next(c for c in df.columns if c != CORRUPT)
    return df.where(F.coalesce(fine, F.col(other).isNull())).drop(CORRUPT)


def read_bookings(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Scan JSON-lines bookings.

    Without ``schema`` the types are inferred from every line (one extra pass over
    the input, as in the original job, and what the schema check expects). With a
    declared schema the inference pass is skipped, and a record that does not
    fit it fails the job that reads it.
    """
    try:
        if schema is None:
            return spark.read.json(path)
        return refuse_corrupt(spark.read.schema(with_corrupt_record(schema)).json(path))
    except Exception as exc:  # missing path, unreadable files
        raise DataExtractionError(f"Failed to extract raw data from {path}: {exc}") from exc


def write_bookings(df: DataFrame, path: str) -> None:
    """Write nested bookings as JSON lines (used to build scan fixtures): gzipped, as most
    of a line is names, in files small enough that a scan has many to share out, since
    a gzipped file is not split."""
    (df.write.mode("errorifexists")
       .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
       .option("maxRecordsPerFile", ROWS_PER_FILE)
       .json(path))


# Declared form of the raw contract, for scans that skip inference (streams,
# or very large inputs). Scalar leaves take the types inference gives the
# booking files.
BOOKING_SCHEMA = (
    "id STRING, "
    "accommodations STRUCT<reservation: BIGINT>, "
    "accommodation_details STRUCT<accommodation: BIGINT>, "
    "booker STRUCT<address: STRUCT<country: STRING>, travel_purpose: STRING>, "
    "commission STRUCT<estimate_commission_amount: STRUCT<booker_currency: DOUBLE>>, "
    "currencies STRUCT<booker: STRING>, "
    "`end` STRING, label STRING, price STRUCT<total: DOUBLE>, start STRING, status STRING"
)
