"""Exception hierarchy of the warehouse jobs."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# What a failed Spark job raises: known errors arrive converted, others as they are.
JOB_ERRORS = (PySparkException, Py4JJavaError)


class BookingPipelineError(Exception):
    """Base class: catch this to catch any job failure."""


class DataExtractionError(BookingPipelineError):
    """Reading the raw records failed."""


class CheckFailed(BookingPipelineError):
    """A check of the input did not hold. ``check`` names it; ``columns`` are the
    offending columns and ``count`` the offending rows or keys, where it has them."""

    def __init__(self, check: str, text: str, columns: tuple[str, ...] = (), count: int | None = None) -> None:
        super().__init__(f"{check}: {text}")
        self.check, self.columns, self.count = check, tuple(columns), count


class SchemaValidationError(CheckFailed):
    """The raw records do not have the expected structure."""


class DataQualityError(CheckFailed):
    """The transformed rows break a value rule."""


class TableWriteError(BookingPipelineError):
    """A commit to the versioned table failed."""


class MergeCardinalityError(TableWriteError):
    """Several source rows match one target row in an upsert."""
