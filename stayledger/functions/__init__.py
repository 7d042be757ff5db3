"""Column expressions: all built-in Spark functions, no UDFs."""

from .columns import *  # noqa: F401,F403
