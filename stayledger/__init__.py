"""stayledger: a Spark-native booking warehouse.

Raw nested booking records are scanned, checked, flattened into a 15-column
table, and committed into a versioned, partitioned Parquet table with a commit
log and a row changelog. Everything is a function from DataFrames to
DataFrames (or a small commit result); Spark plans and runs all row work.
"""

__version__ = "0.1.0"
