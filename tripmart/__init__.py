"""tripmart: trip analytics on Spark DataFrames.

Ingest, staging, marts, data tests and incremental loads for taxi-trip
data, written with built-in Spark SQL functions only.
"""

__version__ = "0.1.0"
