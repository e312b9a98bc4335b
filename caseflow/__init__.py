"""caseflow: business-analytics operators and named jobs on Spark DataFrames.

Every public operator takes DataFrames plus parameters and returns a
DataFrame.  Column names and business constants are arguments, so the same
operator runs on small inline fixtures and on large parquet tables.
"""

__version__ = "0.1.0"
