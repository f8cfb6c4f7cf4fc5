"""Training-data operators: filtering, deduplication, packing and token output on Spark.

Nothing outside this package imports it.  Every operator takes a DataFrame plus the names of
the columns that it reads and leaves the input's other columns alone.
"""
