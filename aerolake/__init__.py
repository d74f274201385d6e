"""aerolake: aircraft position and flight analytics as PySpark DataFrame jobs.

Layout
------
functions/  column expressions (time keys, codes, rounding, hashing)
sources/    readers for driver tables, JSON/CSV/Parquet files and trace archives; sinks
operators/  DataFrame -> DataFrame transformations (silver, gold, flights, windows, quality)
plans/      named queries over a table directory and their DuckDB oracle SQL
streaming/  incremental file pickup and watermarked streaming aggregates
"""

__version__ = "0.1.0"
