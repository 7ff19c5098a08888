"""Retail calendar analytics on Spark.

DataFrames in, DataFrames out:

* ``functions``  column expressions (text, dates, money, keys, budget figures)
* ``operators``  building blocks (lookup join, nearest dates, newest per key, ...)
* ``sources``    payload files, CSV, keyed tables, the job ledger
* ``plans``      the user-facing results (calendar, sales fact, opportunities, ...)
"""
