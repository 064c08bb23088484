"""Exposure-based count and rate analytics as Spark plans.

A table has one row per entity and period, an event count, an exposure measure
and descriptive covariates.  ``operators`` work on whole DataFrames,
``functions`` build single columns, ``models`` fit and score count models,
``sources`` read and write tables, ``streaming`` runs the scoring path on
streams and ``plans`` holds the ready-made queries over the driver's tables.
"""

__version__ = "0.1.0"
