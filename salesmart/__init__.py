"""salesmart — a multi-source sales warehouse built as Spark DataFrame jobs.

Layers (each a plain ``DataFrame -> DataFrame`` function unless noted):

* ``sources``    typed extracts: CSV files, relational tables (JDBC), landed JSON pages
* ``functions``  column expressions: text rendering, safe conversion, cleaning, calendar
* ``operators``  staging, validation, de-duplication, surrogate keys, dimensions, fact,
                 source reconciliation, audit counts and sales rollups
* ``plans``      versioned table store, the end-to-end load, and the query registry
* ``streaming``  intentionally empty: the modelled system is a run-once batch load
"""

__version__ = "0.1.0"
