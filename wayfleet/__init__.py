"""Spark-native analytics over connected-vehicle telemetry.

Layers follow the usual raw -> flat -> product shape:

* ``sources`` / ``streaming`` bring raw JSON in and keep track of what was read,
* ``functions`` are Column-level rules (dates, insurance, ratios, statuses, alerts),
* ``operators`` are DataFrame -> DataFrame steps (flatten, latest, merge, rank, quality),
* ``plans`` compose them into the tables and reports users query,
* ``sinks`` write tables so that a rerun or a lost executor never corrupts them.
"""

__version__ = "0.1.0"
