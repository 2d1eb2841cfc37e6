"""gridloom: Spark-native preparation of simulation experiment tables and gridded fields.

The package is a set of plain functions from DataFrame to DataFrame (and from
Column to Column) that a Spark user composes into jobs:

* ``gridloom.functions``  column expressions for cells, names, angles and statistics
* ``gridloom.sources``    readers and writers for batch tables, stage summaries,
  file inventories, logs, geometry and field tables
* ``gridloom.operators``  joins, aggregates and windows of the domain
* ``gridloom.plans``      whole jobs composed from the operators
* ``gridloom.streaming``  Structured Streaming forms of the progress reports
"""

__version__ = "0.1.0"
