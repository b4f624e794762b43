"""daybook: daily sales statistics from a line-item table, on Spark.

Public entry points:

* ``daybook.sources`` - line-item readers and the published-table reader;
* ``daybook.operators`` - first-order dimension, daily statistics,
  data-quality profiles and the partitioned sink;
* ``daybook.plans`` - the backfill, daily and table-creation jobs.
"""

__version__ = "0.1.0"
