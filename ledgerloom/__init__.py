"""ledgerloom: retail reconciliation analytics as Spark DataFrame operators.

Layout
------
sources/    readers and writers (strict CSV, projected Parquet, nested JSON, lake tables)
functions/  column expressions (conformed keys, document sign, money, stock readings)
operators/  DataFrame -> DataFrame building blocks (dimensions, facts, as-of join,
            gaps-and-islands, marts, data checks)
plans/      wiring: time anchors, bindings onto the benchmark tables, layered run,
            query catalogue and its SQL oracle
"""

__version__ = "0.1.0"
