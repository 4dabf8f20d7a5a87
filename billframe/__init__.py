"""billframe: invoice-extraction analytics as PySpark DataFrame plans.

Every operator is a function ``DataFrame/Column -> DataFrame/Column`` built from
built-in Spark SQL expressions, so Catalyst can prune, push down and fuse them.
Per-row failure is carried as data (a ``hard_rule`` column), never as an
exception.
"""

__version__ = "0.1.0"
