"""hypeline: Spark-native engagement-vs-performance pipeline.

Reusable DataFrame/Column operators (``functions``, ``operators``,
``sources``, ``sinks``, ``streaming``) and the composite models, daily run
and driver queries built from them (``plans``).  Everything is expressed
with built-in Spark SQL functions, so Catalyst sees and optimises the whole
plan: pruning, pushdown, join choice and adaptive re-planning.
"""

from hypeline.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
