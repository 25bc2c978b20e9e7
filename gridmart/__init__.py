"""gridmart: a Spark-native medallion pipeline for yearly energy statistics.

Layers (each a pure DataFrame -> DataFrame function, keyed by ``entity``):

* ``sources``   - readers for long/wide CSV, capacity CSV, GeoJSON, seeds; table sinks.
* ``operators`` - bronze schema operators, pivots, windows, joins, data-quality checks.
* ``functions`` - Column expressions: rounding modes, flags, mapping rules, CUF, UTM->WGS84.
* ``plans``     - silver/gold assets, geo marts, serving queries, ``build_all``.
* ``streaming`` - incremental landing of new files with Structured Streaming.
"""

from gridmart.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
