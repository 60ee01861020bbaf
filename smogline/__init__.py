"""smogline — a Spark-native engine for daily sensor panels.

Quality scoring of sensors, per-series averaging, weather merge, bounded gap
repair, forecasting features, exploratory statistics, baselines over time
folds and a model-monitoring loop, all written as DataFrame expressions.

Sub-packages:

* ``sources``   — table scans, JSON payload readers, fixture adapters, storage
* ``functions`` — scalar column expressions (calendar, transforms, scores)
* ``operators`` — DataFrame -> DataFrame operators (quality, series, joins, stats)
* ``plans``     — compositions: preprocessing chain, forecasting, monitoring
* ``streaming`` — Structured Streaming forms of the incremental jobs
"""

__version__ = "0.1.0"
