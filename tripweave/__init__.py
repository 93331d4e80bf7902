"""tripweave: Spark-native telemetry normalisation, trip consolidation,
reconciliation and mobility marts.

Every operator is a DataFrame -> DataFrame function; the driver only builds
plans.  See README.md for the module map.
"""

__version__ = "0.1.0"
