"""tanimart: a Spark-native similarity warehouse.

Layers (bronze -> silver -> gold) are plain DataFrame -> DataFrame functions;
only the jobs in ``tanimart.plans.build`` and ``tanimart.streaming`` write
(through ``tanimart.sources.sinks``).
"""

__version__ = "0.1.0"
