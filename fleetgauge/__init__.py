"""Device-stream analytics on Spark.

Readings flow through four layers: bronze (as received), silver (joined to
the device and calendar dimensions, scored, checked), gold (event-time
window averages) and alerts (averages above a device's threshold). Every
transform takes and returns DataFrames and works on batch and streaming
input alike; only ``sources``, ``sinks``, ``streaming`` and ``plans`` know
which of the two they deal with.
"""

__version__ = "0.1.0"
