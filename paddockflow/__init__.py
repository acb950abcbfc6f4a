"""Racing-telemetry analytics as plain PySpark DataFrame functions.

Every transform takes a DataFrame and returns a DataFrame, and works unchanged on
a batch table or a Structured Streaming source.  Only ``paddockflow.streaming``
starts queries.
"""

__version__ = "0.1.0"
