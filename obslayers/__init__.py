"""Batch and live views over timestamped station observations, on PySpark.

Every operator is a ``DataFrame -> DataFrame`` function that also works inside
``DataFrame.transform``; the ones that make sense on a stream accept streaming
frames unchanged.
"""

__version__ = "0.1.0"
