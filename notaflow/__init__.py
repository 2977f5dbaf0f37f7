"""notaflow — PySpark-native service-invoice and tax-recovery analytics.

Every public operator is a ``DataFrame -> DataFrame`` function built from
public Spark APIs. Dates relative to "today" take an explicit ``as_of``.
"""

__version__ = "0.1.0"
