"""mlspark: analytics and data-science operators as PySpark DataFrame jobs."""

__version__ = "0.1.0"
