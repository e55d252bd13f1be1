"""stockpulse: retail demand and inventory analytics as PySpark DataFrame jobs."""

__version__ = "0.1.0"
