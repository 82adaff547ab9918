"""patronage: customer-value analytics (RFM, category interest, survival, grades) on PySpark."""

__version__ = "0.1.0"
