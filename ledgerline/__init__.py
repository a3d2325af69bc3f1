"""Sales modelling and margin analytics on PySpark: raw ERP exports -> star schema -> analyses."""

__version__ = "0.1.0"
