"""sextant: labelled-table preparation, modelling and evaluation operators on
PySpark DataFrames. Fitted statistics are tables joined back to the rows."""

__version__ = "0.1.0"
