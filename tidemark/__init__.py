"""Change-data-capture and corpus analytics on PySpark DataFrames."""
