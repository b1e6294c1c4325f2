"""attesta: an evidence-first dataset engine on Spark DataFrames."""

__version__ = "0.1.0"
