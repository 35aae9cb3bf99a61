"""outorga: a public-grants data mart built with PySpark DataFrames."""

__version__ = "0.1.0"
