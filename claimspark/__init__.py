"""claimspark: source-grounded claims as Spark DataFrames."""

__version__ = "0.1.0"
