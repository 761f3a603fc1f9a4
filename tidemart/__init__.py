"""tidemart: retail ELT, analytics and churn scoring on Spark DataFrames."""

__version__ = "0.1.0"
