"""Analytics operators and jobs for PySpark: every operator takes and returns DataFrames."""
