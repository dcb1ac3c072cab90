"""Invoice document analytics on PySpark: every step is a function from DataFrames to DataFrames."""
