"""Review and short-text analytics on plain PySpark DataFrames."""
