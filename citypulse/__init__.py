"""Population, economy and presence analytics for cities, on PySpark DataFrames."""
