"""Discovery operators. All take DataFrames and return DataFrames."""
