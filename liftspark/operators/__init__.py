"""Analytics operators over DataFrames."""
