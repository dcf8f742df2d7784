"""Training-data operators: each module is one operator over DataFrames."""
