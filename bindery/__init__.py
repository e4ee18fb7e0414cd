"""Record linkage, point-in-time features, label audit and model evaluation on Spark DataFrames."""
