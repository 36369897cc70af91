"""City data on Spark: from landing files to analysis tables."""
