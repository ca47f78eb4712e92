"""Customer-history engine on Spark: type 2 history, type 1 mirror, business attributes and rankings."""
