"""Trip analytics on Spark: features, traffic counts, profiling and out-of-fold models."""
