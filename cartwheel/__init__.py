"""Commerce analytics on Spark: raw, trusted and curated layers as DataFrame functions."""
