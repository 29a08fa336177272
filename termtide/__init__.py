"""Spark jobs for keyed time series, catalogues and cross-term indexes."""
