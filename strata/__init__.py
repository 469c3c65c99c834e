"""Strata: layered data jobs as plain DataFrame-to-DataFrame functions on Apache Spark."""
