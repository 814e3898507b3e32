"""Catalog page analytics on Spark: page snapshots in, product tables out."""
