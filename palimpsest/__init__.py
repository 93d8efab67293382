"""Revision analytics on Spark: records that are published once and corrected later."""
