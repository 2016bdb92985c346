"""Dialogue data preparation and reply evaluation as Spark DataFrame operators."""
