"""Lakeload: move tables into and out of a data lake with Spark, and prove the move was right."""
