"""Zonal indicators over rasters, vector features and points, as Spark DataFrame operators."""
