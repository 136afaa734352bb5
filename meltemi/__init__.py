"""meltemi: air-quality and weather lakehouse jobs as PySpark DataFrames."""
