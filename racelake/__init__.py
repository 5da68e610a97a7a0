"""racelake: data-quality, point-in-time, lineage and scoring operators as PySpark DataFrame functions."""
