"""postweave: a PySpark library for turning noisy short posts into clean business entities."""
