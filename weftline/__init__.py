"""Record matching and training-data analytics as lazy Spark DataFrame plans."""
