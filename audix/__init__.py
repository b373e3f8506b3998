"""audix: audience analytics as Spark DataFrame programs."""
