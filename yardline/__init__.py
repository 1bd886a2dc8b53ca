"""Play-by-play analytics as Spark DataFrame functions."""
