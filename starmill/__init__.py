"""starmill: warehouse ETL and star-schema analytics as Spark DataFrame functions."""
