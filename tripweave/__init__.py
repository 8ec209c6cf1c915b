"""Trip-record ETL and analytics as composable Spark DataFrame functions."""
