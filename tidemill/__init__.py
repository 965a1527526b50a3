"""tidemill: a Spark-native batch data-quality and analytics engine."""
