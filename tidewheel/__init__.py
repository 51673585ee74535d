"""tidewheel: Spark-native reduction of time-ordered instrument data."""
