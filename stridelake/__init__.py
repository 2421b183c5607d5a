"""stridelake: Spark-native analytics for episodes of time-ordered vectors."""
