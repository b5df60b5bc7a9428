"""Sentiment and topic-trend analytics over timestamped posts, as Spark DataFrame operators."""
