"""lexmill: a Spark-native engine for building and analysing corpora of licence text."""
