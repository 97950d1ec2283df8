"""Spark-native analytics over media transcripts: search, transcript cleaning, speaker turns, audio dedup, reports."""
