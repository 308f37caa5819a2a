"""quillwork: Spark-native analytics for report-style text and semi-structured records."""
