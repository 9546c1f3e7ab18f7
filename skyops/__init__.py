"""Spark-native flight-operations analytics: landing pages to checked, versioned, analysis-ready tables."""
