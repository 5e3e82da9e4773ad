"""Spark-native clinical warehouse: star-schema loads, analytics, validation, run logs and audit."""
