"""Spark-native engine for extracting, matching, auditing and reporting on semi-structured course plans."""
