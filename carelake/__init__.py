"""Spark-native operators for clinical, claims, pharmacy and laboratory data."""
