"""Spark-native retail demand, elasticity and pricing analytics."""
