"""A PySpark-native cohort analytics engine."""
