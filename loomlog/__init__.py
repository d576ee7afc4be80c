"""loomlog: a PySpark-native analytics engine for timestamped message logs."""
