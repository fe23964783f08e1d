"""PySpark-native analytics for labelled security telemetry."""
