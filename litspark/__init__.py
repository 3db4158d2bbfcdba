"""PySpark-native analytics for quantitative literature review."""
