"""PySpark-native analytics for tool-use conversation data."""
