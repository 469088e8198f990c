"""PySpark-native analytics engine for small-RNA reads, intervals and structures."""
