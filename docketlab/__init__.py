"""PySpark-native analytics for collections of case documents."""
