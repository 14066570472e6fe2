"""A PySpark-native engine for public property, permit, contractor and place data."""
