"""cardamom: a Spark-native engine for product catalogs and large tables."""
