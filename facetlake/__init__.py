"""A Spark-native engine for tables that describe solid parts and the datasets built from them."""
