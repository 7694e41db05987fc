"""lakeloom: a Spark-native engine for nested-record lakes and the analytics over them."""
