"""tidemark: a Spark-native engine for ordered sensor recordings and training-data tables."""
