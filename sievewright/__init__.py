"""A Spark-native engine for building and quality-controlling policy-labelled evaluation datasets."""
