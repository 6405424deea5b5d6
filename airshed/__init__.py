"""airshed: Spark-native air-quality analytics over DataFrames and Spark SQL."""

__version__ = "0.1.0"
