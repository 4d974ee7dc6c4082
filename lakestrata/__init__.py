"""lakestrata: Spark-native lakehouse pipelines (listings warehouse and click stream)."""

__version__ = "0.1.0"
