"""tessera: a PySpark-native analytics engine with a Postgres-flavoured relational surface."""

__version__ = "0.1.0"
