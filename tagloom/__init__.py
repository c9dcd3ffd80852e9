"""tagloom: a Spark-native engine for tag dictionaries and the page corpus that goes with them."""

__version__ = "0.1.0"
