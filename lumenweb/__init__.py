"""lumenweb: PySpark-native analytics over crawled web pages and domain lists."""

__version__ = "0.1.0"
