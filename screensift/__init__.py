"""screensift: screening classification (text -> TF-IDF -> models -> decisions) on Spark."""

__version__ = "0.1.0"
