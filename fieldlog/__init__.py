"""fieldlog: run-versioned play-by-play analytics and data-quality operators on Spark."""

__version__ = "0.1.0"
