"""Command-line entry points for spark-submit."""
