"""Layout analytics and corpus processing on Spark."""
