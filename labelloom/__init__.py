"""Document annotation on Spark."""
