"""tripguard: quality scoring and privacy controls for trip tables, on Spark."""
