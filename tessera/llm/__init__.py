"""Training-data pipeline operators (ten operators, their queries and SQL)."""
