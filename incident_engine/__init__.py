"""Public-safety incident analytics as Spark DataFrame transformations."""
