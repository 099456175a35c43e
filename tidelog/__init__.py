"""Change feeds, keyed tables and continuous queries as Spark DataFrame operators."""
