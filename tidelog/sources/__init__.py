"""Readers and writers: change feeds, text, Kafka-shaped frames, JDBC, nested rows."""
