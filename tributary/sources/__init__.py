"""Readers: Kafka-shaped records, landed JSON, bronze tables, listings, definitions."""
