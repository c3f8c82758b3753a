"""Tributary: public activity feeds to checked, query-ready tables, on Spark."""
