"""Registered queries: the engine's operators over the given tables, each with its SQL."""
