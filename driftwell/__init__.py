"""Driftwell: event analytics and text-corpus operators as plain Spark plans."""
