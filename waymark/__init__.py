"""Waymark: reconciliation of places that several sources describe differently, as Spark DataFrame operators."""
