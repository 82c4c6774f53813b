"""Composed queries: detection, reporting views and their refresh."""
