"""Whole jobs: building the derived tables, and reporting on sites."""
