"""Data checks: declared checks, monitors and their results."""
