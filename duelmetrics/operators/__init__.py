"""Reusable DataFrame operators; each works on any table by column names."""
