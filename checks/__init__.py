"""Registered queries: clinical inputs derived from the driver tables, and their SQL oracles."""
