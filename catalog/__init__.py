"""Registered queries and, beside each, the same result in plain SQL."""
