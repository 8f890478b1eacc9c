"""Registered queries over the given tables, each next to the SQL it is checked against."""
