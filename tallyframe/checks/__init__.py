"""Registered queries and the SQL that their results are compared with."""
