"""Queries composed of the operators, each with the SQL that checks it."""
