"""Registered queries: the operators applied to the tables of an sf directory."""
