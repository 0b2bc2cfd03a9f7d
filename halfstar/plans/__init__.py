"""Assembled plans: the prepared tables and the registered queries."""
