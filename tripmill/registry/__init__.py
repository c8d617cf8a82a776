"""Registered queries on the test tables, with the SQL that checks them."""
