"""Registered queries over the star-schema tables, and the SQL that checks them."""
