"""Registered queries over the tables of a data folder, and the SQL that checks them."""
