"""Registered queries over the star schema, with the SQL each must agree with."""
