"""Queries over the test tables, each with an equivalent SQL text where one can be written."""
