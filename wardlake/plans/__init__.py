"""Warehouse builders and the queries, checks and reports that run over them."""
