"""Queries of the inventory bound to the driver's tables, with their SQL counterparts."""
