"""Registered queries and their SQL counterparts over the driver's tables."""
