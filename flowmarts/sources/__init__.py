"""Readers and writers for raw captures, the flow table and the result marts."""
