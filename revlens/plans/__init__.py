"""Wiring: the layered warehouse and the registered queries."""
