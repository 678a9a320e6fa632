"""Composed plans: the preset, marts, tables and the registered queries."""
