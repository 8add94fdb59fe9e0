"""Whole runs: sources in, tables and reports out."""
