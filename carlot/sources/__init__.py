"""Scans (files, tables) and sinks."""
