"""Whole runs made of operators, sources and sinks."""
