"""Readers (files -> tidy long DataFrames) and sinks."""
