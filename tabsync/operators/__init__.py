"""Relational steps of a migration. Every operator takes and returns lazy DataFrames unless it says otherwise."""
