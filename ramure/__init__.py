"""Assign short product texts to codes of a dotted nomenclature, and measure how well it went, on Spark."""
