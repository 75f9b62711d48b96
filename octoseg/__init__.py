"""Sketching, similarity clustering, naming and recombination screening of segmented genomes on Spark."""

__version__ = "0.1.0"
