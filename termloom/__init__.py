"""Instruction data and answer grading as Spark DataFrame transformations."""

__version__ = "0.1.0"
