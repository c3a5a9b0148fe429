"""Operators of a training-data pipeline: cleaning, scoring, searching and packing whole document tables."""
