"""Imports every catalog module, which registers its queries."""

from mlspark.catalog import analysis, cleaning, joined, modelling, ordered, recommenders, series, sources, streams, texts  # noqa: F401
