"""Layered transforms: Bronze to Silver and Gold, the daily run, reports."""
