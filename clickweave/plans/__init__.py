"""Whole jobs: tables in, result tables out."""
