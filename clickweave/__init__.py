"""Clickstream analytics on Spark: sessions, categories, funnels, regions and ad clicks."""

from clickweave.params import TaskParams
from clickweave.session import build_session

__all__ = ["TaskParams", "build_session"]
