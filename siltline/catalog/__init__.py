"""One checked query per operator, with the SQL that gives the same rows."""

from siltline.catalog import analysis, cleaning, history, joining, ingest, models, quality, shapes, streams  # noqa: F401
from siltline.catalog.base import REGISTRY

__all__ = ["REGISTRY"]
