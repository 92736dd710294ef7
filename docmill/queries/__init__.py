"""All registered queries of the engine, by the inventory's keys."""

from . import analyst, calculated, casts, combine, contracts, fanouts, quality, relational, rows, shredding, summaries, writing  # noqa: F401
from .base import ORACLE, QUERIES  # noqa: F401
