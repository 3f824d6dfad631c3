"""Registered queries: every operator on the provided tables, with its SQL check."""

from slatework.catalog import (  # noqa: F401
    aggregates,
    inputs,
    joins,
    modelling,
    scalars,
    shaping,
    views,
    windows,
)
from slatework.catalog.base import oracles, registered

__all__ = ["oracles", "registered"]
