"""Composite flows: cleaning, step accounting, the ETL run, registered queries."""

from brightwash.plans.clean import (
    CleanListings,
    clean_listings,
    clean_neighbourhoods,
    clean_reviews,
    step_accounting,
    typed_and_filled,
)

__all__ = [
    "CleanListings",
    "clean_listings",
    "clean_neighbourhoods",
    "clean_reviews",
    "step_accounting",
    "typed_and_filled",
]
