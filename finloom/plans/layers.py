"""Raw to star schema as one lazy plan."""

from __future__ import annotations

from finloom.layer import Layer
from finloom.operators.clean import clean_layer
from finloom.operators.mart import mart_layer
from finloom.operators.silver import silver_layer


def silver_of(raw: Layer) -> Layer:
    return silver_layer(clean_layer(raw))


def mart_of(raw: Layer) -> Layer:
    """The star schema over raw tables; Spark prunes every step to what a query uses."""
    return mart_layer(silver_of(raw))
