"""The six normalised tables as one value."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class CollisionTables:
    boroughs: DataFrame
    collisions: DataFrame
    vehicle_types: DataFrame
    collision_vehicles: DataFrame
    factors: DataFrame
    collision_factors: DataFrame

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]
