"""crashlake: road-collision analytics on Spark DataFrames.

Sub-packages:
  sources    - feed reader, table store, fixtures built from the driver tables
  functions  - column expressions (cleaning, rounding)
  operators  - normalisation, integrity checks, rankings, dashboard, star schema
  plans      - the registered query catalog and its DuckDB oracle statements
  streaming  - incremental (micro-batch) loading of a landing directory
"""

from crashlake.tables import CollisionTables

__all__ = ["CollisionTables"]
