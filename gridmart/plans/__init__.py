"""Assets (bronze/silver/gold/geo), serving queries, builds and driver queries."""
