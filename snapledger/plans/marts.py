"""Mart views: the five public tables of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame

from snapledger.sources.folders import STORED

# Mart view -> refined table it shows in full.
MARTS = {
    "fact_crash": "refined_fact_crash",
    "fact_people": "refined_fact_people",
    "fact_vehicle": "refined_fact_vehicle",
    "dim_datetime": "refined_dim_datetime",
    "dim_location": "refined_dim_location_enriched",
}


def marts(refined: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {mart: refined[source].select("*") for mart, source in MARTS.items()}


def publish_views(frames: dict[str, DataFrame], prefix: str = "") -> None:
    """Register frames as temporary views for SQL users."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")


def export(frames: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write the marts as Parquet for a BI tool; returns the paths."""
    paths = {}
    for name, frame in frames.items():
        paths[name] = f"{root.rstrip('/')}/{name}"
        frame.write.mode("overwrite").options(**STORED).parquet(paths[name])
    return paths
