"""Agencies, and the geography that products and trials stand in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import places, text
from tessera.loaders.build import Build


def region_key(region: Column) -> Column:
    return F.concat(F.lit("REGION:"), text.fold(region))


def vocabulary(b: Build) -> None:
    """Regions, countries with their region, agencies; it runs first, so its names win."""
    spark = SparkSession.active()
    where = places.countries(spark).withColumn("key", F.concat(F.lit("COUNTRY:"), "iso2")).withColumn("up", region_key(F.col("region")))
    b.add("Region", where.select("up", "region").distinct(), "vocab", key="up", name="region")
    b.add("Country", where, "vocab", key="key", iso2="iso2", name="name")
    b.add("IN_REGION", where, "vocab", src="key", dst="up", match_method=F.lit("structured"))
    b.add("RegulatoryAgency", places.agencies(spark), "vocab", key=F.concat(F.lit("AGENCY:"), "code"), code="code", name="name", country="country", region="region")


def conducted(b: Build, trials: DataFrame, source: str, names: Column) -> None:
    """trials: key, and the cell that the names come from."""
    b.add("CONDUCTED_IN", places.named(trials, "key", names), source, src="key", dst=F.concat(F.lit("COUNTRY:"), "iso2"), match_method=F.lit("name"))
