"""Shared inputs for the registered plans: fixture tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitelens.operators.clean import clean_venues
from sitelens.sources.fixtures import view


def venues_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "venues_raw")


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean venue table, made by the engine's own cleaning code."""
    return clean_venues(venues_raw(spark, sf_dir))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "clicks")


def cluster_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "cluster_points")


def cloud_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "cloud_target")


def cloud_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "cloud_source")


def mesh_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "mesh_triangles")


def places_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "places_pages")
