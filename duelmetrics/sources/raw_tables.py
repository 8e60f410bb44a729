"""Flat newline-delimited JSON loads with a declared schema.

A line that cannot be read in full ends the load. ``tolerant`` goes on without
what is broken, which ``payloads.count_lines`` and ``rejected_lines`` account
for. Lines without any
declared content are left out.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from duelmetrics.schemas import RAW_GAMES, RAW_PLAYERS
from duelmetrics.sources.payloads import Paths, read_payloads


def read_raw_games(spark: SparkSession, paths: Paths, tolerant: bool = False) -> DataFrame:
    return read_payloads(spark, paths, RAW_GAMES, strict=not tolerant).na.drop("all")


def read_raw_players(spark: SparkSession, paths: Paths, tolerant: bool = False) -> DataFrame:
    return read_payloads(spark, paths, RAW_PLAYERS, strict=not tolerant).na.drop("all")


def one_load(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, duplicates kept."""
    return reduce(DataFrame.unionByName, parts)
