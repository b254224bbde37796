"""Dump names, retention and the lists of new dumps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from changetide.functions.columns import at, micros
from changetide.schema import (
    DEFAULT_MAX_AGE_DAYS,
    DUMP_NAME_PATTERN,
    DUMP_TIME_FORMAT,
    MIN_MAX_AGE_DAYS,
)


def parse_dump_names(files: DataFrame) -> DataFrame:
    """Adds `is_valid_filename` and `ts` (time in the name, NULL if the name is not a dump's).

    A well-formed name with an impossible date is not valid.
    """
    stamp = F.regexp_extract("filename", DUMP_NAME_PATTERN, 1)
    ts = F.when(
        F.col("filename").rlike(DUMP_NAME_PATTERN), F.try_to_timestamp(stamp, F.lit(DUMP_TIME_FORMAT))
    )
    return files.withColumns({"is_valid_filename": ts.isNotNull(), "ts": ts})


def select_ready_dumps(files: DataFrame) -> DataFrame:
    return parse_dump_names(files).where("is_valid_filename").drop("is_valid_filename")


def expired_dumps(
    files: DataFrame, as_of: dt.datetime | str, max_age_days: int = DEFAULT_MAX_AGE_DAYS
) -> DataFrame:
    """Dumps strictly older than the limit, by name; other files never expire."""
    if max_age_days <= 0:
        raise ValueError("maximum age must be positive")
    if max_age_days < MIN_MAX_AGE_DAYS:
        raise ValueError(f"maximum age must be at least {MIN_MAX_AGE_DAYS} days")
    age = micros(at(as_of)) - micros(F.col("ts"))
    old = age > F.lit(max_age_days * 86_400_000_000)
    return select_ready_dumps(files).where(old).orderBy("filename")


def new_dumps(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files whose loading has not been completed before."""
    loaded = registry.where(F.col("fact") == "load_complete").select("filename")
    return files.join(loaded, "filename", "left_anti")
