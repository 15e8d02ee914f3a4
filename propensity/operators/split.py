"""Chronological train / validation / test split."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.operators.order import order_statistics
from propensity.spec import DataContractError, TableSpec

TRAIN_SHARE, VALIDATION_SHARE = 0.70, 0.85
SPLITS = ("train", "validation", "test")


@dataclass(frozen=True)
class Split:
    """One frame with a ``split`` column, and the two cutoffs in microseconds since 1970."""

    frame: DataFrame
    train_micros: int
    validation_micros: int

    def part(self, name: str) -> DataFrame:
        return self.frame.where(F.col("split") == name).drop("split")

    @property
    def cutoffs(self) -> tuple[datetime, datetime]:
        epoch = datetime(1970, 1, 1)
        from datetime import timedelta

        return tuple(epoch + timedelta(microseconds=m) for m in (self.train_micros, self.validation_micros))


def micros(time: str) -> Column:
    """Time as microseconds since 1970; reads zone-less times as UTC (the session's zone)."""
    return F.unix_micros(F.col(time).cast("timestamp"))


def cutoffs(df: DataFrame, time: str) -> tuple[int, int]:
    """The times nearest to the 70 % and 85 % points of the time order."""
    shares = [(TRAIN_SHARE, "nearest"), (VALIDATION_SHARE, "nearest")]
    found = order_statistics(df.select(micros(time).alias("t")), {"t": shares})["t"]
    if found[shares[0]] is None:
        raise DataContractError("cannot split an empty table")
    return int(found[shares[0]]), int(found[shares[1]])


def chronological_split(df: DataFrame, spec: TableSpec, check: bool = True) -> Split:
    """Label every row; equal times stay together. Raises if a part is empty."""
    first, second = cutoffs(df, spec.time)
    at = micros(spec.time)
    label = F.when(at < first, "train").when(at < second, "validation").otherwise("test")
    split = Split(df.withColumn("split", label), first, second)
    if check:
        present = {r[0] for r in split.frame.select("split").distinct().collect()}
        if present != set(SPLITS):
            raise DataContractError(f"chronological split left parts empty: {sorted(set(SPLITS) - present)}")
    return split


def split_summary(split: Split, spec: TableSpec) -> DataFrame:
    """Rows, positives, prevalence and time span of each part."""
    return split.frame.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.sum(F.col(spec.target).cast("long")).alias("positives"),
        F.avg(F.col(spec.target).cast("double")).alias("prevalence"),
        F.min(spec.time).alias("created_min"),
        F.max(spec.time).alias("created_max"),
    )
