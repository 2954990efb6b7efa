"""Research marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def roll_call_results(rolls: DataFrame, bills: DataFrame, votes: DataFrame, roll: str = "roll_call_id", bill: str = "bill_id", position: str = "position") -> DataFrame:
    """Rolls with their bill and tallies. Votes are tallied before the join, so nothing fans out."""
    p = F.col(position)
    tallies = votes.groupBy(roll).agg(
        F.count_if(p == "yes").alias("yea_count"), F.count_if(p == "no").alias("nay_count"), F.count_if(~p.isin("yes", "no")).alias("other_count"), F.count("*").alias("total_votes")
    )
    out = rolls.join(bills, bill, "left").join(tallies, roll, "left")
    return out.fillna(0, ["yea_count", "nay_count", "other_count", "total_votes"])


def geography_year(measurements: DataFrame, geography: DataFrame, key: str, day: str, value: str, by: list[str], carried: list[str]) -> DataFrame:
    """Average, least, greatest and number of measurements per place, series and year.

    Aggregated first by the key, then joined with the place's attributes: a row per group meets the
    geography, not a row per measurement. A decimal value gives the same average in any order of the rows.
    """
    panel = measurements.groupBy(key, *by, F.year(day).alias("period_year")).agg(
        (F.sum(value).cast("double") / F.count(value)).alias("value_numeric_avg"), F.min(value).alias("value_numeric_min"), F.max(value).alias("value_numeric_max"), F.count("*").alias("observation_count")
    )
    return panel.join(geography.select(key, *carried), key, "left")
