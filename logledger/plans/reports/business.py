"""What happened: who, which actions, the latest events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.functions import values as v
from logledger.plans.reports.common import LAST_WEEK, recent, top


def user_mix(base: DataFrame, now: v.Instant) -> DataFrame:
    """Customer, partner and unknown events and distinct customers and partners, over 7 days.
    Events are counted per pair first; the distinct counts then see one row per pair."""
    rows = recent(base, "event_dt", v.instant(now), *LAST_WEEK)
    pairs = rows.groupBy("cust_id", "partner_name").agg(F.count("*").alias("n"))
    customer = F.col("cust_id") > 0
    nobody = F.col("cust_id") == 0
    named = F.col("partner_name").isNotNull()

    def events(which):
        return F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))

    return pairs.agg(
        F.lit("User Type Distribution").alias("check_name"),
        events(customer).alias("customer_events"),
        events(nobody & named).alias("partner_events"),
        events(nobody & ~named).alias("unknown_events"),
        F.count_distinct(F.when(customer, F.col("cust_id"))).alias("unique_customers"),
        F.count_distinct("partner_name").alias("unique_partners"),
    )


def action_mix(base: DataFrame, now: v.Instant) -> DataFrame:
    """Events per action and their share, over 7 days. The total is a scalar subquery over
    the grouped counts, so no task sees all groups."""
    rows = recent(base, "event_dt", v.instant(now), *LAST_WEEK)
    counts = rows.groupBy("action").agg(F.count("*").alias("event_count"))
    total = counts.agg(F.sum("event_count")).scalar()
    share = F.round(F.col("event_count") * 100 / total, 2)
    return counts.select("action", "event_count", share.alias("percentage")).orderBy(
        F.desc("event_count"), "action"
    )


def latest_events(base: DataFrame, limit: int = 20) -> DataFrame:
    newest = top(
        base, limit, F.desc("event_dt"), "hash_fingerprint", "gcs_uri", "action", "session_id"
    )
    return newest.select(
        "event_dt",
        "source",
        "user_name",
        "cust_id",
        "partner_name",
        "action",
        "filename",
        "bytes",
        "server_response",
    )
