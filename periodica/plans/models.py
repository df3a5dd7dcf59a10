"""The reporting models: staged facts -> deduplicated facts -> long metric mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.fixed_values import METRICS
from periodica.functions.scalars import month_end, not_equal_keep_null, surrogate_key
from periodica.operators.dedupe import keep_latest
from periodica.operators.series import add_metrics, densify_months, monthly_mean, to_long

BUSINESS_KEY = ["region", "manufacturer", "frequency", "month"]
SERIES_KEY = ["manufacturer", "frequency", "region"]

STAGE_CHECKS = {c: ["not_null"] for c in ["region", "manufacturer", "frequency", "month", "pdf_name", "inserted_at"]}
DEDUPED_CHECKS = {
    **{
        c: ["not_null"]
        for c in ["region", "manufacturer", "frequency", "month", "units", "pdf_name", "inserted_at"]
    },
    "id": ["unique", "not_null"],
}
MART_CHECKS = {c: ["not_null"] for c in ["manufacturer", "region", "frequency", "date"]}


def stage(raw: DataFrame) -> DataFrame:
    """Raw facts under their model names."""
    return raw.select(
        "region",
        "manufacturer",
        "frequency",
        "month",
        "units",
        F.col("pdf").alias("pdf_name"),
        "inserted_at",
    )


def deduplicate(staged: DataFrame) -> DataFrame:
    """The newest release's figure per business key, with its surrogate key.

    Releases are ordered by the date their 'Mon-YY' label stands for. Ties inside one release go to
    the later load, then to the greater figure.
    """
    dated = staged.withColumn("_release", month_end("pdf_name"))
    newest = keep_latest(dated, BUSINESS_KEY, ["_release", "pdf_name", "inserted_at", "units"])
    return newest.drop("_release").withColumn(
        "id", surrogate_key("manufacturer", "month", "frequency", "region")
    )


def wide_metrics(facts: DataFrame) -> DataFrame:
    """Monthly series with the nine metrics as columns."""
    monthly = facts.where(not_equal_keep_null("frequency", "YTD")).select(
        *SERIES_KEY, month_end("month").alias("date"), F.col("units").alias("UNITS")
    )
    dense = densify_months(monthly_mean(monthly, SERIES_KEY, "date", "UNITS"), SERIES_KEY, "date", "UNITS")
    return add_metrics(dense, SERIES_KEY, "date", "frequency")


def metrics_mart(facts: DataFrame) -> DataFrame:
    """The metric mart in long form, nine rows per series and month."""
    return to_long(wide_metrics(facts), ["manufacturer", "region", "frequency", "date"], METRICS)
