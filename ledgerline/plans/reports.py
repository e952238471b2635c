"""The named campaign reports, each a declaration over the clean table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline import schemas
from ledgerline.operators import segments as S
from ledgerline.sources.files import export_report

RATE = "subscription_rate_pct"


@dataclass(frozen=True)
class Report:
    by: tuple[str, ...]
    measures: Callable[[], list[Column]]
    not_null: str | None = None
    unknown: str | None = None
    rename: dict[str, str] = field(default_factory=dict)

    def run(self, clients: DataFrame) -> DataFrame:
        if self.not_null:
            clients = clients.where(F.col(self.not_null).isNotNull())
        report = S.segment(clients, self.by, self.measures(), self.unknown, self.rename)
        return S.best_first(report, RATE, *(self.rename.get(k, k) for k in self.by))


def _clients() -> list[Column]:
    return [S.measure_count("n_clients"), S.measure_rate()]


def _calls() -> list[Column]:
    return [
        S.measure_count("n_calls"),
        S.measure_avg("duration", "avg_duration_sec", 1),
        S.measure_rate(),
    ]


REPORTS: dict[str, Report] = {
    "job": Report(
        ("job",),
        lambda: [*_clients(), S.measure_sum("y", "n_subscribed")],
        not_null="job",
    ),
    "month": Report(("month",), _calls),
    "balance_bucket": Report(
        ("balance_bucket",),
        lambda: [*_clients(), S.measure_avg("balance", "avg_balance", 0)],
    ),
    "education": Report(("education",), _clients, unknown=schemas.UNKNOWN),
    "contact": Report(
        ("contact",), _calls, unknown=schemas.UNKNOWN, rename={"contact": "contact_type"}
    ),
    "housing_loan": Report(("housing", "loan"), _clients),
    "poutcome": Report(("poutcome",), _clients, unknown=schemas.UNKNOWN),
}


def duration_cohort(clients: DataFrame) -> DataFrame:
    """Call length of subscribers against everyone else."""
    cohort = F.when(F.col("y") == 1, "subscribed").otherwise("not_subscribed")
    by_label = S.segment(clients, ["y"], [
        S.measure_count("n_calls"),
        S.measure_avg("duration", "avg_duration_sec", 1),
        F.min("duration").alias("min_duration_sec"),
        F.max("duration").alias("max_duration_sec"),
    ])
    return by_label.withColumn("cohort", cohort).drop("y")


def poutcome_rank(clients: DataFrame) -> DataFrame:
    return S.ranked(clients, "poutcome", "y", schemas.UNKNOWN, _clients())


def month_calendar(clients: DataFrame) -> DataFrame:
    """Subscription rate for all twelve months in calendar order."""
    return S.on_calendar(S.rate_by(clients, "month", "y"), "month", schemas.MONTHS, "month_no")


def age_bucket_rates(clients: DataFrame) -> DataFrame:
    """Subscription rate per age band, youngest first."""
    rates = clients.groupBy("age_bucket").agg(F.avg("y").alias("rate"))
    return S.on_calendar(rates, "age_bucket", schemas.AGE_LABELS, "position")


def job_rate_and_count(clients: DataFrame) -> DataFrame:
    rates = clients.where(F.col("job").isNotNull()).groupBy("job").agg(
        F.avg("y").alias("mean"), F.count("y").alias("count")
    )
    return S.best_first(rates, "mean", "job")


def run_all(clients: DataFrame) -> dict[str, DataFrame]:
    reports = {name: report.run(clients) for name, report in REPORTS.items()}
    reports["duration_cohort"] = duration_cohort(clients)
    reports["poutcome_rank"] = poutcome_rank(clients)
    return reports


def export_all(clients: DataFrame, folder: str) -> None:
    """Write every report as one CSV under ``folder``."""
    for name, report in run_all(clients).items():
        export_report(report, f"{folder}/{name}")
