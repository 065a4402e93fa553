"""Business reports, as SQL over a stored layer or any frame of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.segments import band_profile


def top_jobs_by_balance(gold: DataFrame, k: int = 5, active_days: int = 30) -> DataFrame:
    """Jobs with the highest mean balance among recent customers who have not subscribed."""
    return gold.sparkSession.sql(
        """
        SELECT job, count(*) AS total_customers,
               round(round(avg(balance), 6), 0) AS avg_balance, round(round(avg(Monetary), 6), 0) AS avg_monetary
        FROM {gold}
        WHERE y = 'no' AND Recency <= :active_days
        GROUP BY job
        ORDER BY avg_balance DESC, job
        LIMIT :k
        """,
        args={"k": k, "active_days": active_days},
        gold=gold,
    )


def credit_risk_by_education(gold: DataFrame) -> DataFrame:
    """How many customers of each education level are overdrawn."""
    return gold.sparkSession.sql(
        """
        SELECT education, count_if(balance < 0) AS negative_balance_count, count(*) AS total,
               round(count_if(balance < 0) * 100.0D / count(*), 2) AS risk_pct
        FROM {gold}
        GROUP BY education
        ORDER BY risk_pct DESC, education
        """,
        gold=gold,
    )


def segment_report(segments: DataFrame) -> DataFrame:
    return band_profile(segments)
