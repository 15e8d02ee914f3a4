from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from propensity.leads import LEADS
from propensity.session import prepare_session
from propensity.spec import ROW_NUMBER


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare_session(session)
    session.stop()


def raw_records() -> list[dict[str, str]]:
    """Sixty rows of raw lead text."""
    records = []
    for i in range(60):
        records.append(
            {
                "lead_id": f"L{i:06d}",
                "created_at": f"2026-01-{1 + i // 24:02d} {i % 24:02d}:00:00",
                "product_type": ("carbody", "thirdparty")[i % 2],
                "channel": ("SEO", "Paid", "CRM")[i % 3],
                "device": ("desktop", "mobile")[i % 2],
                "partner": "direct",
                "city": "" if i == 5 else "Tehran",
                "insurance_company": "Iran",
                "payment_type": "cash",
                "minutes_since_abandonment": str(i + 1),
                "days_to_policy_expiry": str(i % 30 - 5),
                "price": "" if i == 4 else str(5_000_000 + 1000 * i),
                "discount_percent": str(i % 10),
                "has_previous_purchase": str(i % 2),
                "visited_offer_page": "1",
                "incoming_call_last_24h": "0",
                "sessions_last_7d": str(1 + i % 5),
                "offer_views_last_7d": str(i % 4),
                "price_comparisons_last_7d": str(i % 3),
                "days_since_last_visit": str(i % 12),
                "expected_margin": str(100_000 + 100 * i),
                "completed_purchase": str(int(i % 7 == 0)),
            }
        )
    return records


def raw_frame_of(spark, records: list[dict[str, str]]):
    columns = [c for c in LEADS.columns if c in records[0]]
    rows = [tuple(r[c] for c in columns) + (i,) for i, r in enumerate(records, 1)]
    schema = ", ".join(f"`{c}` string" for c in columns) + f", {ROW_NUMBER} long"
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def records():
    return raw_records()


@pytest.fixture(scope="session")
def raw_frame(spark):
    return raw_frame_of(spark, raw_records()).cache()
