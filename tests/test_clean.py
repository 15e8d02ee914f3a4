from __future__ import annotations

import pytest
from conftest import raw_frame_of
from pyspark.sql import functions as F

from propensity.leads import LEADS, feature_availability
from propensity.operators.clean import check, coerce, prepare, quarantine, select_features, violation_counts
from propensity.spec import DataContractError


def changed(spark, records, row, **cells):
    records[row] |= cells
    return raw_frame_of(spark, records)


def test_target_and_id_are_no_features(raw_frame):
    features = select_features(prepare(raw_frame, LEADS).frame, LEADS)
    assert features.columns == list(LEADS.features)
    assert len(LEADS.numeric_features) == 14 and len(LEADS.categorical) == 7
    assert LEADS.target not in features.columns and LEADS.id not in features.columns


def test_audit_covers_every_column_and_guards_the_features(spark):
    audit = feature_availability(spark)
    assert audit.count() == 22
    assert {r["model_use"] for r in audit.collect()} == {"Include", "Exclude", "Derived only"}
    from dataclasses import replace

    with pytest.raises(DataContractError, match="completed_purchase"):
        replace(LEADS, numeric=(*LEADS.numeric, "completed_purchase")).check_audit()


@pytest.mark.parametrize(
    ("cells", "message"),
    [
        ({"completed_purchase": "yes"}, "completed_purchase has malformed"),
        ({"completed_purchase": "2"}, "must be binary"),
        ({"completed_purchase": ""}, "must be binary"),
        ({"discount_percent": "101"}, r"discount_percent has values outside \[0, 100\].*1 rows; sample=\[101.0\]"),
        ({"price": "not-a-number"}, "price has malformed numbers: 1 rows; sample=.*not-a-number"),
        ({"price": "1d"}, "price has malformed"),
        ({"has_previous_purchase": "3"}, "has_previous_purchase contains values outside 0/1"),
        ({"lead_id": "  "}, "lead_id contains missing"),
        ({"created_at": ""}, "created_at contains invalid timestamps: 1 rows"),
        ({"created_at": "12:30"}, "created_at has malformed"),
        ({"created_at": "2026-01"}, "created_at has malformed"),
        ({"created_at": "2026-02-30 00:00:00"}, "created_at has malformed"),
    ],
)
def test_bad_cells_are_rejected(spark, records, cells, message):
    with pytest.raises(DataContractError, match=message):
        prepare(changed(spark, records, 0, **cells), LEADS)


def test_samples_come_in_row_order(spark, records):
    for i in range(50):
        records[i]["price"] = str(-1 - i)
        records[i]["completed_purchase"] = str(2 + i // 2)
    with pytest.raises(DataContractError, match=r"50 rows; sample=\[2.0, 3.0, 4.0, 5.0, 6.0\]"):
        check(raw_frame_of(spark, records).repartition(7), LEADS)
    with pytest.raises(DataContractError, match=r"50 rows; sample=\[-1.0, -2.0, -3.0\]"):
        check(raw_frame_of(spark, records).repartition(7), LEADS, require_target=False)


def test_one_class_is_rejected(spark, records):
    for r in records:
        r["completed_purchase"] = "0"
    with pytest.raises(DataContractError, match="both classes"):
        check(raw_frame_of(spark, records), LEADS)


def test_missing_column_is_named(raw_frame):
    with pytest.raises(KeyError, match="price"):
        prepare(raw_frame.drop("price"), LEADS)


def test_range_bounds_are_inclusive(spark, records):
    frame = changed(spark, records, 0, discount_percent="100", days_to_policy_expiry="-365", price="0")
    assert check(frame, LEADS) == 60


def test_target_is_optional(raw_frame):
    prepared = prepare(raw_frame.drop("completed_purchase"), LEADS, require_target=False)
    assert "completed_purchase" not in prepared.frame.columns
    assert select_features(prepared.frame, LEADS).columns == list(LEADS.features)


def test_earliest_record_is_kept(spark, records):
    records.append(records[0] | {"created_at": "2026-01-03 23:59:00"})
    prepared = prepare(raw_frame_of(spark, records), LEADS)
    assert prepared.rows_in == 61 and prepared.duplicates_removed() == 1
    first = prepared.frame.where("lead_id = 'L000000'").first()
    assert str(first["created_at"]) != "2026-01-03 23:59:00" and first["created_hour"] == 0.0


def test_equal_times_keep_the_first_row(spark, records):
    records.append(records[3] | {"price": "1"})
    kept = prepare(raw_frame_of(spark, records), LEADS).frame.where("lead_id = 'L000003'").first()
    assert kept["price"] == 5_003_000.0


def test_blank_rules_differ(spark, records):
    frame = changed(spark, records, 0, price="   ", city="  ", partner="")
    typed = coerce(frame, LEADS).where("lead_id = 'L000000'").first()
    assert typed["price"] is None and typed["city"] == "  " and typed["partner"] is None


@pytest.mark.parametrize(
    ("text", "value"),
    [("1e3", 1000.0), ("1E-3", 0.001), ("\u00a0", None), ("NaN", None), ("INF ", float("inf")), (" 5 ", 5.0), ("+.5", 0.5), ("7.", 7.0), ("nan", None), ("inf", float("inf")), ("-Infinity", float("-inf"))],
)
def test_accepted_number_texts(spark, records, text, value):
    frame = changed(spark, records, 0, price=text)
    assert coerce(frame, LEADS).where("lead_id = 'L000000'").first()["price"] == value
    assert violation_counts(frame, LEADS).where("rule = 'malformed:price'").first()["rows"] == 0


@pytest.mark.parametrize("text", ["5f", "5F ", "2.D", "0x10", "0x1p3", "1,000", "1_000", "--1", "1e", "e5", ".", "5 5", "infx", "\u0665"])
def test_refused_number_texts(spark, records, text):
    frame = changed(spark, records, 0, price=text)
    assert coerce(frame, LEADS).where("lead_id = 'L000000'").first()["price"] is None
    assert violation_counts(frame, LEADS).where("rule = 'malformed:price'").first()["rows"] == 1


@pytest.mark.parametrize(
    ("text", "shown"),
    [
        ("2026-01-05T03:00:00Z", "2026-01-05 03:00:00"),
        ("2026-01-05 03:00:00+03:30", "2026-01-04 23:30:00"),
        ("2026-01-05", "2026-01-05 00:00:00"),
        ("2026-01-05 03:04:05.250", "2026-01-05 03:04:05"),
    ],
)
def test_times_are_read_as_utc(spark, records, text, shown):
    typed = coerce(changed(spark, records, 0, created_at=text), LEADS).where("lead_id = 'L000000'")
    assert typed.select(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")).first()[0] == shown


def test_time_parts(raw_frame):
    row = prepare(raw_frame, LEADS).frame.where("lead_id = 'L000030'").first()  # Friday 2026-01-02 06:00
    assert (row["created_hour"], row["created_day_of_week"]) == (6.0, 4.0)


def test_quarantine_parts_the_rows(spark, records):
    records[1]["price"], records[1]["discount_percent"] = "x", "500"
    records[2]["lead_id"] = ""
    good, bad = quarantine(raw_frame_of(spark, records), LEADS)
    assert good.count() == 58
    reasons = {r["source_row_number"]: r["reasons"] for r in bad.collect()}
    assert reasons == {2: ["malformed:price", "range:discount_percent"], 3: ["id_missing"]}
    assert bad.where("source_row_number = 2").first()["price"] == "x"


def test_hot_id_is_reduced_before_the_shuffle(raw_frame):
    from propensity.operators.clean import keep_earliest

    plan = keep_earliest(coerce(raw_frame, LEADS), LEADS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
