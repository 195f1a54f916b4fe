"""Column functions on literals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trialmart.functions import categories as cat
from trialmart.functions import dates, numbers, text

NBSP = " "


def value(spark, column_of, *inputs, kind="string"):
    names = [f"c{i}" for i in range(len(inputs))]
    df = spark.createDataFrame([inputs], ", ".join(f"{n} {kind}" for n in names))
    return df.select(column_of(*[F.col(n) for n in names]).alias("v")).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("  test  string  ", "test string"),
        ("", None),
        (None, None),
        ("   ", None),
        (f"a\t\n b{NBSP}c\x1d", "a b c"),
        (f"{NBSP} ", None),
    ],
)
def test_clean_string(spark, given, expected):
    assert value(spark, text.clean_string, given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [("\t a  b \n", "a  b"), (" ", None), (f"{NBSP}x{NBSP}{NBSP}", "x"), ("", None), (None, None)],
)
def test_strip_text(spark, given, expected):
    assert value(spark, text.strip_text, given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2023-01-15", dt.date(2023, 1, 15)),
        ("01/15/2023", dt.date(2023, 1, 15)),
        ("15/01/2023", dt.date(2023, 1, 15)),
        ("03/04/2023", dt.date(2023, 3, 4)),
        ("2023-1-5", dt.date(2023, 1, 5)),
        (" 2023-01-15 10:11:12 ", dt.date(2023, 1, 15)),
        ("2023-01-15   1:2:3", dt.date(2023, 1, 15)),
        ("01/15/2023 10:11:12", dt.date(2023, 1, 15)),
        ("15/01/2023 10:11:12", None),
        ("2023-01-15 24:00:00", None),
        ("2023-01-15 10:11", None),
        ("2023-01-15T10:11:12", None),
        ("2023-02-30", None),
        ("2024-02-29", dt.date(2024, 2, 29)),
        ("2023-01", None),
        ("2023", None),
        ("0000-01-01", None),
        ("13/13/2023", None),
        ("invalid", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, given, expected):
    assert value(spark, dates.parse_date, given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("New York, NY, USA", ("New York", "NY", "USA")),
        ("London, UK", ("London", "UK", None)),
        ("A", ("A", None, None)),
        ("A, B, C, D", ("A, B, C, D", None, None)),
        ("A,,C", ("A,,C", None, None)),
        ("A, ,C", ("A", None, "C")),
        ("A,", ("A,", None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_split_location(spark, given, expected):
    assert tuple(value(spark, text.split_location, given)) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("ABC Pharma Inc", "ABC Pharma Inc."),
        ("XYZ University", "XYZ University"),
        ("ABC Inc.", "ABC Inc.."),
        ("univ of x med center", "University of x Medical Center"),
        ("Incorporated Co-op HOSP", "Incorporated Co.-op Hospital"),
        ("hospitals_co éco co", "hospitals_co éco Co."),
        ("big CORP llc Ltd", "big Corp. LLC Ltd."),
        ("", None),
        (None, None),
    ],
)
def test_normalize_sponsor_name(spark, given, expected):
    assert value(spark, text.normalize_sponsor_name, given) == expected


def test_hash_key(spark):
    same = value(spark, text.hash_key, "test", "value")
    assert same == value(spark, text.hash_key, "test", "value")
    assert same != value(spark, text.hash_key, "test", "different")
    assert value(spark, text.hash_key, None, None) == "d41d8cd98f00b204e9800998ecf8427e"
    assert value(spark, text.hash_key, "a", None, "b") == value(spark, text.hash_key, "a", "b")


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Breast Cancer", "cancer"),
        ("Type 2 Diabetes", "diabetes"),
        ("Heart Disease", "cardiovascular"),
        ("Unknown Condition", "Other"),
        ("Lung Cancer", "cancer"),
        ("Stroke", "cardiovascular"),
        ("Brain injury", "neurological"),
        ("COPD", "respiratory"),
        ("Bipolar", "mental_health"),
        ("HIV", "infectious"),
        ("Lupus", "autoimmune"),
        ("Neonatal care", "pediatric"),
        ("Imaging Study", "geriatric"),
        ("", "Other"),
        (None, "Unknown"),
    ],
)
def test_categorize_condition(spark, given, expected):
    assert value(spark, cat.categorize_condition, given) == expected


@pytest.mark.parametrize(
    "given, group",
    [
        ("tumor", "Cancer"),
        ("Diabetic heart", "Diabetes"),
        ("cardiac", "Cardiovascular"),
        ("asthma", "Respiratory"),
        ("parkinson", "Neurological"),
        ("anxiety", "Mental Health"),
        ("arthritis", "Autoimmune"),
        ("viral", "Infectious Disease"),
        ("child", "Pediatric"),
        ("aging", "Geriatric"),
        ("Hypertension", "Other"),
        (None, "Other"),
    ],
)
def test_condition_group(spark, given, group):
    assert value(spark, cat.condition_group, given) == group


@pytest.mark.parametrize(
    "country, region, continent",
    [
        ("United States", "North America", "North America"),
        ("Netherlands", "Europe", "Other"),
        ("Singapore", "Asia", "Other"),
        ("Brazil", "Latin America", "South America"),
        ("Colombia", "Latin America", "Other"),
        ("Egypt", "Africa", "Other"),
        ("New Zealand", "Oceania", "Oceania"),
        ("France; Germany", "Europe", "Europe"),
        ("Peru", "Other", "Other"),
        (None, "Unknown", "Unknown"),
    ],
)
def test_regions(spark, country, region, continent):
    assert value(spark, cat.categorize_region, country) == region
    assert value(spark, cat.categorize_continent, country) == continent


@pytest.mark.parametrize(
    "function, given, expected",
    [
        (cat.sponsor_type, "INDUSTRY", "Industry"),
        (cat.sponsor_type, "Academic", "Academic"),
        (cat.sponsor_type, "NIH", "Government"),
        (cat.sponsor_type, "Hospital Network", "Medical Center"),
        (cat.sponsor_type, "x", "Other"),
        (cat.sponsor_type, None, "Unknown"),
        (cat.sponsor_category, "Biotech University", "Pharmaceutical"),
        (cat.sponsor_category, "International Institute", "Academic"),
        (cat.sponsor_category, "Medical Center", "Medical"),
        (cat.sponsor_category, "Federal Office", "Government"),
        (cat.sponsor_category, "x", "Other"),
        (cat.sponsor_country, "Duke", "United Kingdom"),
        (cat.sponsor_country, "Site USA Canada", "United States"),
        (cat.sponsor_country, "x", "Unknown"),
        (cat.sponsor_country, None, "Unknown"),
        (cat.intervention_category, "Device; Drug", "Drug"),
        (cat.intervention_category, "Surgery", "Procedure"),
        (cat.intervention_category, "lifestyle", "Behavioral"),
        (cat.intervention_category, "x", "Other"),
        (cat.intervention_category, None, "Unknown"),
    ],
)
def test_classes(spark, function, given, expected):
    assert value(spark, function, given) == expected


def test_status_flags(spark):
    has = lambda word: lambda c: cat.status_has(c, word)
    assert value(spark, has("recruiting"), "ACTIVE_NOT_RECRUITING") is True
    assert value(spark, has("completed"), "terminated") is False
    assert value(spark, has("completed"), None) is False


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Phase 1", 1),
        ("Phase 2", 2),
        ("Phase 3", 3),
        ("PHASE2; PHASE3", 2),
        ("phase\t12a", 12),
        ("No Phase", None),
        ("phase 99999999999", None),
        (None, None),
    ],
)
def test_phase_number(spark, given, expected):
    assert value(spark, numbers.phase_number, given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("1,200", 1200),
        (" 12 ", 12),
        ("-5", -5),
        ("+7", 7),
        ("1_000", 1000),
        ("12.0", None),
        ("abc", None),
        ("", None),
        ("99999999999", None),
        (None, None),
    ],
)
def test_parse_count(spark, given, expected):
    assert value(spark, numbers.parse_count, given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        (None, "Unknown"),
        (0, "Unknown"),
        (-3, "Unknown"),
        (1, "Small (≤50)"),
        (50, "Small (≤50)"),
        (51, "Medium (51-200)"),
        (200, "Medium (51-200)"),
        (201, "Large (201-1000)"),
        (1000, "Large (201-1000)"),
        (1001, "Very Large (>1000)"),
    ],
)
def test_enrollment_band(spark, given, expected):
    assert value(spark, numbers.categorize_enrollment, given, kind="int") == expected


@pytest.mark.parametrize(
    "n, d, expected", [(6.0, 4.0, 1.5), (1.0, 0.0, 0.0), (1.0, None, 0.0), (None, 2.0, 0.0), (None, None, 0.0)]
)
def test_safe_divide(spark, n, d, expected):
    assert value(spark, numbers.safe_divide, n, d, kind="double") == expected


@pytest.mark.parametrize(
    "given, kind, expected",
    [
        (1234567.0, "comma", "1,234,567.0"),
        (1234.5678, "comma", "1,234.5678"),
        (-0.5, "comma", "-0.5"),
        (1e20, "comma", "1.0E20"),
        (1e21, "comma", "1.0E21"),
        (-1e21, "comma", "-1.0E21"),
        (12.25, "percent", "12.2%"),
        (1234.5, "currency", "$1,234.50"),
        (7.5, "plain", "7.5"),
        (None, "comma", "N/A"),
        (None, "percent", "N/A"),
        (None, "currency", "N/A"),
    ],
)
def test_number_label(spark, given, kind, expected):
    assert value(spark, lambda c: numbers.number_label(c, kind), given, kind="double") == expected


@pytest.mark.parametrize(
    "given, expected",
    [("a.b+c@x-y.org", True), ("a@b", False), ("a@b.c", False), ("@b.org", False), ("a b@c.org", False), (None, False)],
)
def test_valid_email(spark, given, expected):
    assert value(spark, text.valid_email, given) is expected


def test_date_arithmetic(spark):
    days = lambda a, b: dates.duration_days(a, b)
    first, later = dt.date(2023, 1, 1), dt.date(2023, 1, 15)
    assert value(spark, days, first, later, kind="date") == 14
    assert value(spark, days, later, first, kind="date") == -14
    assert value(spark, days, None, later, kind="date") is None
    assert value(spark, dates.date_key, later, kind="date") == 20230115
    assert value(spark, lambda k: dates.key_date(k), 20230115, kind="int") == later
    assert value(spark, lambda y: dates.month_start(y, F.lit(7)), 2023, kind="int") == dt.date(2023, 7, 1)
