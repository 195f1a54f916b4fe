"""Keyword classifications. Tables are tried top to bottom; the first hit wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trialmart.functions.text import contains_any

# ---- Fixed values: label -> keywords ------------------------------------------------------

CONDITION_KEYWORDS = {
    "cancer": ["cancer", "tumor", "neoplasm", "oncology", "leukemia", "lymphoma"],
    "cardiovascular": ["heart", "cardiac", "cardiovascular", "hypertension", "stroke"],
    "diabetes": ["diabetes", "diabetic", "glucose", "insulin"],
    "respiratory": ["asthma", "copd", "respiratory", "lung", "pulmonary"],
    "neurological": ["alzheimer", "parkinson", "neurological", "brain", "stroke"],
    "mental_health": ["depression", "anxiety", "mental", "psychiatric", "bipolar"],
    "infectious": ["infection", "viral", "bacterial", "hiv", "covid"],
    "autoimmune": ["arthritis", "lupus", "autoimmune", "inflammatory"],
    "pediatric": ["pediatric", "child", "infant", "neonatal"],
    "geriatric": ["elderly", "geriatric", "aging", "senior"],
}

CONDITION_GROUPS = {
    "Cancer": ["cancer", "tumor", "oncology"],
    "Diabetes": ["diabetes", "diabetic"],
    "Cardiovascular": ["heart", "cardiac", "cardiovascular"],
    "Respiratory": ["asthma", "copd", "respiratory"],
    "Neurological": ["alzheimer", "parkinson", "neurological"],
    "Mental Health": ["depression", "anxiety", "mental"],
    "Autoimmune": ["arthritis", "lupus", "autoimmune"],
    "Infectious Disease": ["infection", "viral", "bacterial"],
    "Pediatric": ["pediatric", "child", "infant"],
    "Geriatric": ["elderly", "geriatric", "aging"],
}

REGION_COUNTRIES = {
    "North America": ["united states", "canada", "mexico"],
    "Europe": ["united kingdom", "germany", "france", "italy", "spain", "netherlands"],
    "Asia": ["china", "japan", "india", "south korea", "singapore"],
    "Latin America": ["brazil", "argentina", "chile", "colombia"],
    "Africa": ["south africa", "nigeria", "kenya", "egypt"],
    "Oceania": ["australia", "new zealand"],
}

CONTINENT_COUNTRIES = {
    "North America": ["united states", "canada", "mexico"],
    "Europe": ["united kingdom", "germany", "france", "italy", "spain"],
    "Asia": ["china", "japan", "india", "south korea"],
    "South America": ["brazil", "argentina", "chile"],
    "Africa": ["south africa", "nigeria", "kenya"],
    "Oceania": ["australia", "new zealand"],
}

SPONSOR_TYPES = {
    "Industry": ["industry"],
    "Academic": ["university", "academic"],
    "Government": ["government", "nih"],
    "Medical Center": ["hospital", "medical"],
}

SPONSOR_CATEGORIES = {
    "Pharmaceutical": ["pharma", "biotech", "pharmaceutical"],
    "Academic": ["university", "college", "institute"],
    "Medical": ["hospital", "medical center", "clinic"],
    "Government": ["government", "national", "federal"],
}

SPONSOR_COUNTRIES = {
    "United States": ["usa", "united states"],
    "Canada": ["canada"],
    "United Kingdom": ["uk", "united kingdom"],
    "Germany": ["germany"],
    "France": ["france"],
    "Japan": ["japan"],
    "China": ["china"],
}

INTERVENTION_CATEGORIES = {
    "Drug": ["drug"],
    "Device": ["device"],
    "Procedure": ["procedure", "surgery"],
    "Behavioral": ["behavioral", "lifestyle"],
}

# ---- Fixed values: exact value -> label ---------------------------------------------------

COUNTRY_REGIONS = {
    "North America": ["United States", "Canada", "Mexico"],
    "Europe": ["United Kingdom", "Germany", "France", "Italy", "Spain"],
    "Asia": ["China", "Japan", "India", "South Korea"],
    "South America": ["Brazil", "Argentina", "Chile"],
    "Oceania": ["Australia", "New Zealand"],
    "Africa": ["South Africa", "Nigeria", "Kenya"],
}

COUNTRY_TIMEZONES = {
    "America/New_York": ["United States"],
    "Europe/London": ["United Kingdom"],
    "Europe/Berlin": ["Germany"],
    "Europe/Paris": ["France"],
    "Asia/Shanghai": ["China"],
    "Asia/Tokyo": ["Japan"],
}

CONDITION_TYPES = {
    "Oncological": ["Cancer"],
    "Cardiovascular": ["Cardiovascular"],
    "Metabolic": ["Diabetes"],
    "Pulmonary": ["Respiratory"],
    "Neurological": ["Neurological"],
    "Psychiatric": ["Mental Health"],
    "Immunological": ["Autoimmune"],
    "Infectious": ["Infectious Disease"],
}

CONDITION_PREVALENCE = {
    "High": ["Cancer", "Diabetes", "Cardiovascular"],
    "Medium": ["Mental Health"],
}

RARE_CONDITION_GROUPS = ["Rare Disease", "Orphan Disease"]


def by_keyword(c: Column, table: dict[str, list[str]], missing: str, other: str = "Other") -> Column:
    """Label of the first table row with a keyword inside the text.

    NULL is dealt with after the branches: with the lower-cased text in every branch, Spark
    computes it once per row and not once per keyword.
    """
    rows = iter(table.items())
    name, words = next(rows)
    label = F.when(contains_any(c, words), name)
    for name, words in rows:
        label = label.when(contains_any(c, words), name)
    return F.coalesce(label, F.when(c.isNull(), missing).otherwise(other))


def by_value(c: Column, table: dict[str, list[str]], other: str) -> Column:
    """Label of the table row that lists the exact value."""
    rows = iter(table.items())
    name, values = next(rows)
    label = F.when(c.isin(values), name)
    for name, values in rows:
        label = label.when(c.isin(values), name)
    return label.otherwise(other)


def categorize_condition(c: Column) -> Column:
    return by_keyword(c, CONDITION_KEYWORDS, missing="Unknown")


def condition_group(c: Column) -> Column:
    """Warehouse wording of the condition category."""
    return by_keyword(c, CONDITION_GROUPS, missing="Other")


def categorize_region(c: Column) -> Column:
    return by_keyword(c, REGION_COUNTRIES, missing="Unknown")


def categorize_continent(c: Column) -> Column:
    return by_keyword(c, CONTINENT_COUNTRIES, missing="Unknown")


def sponsor_type(c: Column, missing: str = "Unknown") -> Column:
    return by_keyword(c, SPONSOR_TYPES, missing=missing)


def sponsor_category(c: Column) -> Column:
    return by_keyword(c, SPONSOR_CATEGORIES, missing="Unknown")


def sponsor_country(c: Column) -> Column:
    """Country guessed from words inside a sponsor name."""
    return by_keyword(c, SPONSOR_COUNTRIES, missing="Unknown", other="Unknown")


def intervention_category(c: Column) -> Column:
    return by_keyword(c, INTERVENTION_CATEGORIES, missing="Unknown")


def status_has(c: Column, word: str) -> Column:
    """True when the status holds the word in any case; NULL counts as false."""
    return F.coalesce(F.lower(c).contains(word), F.lit(False))
