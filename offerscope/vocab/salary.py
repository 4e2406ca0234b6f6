"""Salary wording. Patterns run on normalised text."""

from __future__ import annotations

# Fragments that hold a number which is not an amount.
NOT_AMOUNTS = (
    r"sur \d+(?:[.,]\d+)? ?mois",
    r"\d+(?:[.,]\d+)? ?(?:h|heures?) ?(?:/|par) ?semaine",
)

# Pay period cues, first match wins.
PERIOD_RULES = (
    ("day", r"par jour|/ ?jour|/ ?j\b|\btjm\b|journalier|daily|per day"),
    ("hour", r"horaire|/ ?h\b|de l'heure|par heure|hourly|per hour"),
    ("month", r"mensuel|par mois|/ ?mois|monthly|per month"),
    ("year", r"annuel|/ ?an\b|par an\b|brut/an|\bk ?€|\d ?k\b|yearly|per year|annual"),
)

# Unit words of structured salaries.
UNIT_ALIASES = {
    "year": "year", "annual": "year", "yearly": "year", "month": "month", "monthly": "month",
    "hour": "hour", "hourly": "hour", "day": "day", "daily": "day", "week": "week",
}

# An amount (thousands by blank or dot, decimals by dot or comma) and its optional "k".
AMOUNT = r"(?i)(?<![\d.,])(\d{1,3}(?:[ .]\d{3})+|\d+(?:[.,]\d+)?)(?![\d.,])\s*(k\b)?"
DOTTED_THOUSANDS = r"^\d{1,3}(?:\.\d{3})+$"

# Smallest amount of each period when the text names none (below the last one: hourly).
PERIOD_FLOORS = (("year", 15000.0), ("month", 1000.0), ("day", 150.0))

# How many periods make a year (hours come from the settings).
PERIODS_PER_YEAR = {"year": 1.0, "month": 12.0, "week": 52.0}
