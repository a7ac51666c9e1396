"""Category codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "?"
UNKNOWN_CODE = -1

# Census categories, coded 1, 2, 3 ... in this order, and -1 for "?".
CENSUS_CATEGORIES: dict[str, tuple[str, ...]] = {
    "workclass": (
        "Private", "Self-emp-not-inc", "Self-emp-inc", "Federal-gov", "Local-gov", "State-gov",
        "Without-pay", "Never-worked",
    ),
    "education": (
        "Bachelors", "Some-college", "11th", "HS-grad", "Prof-school", "Assoc-acdm", "Assoc-voc",
        "9th", "7th-8th", "12th", "Masters", "1st-4th", "10th", "Doctorate", "5th-6th", "Preschool",
    ),
    "marital_status": (
        "Married-civ-spouse", "Divorced", "Never-married", "Separated", "Widowed",
        "Married-spouse-absent", "Married-AF-spouse",
    ),
    "occupation": (
        "Tech-support", "Craft-repair", "Other-service", "Sales", "Exec-managerial",
        "Prof-specialty", "Handlers-cleaners", "Machine-op-inspct", "Adm-clerical",
        "Farming-fishing", "Transport-moving", "Priv-house-serv", "Protective-serv", "Armed-Forces",
    ),
    "relationship": (
        "Wife", "Own-child", "Husband", "Not-in-family", "Other-relative", "Unmarried",
    ),
    "race": ("White", "Asian-Pac-Islander", "Amer-Indian-Eskimo", "Other", "Black"),
    "sex": ("Female", "Male"),
    "native_country": (
        "United-States", "Cambodia", "England", "Puerto-Rico", "Canada", "Germany",
        "Outlying-US(Guam-USVI-etc)", "India", "Japan", "Greece", "South", "China", "Cuba", "Iran",
        "Honduras", "Philippines", "Italy", "Poland", "Jamaica", "Vietnam", "Mexico", "Portugal",
        "Ireland", "France", "Dominican-Republic", "Laos", "Ecuador", "Taiwan", "Haiti", "Columbia",
        "Hungary", "Guatemala", "Nicaragua", "Scotland", "Thailand", "Yugoslavia", "El-Salvador",
        "Trinadad&Tobago", "Peru", "Hong", "Holand-Netherlands",
    ),
}


def codes_of(categories: Sequence[str]) -> dict[str, int]:
    """Codes 1, 2, 3 ... in the order given, and -1 for an unknown value."""
    return {name: code for code, name in enumerate(categories, 1)} | {UNKNOWN: UNKNOWN_CODE}


def encode(value: Column, codes: Mapping[str, int]) -> Column:
    """The code of a category; null for a category without one."""
    literals = [F.lit(part) for part in chain.from_iterable(codes.items())]
    return F.try_element_at(F.create_map(*literals), value)
