"""Shared inputs of the model-side queries: the cleaned, labelled loan table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.cleaning import clean_loans
from ..operators.targets import match_outcomes
from ..sources.loans import loan_table, outcome_table, with_split


def labelled_loans(spark: SparkSession, sf: str) -> DataFrame:
    """Loan view, text columns parsed (D8), label from later outcomes (J1),
    split by quarter."""
    lv = clean_loans(loan_table(spark, sf))
    return with_split(match_outcomes(lv, outcome_table(spark, sf)).drop("censored", "last_outcome_date"))
