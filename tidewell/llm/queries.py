"""Queries of the text problems p8 to p10. None is expressible in SQL; the tests
hold them against brute-force versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import leakage, mixing, stuffing
from tidewell.sources.tables import table


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents", ["doc_id", "text"]), table(spark, d, "eval_item", ["item_id", "passage"]))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """The quotations."""
    return _leaks(spark, d).filter(F.col("kind") == leakage.VERBATIM).select("item_id", "doc_id")


def p8_leaks_by_kind(spark: SparkSession, d: str) -> DataFrame:
    """Quotations and re-parameterised copies."""
    return _leaks(spark, d)


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(table(spark, d, "documents", ["doc_id", "source", "text"]), table(spark, d, "mix_target"))


def p9_training_set(spark: SparkSession, d: str) -> DataFrame:
    """The set: the whole document each time it is used."""
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares actually reached."""
    return _mix(spark, d)[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.find_stuffed(table(spark, d, "documents", ["doc_id", "text", "lang"]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p8_found": p8_found,
    "p8_leaks_by_kind": p8_leaks_by_kind,
    "p9_training_set": p9_training_set,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
}
ORACLES: dict[str, str] = {}
