"""Data-quality rules: each returns the failing rows or a verdict row."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.functions import parsing as P
from marketmill.schemas import FETCH_STATUSES, MARKET_A, MARKET_B

# Rules for a landed day file.
MIN_TABLES = 9
MIN_ROWS = 1105
MAX_ATTEMPTS = 3
EMPTY_CONFIRMATIONS = 2
WARN_HOURS, ERROR_HOURS = 30, 48


# -- conditions a row fails ------------------------------------------------

def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: list[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(values)


def out_of_range(column: str, low=None, high=None, inclusive: bool = True, where: Column | None = None) -> Column:
    """Outside the bounds; nulls pass, rows outside `where` are not looked at."""
    value = F.col(column)
    broken = []
    if low is not None:
        broken.append(value < low if inclusive else value <= low)
    if high is not None:
        broken.append(value > high if inclusive else value >= high)
    failed = reduce(lambda a, b: a | b, broken)
    return failed & where if where is not None else failed


def _officially_traded() -> Column:
    """Not an adjusted history row: those have no trade value on the second market."""
    by_value = (F.col("market") == MARKET_B) & F.col("trade_value").isNotNull()
    return (F.col("market") == MARKET_A) | by_value


def high_not_highest() -> Column:
    high = F.col("high_price")
    return _officially_traded() & (
        (high < F.col("open_price")) | (high < F.col("low_price")) | (high < F.col("close_price"))
    )


def low_not_lowest() -> Column:
    low = F.col("low_price")
    return _officially_traded() & (
        (low > F.col("open_price")) | (low > F.col("high_price")) | (low > F.col("close_price"))
    )


def in_future(column: str, today: date) -> Column:
    return F.col(column) > F.lit(today)


def is_mixed_method() -> Column:
    return F.col("weighting_method") == "mixed"


def failing(rows: DataFrame, condition: Column) -> DataFrame:
    return rows.where(condition)


# -- keys ------------------------------------------------------------------

def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count; null keys are ignored."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counted = rows.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") > 1)


def duplicate_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """All rows behind repeated keys, each with its key's count."""
    return rows.join(repeated_keys(rows, *keys), list(keys))


# -- one-pass verdicts -----------------------------------------------------

@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    condition: Column


def verdicts(table: str, rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Failing-row count of every rule, all counted in a single scan."""
    counts = rows.agg(*[F.count_if(r.condition).alias(f"r{i}") for i, r in enumerate(rules)])
    listed = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"),
                 F.col(f"r{i}").alias("failing_rows"))
        for i, r in enumerate(rules)
    ])
    return counts.select(F.inline(listed)).withColumn("passed", F.col("failing_rows") == 0)


def key_verdict(table: str, rows: DataFrame, *keys: str) -> DataFrame:
    found = repeated_keys(rows, *keys).agg(F.count(F.lit(1)).alias("failing_rows"))
    return found.select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("rule"), F.lit(",".join(keys)).alias("column_name"),
        "failing_rows", (F.col("failing_rows") == 0).alias("passed"),
    )


def freshness(loads: DataFrame, anchor: datetime, sources: list[str] | None = None) -> DataFrame:
    """Age in hours of the newest load of each source: pass, warn or error.

    Sources that are expected count also where nothing is known of them: what
    was never loaded, or has no load time, is an error.
    """
    now = F.lit(str(anchor)).cast(loads.schema["loaded_at"].dataType).cast("timestamp")
    if sources:
        expected = F.explode(F.array(*[F.lit(s) for s in sources])).alias("source")
        names = loads.sparkSession.range(1).select(expected, F.lit(None).cast(loads.schema["loaded_at"].dataType).alias("loaded_at"))
        loads = loads.select("source", "loaded_at").unionByName(names)
    newest = loads.groupBy("source").agg(F.max("loaded_at").alias("last_loaded"))
    hours = (F.unix_micros(now) - F.unix_micros(F.col("last_loaded").cast("timestamp"))) / 3.6e9
    return newest.select(
        "source", "last_loaded", hours.alias("age_hours"),
        F.when(hours.isNull() | (hours > ERROR_HOURS), "error").when(hours > WARN_HOURS, "warn").otherwise("pass").alias("state"),
    )


# -- landed payloads -------------------------------------------------------

def field_contract(payloads: DataFrame, expected: list[str]) -> DataFrame:
    """Whether each payload's header is the expected one, in order, and how it differs."""
    wanted = F.array(*[F.lit(f) for f in expected])
    return payloads.select(
        "*",
        F.coalesce(F.col("fields") == wanted, F.lit(False)).alias("fields_match"),
        F.concat_ws(",", F.array_except(wanted, F.coalesce("fields", F.array().cast("array<string>")))).alias("missing_fields"),
        F.concat_ws(",", F.array_except(F.col("fields"), wanted)).alias("extra_fields"),
    )


def payload_contract(payloads: DataFrame, column: str, key: str, sub_keys: list[str]) -> DataFrame:
    """Whether a JSON payload has the required block and the keys inside it.

    Presence counts, not value: a key set to null is there.
    """
    block = F.get_json_object(column, f"$.{key}")
    present = F.coalesce(F.json_object_keys(block), F.array().cast("array<string>"))
    has_block = F.array_contains(F.coalesce(F.json_object_keys(F.col(column)), F.array().cast("array<string>")), key)
    lacking = F.array_except(F.array(*[F.lit(k) for k in sub_keys]), present)
    return payloads.select(
        "*",
        has_block.alias("has_block"),
        F.concat_ws(",", lacking).alias("missing_keys"),
        (has_block & (F.size(lacking) == 0)).alias("contract_ok"),
    )


def landing_status(attempts: DataFrame, confirm_empty: bool, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Verdict on every requested day from its numbered fetch attempts.

    Attempts (dt, attempt, http_ok, retryable, stat, n_tables, n_rows) are read
    in order until one decides. A not-OK answer fails at once for the current
    day; for past days the second one confirms that there is no data. A day runs
    out of tries after `max_attempts` (a bit set's 62 at most): later attempts
    decide nothing, and a day without a decision by then is an unknown failure.
    First decision and second empty answer both come from mergeable numeric
    aggregates (a minimum and a bit set), so no day's attempts are gathered or
    sorted.
    """
    success, no_data, unknown = FETCH_STATUSES
    empty = F.col("http_ok") & (F.coalesce("stat", F.lit("")) != "OK")
    decided_unknown = ~F.col("http_ok") & ~F.col("retryable")
    answered = F.col("http_ok") & ~empty
    short = (F.col("n_tables") < MIN_TABLES) | (F.col("n_rows") < MIN_ROWS)
    # Even code: failure, odd code: success, so that one minimum finds the first decision.
    code = F.when(decided_unknown | (answered & short), F.col("attempt") * 2).when(answered, F.col("attempt") * 2 + 1)
    if not confirm_empty:
        code = F.when(empty, F.col("attempt") * 2).otherwise(code)
    in_time = F.col("attempt").between(1, max_attempts)
    per_day = attempts.groupBy("dt").agg(
        F.min(F.when(in_time, code)).alias("first_code"),
        F.bit_or(F.when(in_time & empty, F.expr("shiftleft(1L, cast(attempt as int))"))).alias("empties"),
    )
    rest = F.col("empties").bitwiseAND(F.col("empties") - 1)
    second_empty = F.when(rest > 0, F.log2(rest.bitwiseAND(-rest)).cast("bigint"))
    decided_at = F.floor(F.col("first_code") / 2)
    confirmed = second_empty.isNotNull() & (decided_at.isNull() | (second_empty < decided_at))
    status = F.when((F.col("first_code") % 2) == 1, success).otherwise(unknown)
    if confirm_empty:
        status = F.when(confirmed, no_data).otherwise(status)
    return per_day.select("dt", status.alias("status"))


def landing_status_of_answer(answers: DataFrame) -> DataFrame:
    """Verdict on single answers of the exchange that states a closed day by sending no tables."""
    success, no_data, unknown = FETCH_STATUSES
    status = F.when(~F.col("http_ok"), unknown).when(F.col("n_tables") == 0, no_data).otherwise(success)
    return answers.withColumn("status", status)


# -- audits ----------------------------------------------------------------

def unparseable_values(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct texts per column that do not parse as a number, with counts; one pass over all columns."""
    long = rows.unpivot([], columns, "column_name", "value")
    rejected = long.where(F.col("value").isNotNull() & P.numeric(F.col("value"), "double").isNull())
    return rejected.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def average_without_close(quotes: DataFrame) -> DataFrame:
    return quotes.where(F.col("close_price").isNull() & F.col("average_price").isNotNull())


def nan_residue(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in all, and rows where any price is still NaN."""
    any_nan = reduce(lambda a, b: a | b, [F.coalesce(F.isnan(c), F.lit(False)) for c in columns])
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(any_nan).alias("nan_rows"))
