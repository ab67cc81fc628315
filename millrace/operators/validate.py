"""Typing, business rules and reject classes.

A row is judged once and comes out with its 14 typed fields plus four ``reject_*``
columns, which are null when the row is good. The same judge serves CSV rows and
decoded messages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import StrictValidationError
from millrace.functions.coerce import coerce
from millrace.schemas import FIELDS, HEADERS, REJECT_COLUMNS, SALES_COLUMNS

MISSING_COLUMN = "MISSING_COLUMN"
MISSING_FIELD = "MISSING_FIELD"
INVALID_DATE = "INVALID_DATE"
SCHEMA_RULE = "SCHEMA_RULE"
BAD_TYPE = "BAD_TYPE"
MALFORMED_JSON = "MALFORMED_JSON"
UNREADABLE_ARCHIVE = "UNREADABLE_ARCHIVE"
SKIPPED_MEMBER = "SKIPPED_MEMBER"

# The classes on which a strict run stops instead of setting the row aside.
HALTING = (BAD_TYPE, SCHEMA_RULE, MALFORMED_JSON)

# Set by readers that saw the header: the first of the 14 names it lacks.
MISSING = "missing_column"

_ABSENT = "_absent"


def _verdict(cls: str, field: Column | str, value: Column, reason: Column | str) -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(
        F.lit(cls).alias("reject_class"),
        as_column(field).alias("reject_field"),
        value.cast("string").alias("reject_value"),
        as_column(reason).alias("reject_reason"),
    )


def _text(name: str) -> str:
    return f"_text_{name}"


# The reasons of the common rules read as consumers of the quarantine know them.
DATE_REASON = "expected format MM/DD/YYYY or YYYY-MM-DD, got '%s'"
ORDER_REASON = "ship_date %s is before order_date %s"
COLUMN_REASON = "required column missing from CSV row"


def _date_verdict(name: str) -> tuple[Column, Column]:
    text = F.col(_text(name))
    shown = F.coalesce(text, F.lit("None"))
    reason = F.format_string(DATE_REASON, shown)
    failed = F.col(name).isNull() & ~F.array_contains(_ABSENT, name)
    return failed, _verdict(INVALID_DATE, name, shown, reason)


def _type_verdict(name: str, dtype: T.DataType) -> tuple[Column, Column]:
    text = F.col(_text(name))
    absent = F.array_contains(_ABSENT, name)
    return F.col(name).isNull(), F.when(
        absent, _verdict(MISSING_FIELD, name, F.lit(None), "field required")
    ).otherwise(_verdict(BAD_TYPE, name, text, f"not a valid {dtype.simpleString()}"))


def judge(
    rows: DataFrame,
    text: dict[str, Column],
    keep: list[Column],
    *,
    first: list[tuple[Column, Column]] = (),
    absent: Column | None = None,
) -> DataFrame:
    """Type the 14 fields of ``text`` and attach the first rule each row breaks.

    Rules in order: ``first`` (whatever the entry point checks before the record),
    order_date, ship_date, ship before order, then types in model order.
    ``absent`` names the fields a message does not carry at all, which is a type
    error like any other, while an unreadable date is found earlier.
    """
    drafted = rows.select(
        *keep,
        *[text[f.name].alias(_text(f.name)) for f in FIELDS],
        (absent if absent is not None else F.array().cast("array<string>")).alias(_ABSENT),
        *[coerce(text[f.name], f.type).alias(f.name) for f in FIELDS],
    )
    order, ship = F.col("order_date"), F.col("ship_date")
    rules = [
        *first,
        _date_verdict("order_date"),
        _date_verdict("ship_date"),
        (
            ship < order,
            _verdict(
                SCHEMA_RULE,
                "ship_date",
                ship,
                F.format_string(
                    ORDER_REASON,
                    ship.cast("string"),
                    order.cast("string"),
                ),
            ),
        ),
        *[_type_verdict(f.name, f.type) for f in FIELDS],
    ]
    chain = reduce(lambda acc, rule: acc.when(*rule), rules[1:], F.when(*rules[0]))
    working = {_ABSENT, *[_text(f.name) for f in FIELDS]}
    kept = [c for c in drafted.columns if c not in working]
    # Exploding the one verdict keeps a later filter on it above this point. Pushed
    # below, it would type every field a second time.
    return drafted.select(*kept, F.explode(F.array(chain)).alias("_verdict")).select(
        *kept, *[F.col(f"_verdict.{c}").alias(c) for c in REJECT_COLUMNS]
    )


def judge_landing(raw: DataFrame, *, keep: list[str] = ()) -> DataFrame:
    """Judge CSV rows: 14 text columns under their header names.

    The CSV reader gives null for an empty field where text is allowed to be empty,
    so the five text fields read null as ''. Rows of a file whose header lacks a
    name are rejected whole.
    """
    lacking = [h for h in HEADERS if h not in raw.columns]
    text = {}
    for f in FIELDS:
        column = F.lit(None).cast("string") if f.header in lacking else F.col(f"`{f.header}`")
        text[f.name] = (
            F.coalesce(column, F.lit("")) if isinstance(f.type, T.StringType) else column
        )
    missing = F.lit(lacking[0] if lacking else None).cast("string")
    if MISSING in raw.columns:
        missing = F.coalesce(F.col(MISSING), missing)
    judged = judge(
        raw,
        text,
        [*[F.col(c) for c in keep], missing.alias(MISSING)],
        first=[
            (
                F.col(MISSING).isNotNull(),
                _verdict(
                    MISSING_COLUMN,
                    F.col(MISSING),
                    F.lit(None),
                    COLUMN_REASON,
                ),
            )
        ],
    )
    return judged.drop(MISSING)


def valid(judged: DataFrame) -> DataFrame:
    """The good rows, without the reject columns."""
    return judged.where(F.col("reject_class").isNull()).drop(*REJECT_COLUMNS)


def rejected(judged: DataFrame) -> DataFrame:
    """The set-aside rows: whatever came along, and why."""
    carried = [c for c in judged.columns if c not in SALES_COLUMNS]
    return judged.where(F.col("reject_class").isNotNull()).select(*carried)


def unreadable(members: DataFrame) -> DataFrame:
    """Reject rows for archives or members that could not be unpacked, and for members
    that are not data files."""
    broken = F.col("error").isNotNull()
    return members.where(broken | F.col("file").isNull()).select(
        "archive",
        "member",
        F.when(broken, UNREADABLE_ARCHIVE).otherwise(SKIPPED_MEMBER).alias("reject_class"),
        F.when(F.col("member").isNull(), "archive").otherwise("member").alias("reject_field"),
        F.coalesce("member", "archive").alias("reject_value"),
        F.coalesce("error", F.lit("not a data file")).alias("reject_reason"),
    )


def count_classes(judged: DataFrame) -> DataFrame:
    """Rows per reject class."""
    return (
        judged.where(F.col("reject_class").isNotNull())
        .groupBy("reject_class")
        .agg(F.count("*").alias("row_count"))
    )


def run_counters(judged: DataFrame) -> DataFrame:
    """One row: how many rows passed and how many were set aside."""
    return judged.agg(
        F.count_if(F.col("reject_class").isNull()).alias("sent"),
        F.count_if(F.col("reject_class").isNotNull()).alias("skipped"),
    )


def require_strict(judged: DataFrame) -> None:
    """Raise when a halting class is present. At most one count per class returns."""
    found = count_classes(judged.where(F.col("reject_class").isin(*HALTING))).collect()
    if found:
        raise StrictValidationError({r.reject_class: r.row_count for r in found})
