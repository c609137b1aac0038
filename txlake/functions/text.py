"""Masking and rendering of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a card number or an e-mail address.
CARD_PATTERN = r"([0-9]{4})[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?([0-9]{4})"
EMAIL_PATTERN = r"[A-Za-z0-9._+-]+@([A-Za-z0-9-]+[.][A-Za-z0-9.-]*[A-Za-z0-9])"


def mask_cards(c: Column) -> Column:
    """Keep the first and last four digits of every card number."""
    return F.regexp_replace(c, CARD_PATTERN, "$1-****-****-$2")


def mask_emails(c: Column) -> Column:
    """Hide the local part of every address, keep the domain."""
    return F.regexp_replace(c, EMAIL_PATTERN, "***@$1")


def whole(c: Column) -> Column:
    """Amount without fraction digits, as text."""
    return F.format_string("%.0f", c.cast("double"))


def json_value(*cols: Column | str) -> Column:
    """One JSON document out of the given columns; nulls are kept as nulls."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def mapping(pairs: dict, key: Column, default=None) -> Column:
    """Look a key up in a small fixed table held as a literal map.

    No join: the table is a parameter of the job and travels inside the plan.
    """
    entries = [F.lit(x) for pair in pairs.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def labels(conditions: dict[str, Column]) -> Column:
    """Array of the labels whose condition holds, in the given order.

    Built by joining and splitting text, which stays inside generated code;
    removing nulls from an array does not.
    """
    if any("," in name for name in conditions):
        raise ValueError("labels must not contain commas")
    nothing = F.array().cast("array<string>")
    if not conditions:
        return nothing
    joined = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in conditions.items()])
    return F.when(joined == "", nothing).otherwise(F.split(joined, ","))
