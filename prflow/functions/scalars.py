"""Scalar column expressions shared by the projections. All are built-in
functions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results must carry.
UNKNOWN = "UNKNOWN"
USER = "USER"
NOT_MINIMIZED = "NOT MINIMIZED"
LOADED_SUCCESSFULLY = "LOADED_SUCCESSFULLY"
GIT_RETURNED_LESS = "GIT_RETURNED_LESS"
MERGED = "MERGED"

# Actor types by the upper-cased type name the API reports.
ACTOR_TYPES_BY_TYPENAME = {
    "USER": "USER",
    "BOT": "BOT",
    "MANNEQUIN": "MANNEQUIN",
    "ORGANIZATION": "ORGANIZATION",
    "ENTERPRISEUSERACCOUNT": "ENTERPRISE_USER_ACCOUNT",
}

_OFFSET_WITH_COLON = "yyyy-MM-dd'T'HH:mm:ssXXX"
_OFFSET_WITHOUT_COLON = "yyyy-MM-dd'T'HH:mm:ssXX"


def parse_timestamp(text: Column, strict: bool = False) -> Column:
    """ISO timestamp with an offset and without a fraction.

    Anything else is NULL, or fails the job when ``strict`` is set."""
    colon = F.try_to_timestamp(text, F.lit(_OFFSET_WITH_COLON))
    if strict:
        return F.coalesce(colon, F.to_timestamp(text, _OFFSET_WITHOUT_COLON))
    return F.coalesce(colon, F.try_to_timestamp(text, F.lit(_OFFSET_WITHOUT_COLON)))


def actor(actor_id: Column, author_type: Column) -> Column:
    return F.struct(actor_id.alias("id"), author_type.alias("author_type"))


def unknown_actor(actor_id: Column | None = None) -> Column:
    """The actor that stands for nobody, or for an id or login nobody matched."""
    return actor(F.lit("") if actor_id is None else actor_id, F.lit(UNKNOWN))


def unresolved_actor(login: Column) -> Column:
    """An actor known by login only; a missing login is the nobody actor."""
    return unknown_actor(F.coalesce(login, F.lit("")))


def actor_or_unknown(value: Column) -> Column:
    return F.coalesce(value, unknown_actor())


def actor_type(typename: Column) -> Column:
    """API type name -> actor type; unknown names and NULL -> UNKNOWN."""
    upper = F.upper(typename)
    result = F.lit(UNKNOWN)
    for name, kind in ACTOR_TYPES_BY_TYPENAME.items():
        result = F.when(upper == name, F.lit(kind)).otherwise(result)
    return result


def minimized_status(is_minimized: Column, reason: Column) -> Column:
    """The reason (which may be NULL) when minimized, else the fixed text."""
    return F.when(is_minimized, reason).otherwise(F.lit(NOT_MINIMIZED))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def empty_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def inline_comment(original_position: Column) -> Column:
    return zero_if_null(original_position) != 0


def list_size(items: Column) -> Column:
    """Length of a list; a list that was never loaded counts as empty."""
    return F.coalesce(F.size(items), F.lit(0))


def load_status(expected: Column, actual: Column) -> Column:
    """Any difference, also an excess, has the same label."""
    return F.when(expected == actual, F.lit(LOADED_SUCCESSFULLY)).otherwise(
        F.lit(GIT_RETURNED_LESS)
    )
