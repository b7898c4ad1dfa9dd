"""Text functions of the feeds and of the polygon requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from incident_engine.functions.columns import ColumnLike, as_column


def strip_float_suffix(c: ColumnLike) -> Column:
    """``'12.0'`` to ``'12'``: ids that were once rendered from a float."""
    text = as_column(c).cast("string")
    suffix = F.lit(".0")
    bare = F.left(text, F.length(text) - F.length(suffix))
    return F.when(F.endswith(text, suffix), bare).otherwise(text)


def to_double(c: ColumnLike) -> Column:
    return as_column(c).try_cast("double")


def request_path(force: ColumnLike, neighbourhood: ColumnLike) -> Column:
    name = F.replace(as_column(neighbourhood), F.lit(" "), F.lit("%20"))
    return F.concat_ws("/", F.lit(""), as_column(force), name, F.lit("boundary"))


def request_body(poly: ColumnLike, month: ColumnLike) -> Column:
    """Form-encoded request for the incidents inside a polygon in a month."""
    return F.concat(
        F.lit("poly="), F.url_encode(as_column(poly)),
        F.lit("&date="), F.url_encode(as_column(month)),
    )


def polygon_text(points: ColumnLike) -> Column:
    """``lat,lng:lat,lng:...`` with the first point repeated at the end.

    ``points`` is an array of structs with ``latitude`` and ``longitude`` text,
    in ring order. An empty array gives empty text.
    """
    pairs = F.transform(
        as_column(points), lambda p: F.concat_ws(",", p["latitude"], p["longitude"])
    )
    return F.concat_ws(":", F.concat(pairs, F.slice(pairs, 1, 1)))
