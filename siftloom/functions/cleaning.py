"""Cleaning of scalar values as column expressions; unknown is null everywhere."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def known(x: Column) -> Column:
    """Trimmed; blank and ``unknown`` (any case) are null."""
    y = F.trim(x)
    return F.when((y != "") & (F.lower(y) != "unknown"), y)


def collapsed(x: Column) -> Column:
    """White space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def ascii_key(x: Column) -> Column:
    """Name key: only ASCII letters are lowered, white space is collapsed. The one
    rule for names: full-Unicode lowering would give other keys to names like ``ÉCOLE``."""
    return collapsed(F.translate(x, _UPPER, _UPPER.lower()))


#: Forms with a zone, and forms without one, which are UTC whatever the session's zone is.
_ZONED = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z")
_PLAIN = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "MMMM d, yyyy", "d MMMM yyyy")


def utc_time(x: Column) -> Column:
    """Timestamp of RFC 822, ISO 8601 and a few plain forms; without a zone it is
    UTC; null where none fits."""
    y = F.regexp_replace(F.trim(x), r"^[A-Za-z]{3,9},\s*", "")
    zoned = [F.try_to_timestamp(y, F.lit(f)) for f in _ZONED]
    return F.coalesce(*zoned, *[F.try_to_timestamp(F.concat(y, F.lit(" Z")), F.lit(f"{f} XXX")) for f in _PLAIN])


def clock_time(x: Column) -> Column:
    """Timestamp of ``YYYY-MM-DDTHH:MM:SSZ`` and nothing else."""
    return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), F.try_to_timestamp(x, F.lit(_ZONED[0])))


def utc_text(t: Column) -> Column:
    """ISO 8601 with seconds and ``Z``, whatever the session's zone is."""
    return F.date_format(F.to_utc_timestamp(t, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def listed(x: Column, sep: str = ",") -> Column:
    """Trimmed pieces in order, without empty ones."""
    return F.filter(F.transform(F.split(x, sep), lambda p: F.trim(p)), lambda p: p != "")


def listed_problem(x: Column, sep: str = ",") -> Column:
    """Why a list of names is refused: ``empty_selection``, ``empty_name`` between
    separators, or ``repeated_name``; null for a list that is taken (an absent list
    is no filter)."""
    parts = F.transform(F.split(x, sep), lambda p: F.trim(p))
    return F.when(F.trim(x) == "", "empty_selection").when(F.exists(parts, lambda p: p == ""), "empty_name").when(F.size(F.array_distinct(parts)) < F.size(parts), "repeated_name")


def labelled(*parts: tuple[str, Column]) -> Column:
    """``Label: value | Label: value`` of the parts that aren't blank."""
    return F.concat_ws(" | ", *[F.when(F.trim(c) != "", F.concat(F.lit(f"{n}: "), F.trim(c))) for n, c in parts])


def quote(text: Column, at: Column, length: Column, width: int = 120) -> Column:
    """``width`` characters of ``text`` around a match at 1-based ``at``."""
    lead = F.greatest(F.floor((F.lit(width) - length) / 2), F.lit(0))
    return F.substring(text, F.greatest(at - lead, F.lit(1)).cast("int"), F.lit(width))


@pandas_udf(StringType())
def folded(x: pd.Series) -> pd.Series:
    """NFKC, collapsed, case-folded: key of legacy values."""
    return x.map(lambda v: None if v is None else " ".join(unicodedata.normalize("NFKC", v).split()).casefold())


@pandas_udf(StringType())
def _without_marks(x: pd.Series) -> pd.Series:
    # Spark has no Unicode normalisation; one Arrow batch at a time
    return x.map(lambda v: None if v is None else "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)))


LONGEST_SLUG = 120


def slug(x: Column, longest: int = LONGEST_SLUG) -> Column:
    """Lower-case ASCII words joined by hyphens; null where nothing is left or it is
    longer than ``longest``: cut short, two names could become one."""
    y = _slugged(x)
    return F.when(F.char_length(y) <= longest, F.nullif(y, F.lit("")))


def slug_problem(x: Column, longest: int = LONGEST_SLUG) -> Column:
    """``empty`` or ``too_long`` where :func:`slug` is null."""
    y = F.coalesce(_slugged(x), F.lit(""))
    return F.when(y == "", "empty").when(F.char_length(y) > longest, "too_long")


def _slugged(x: Column) -> Column:
    y = F.lower(_without_marks(F.replace(x, F.lit("&"), F.lit(" and "))))
    return F.regexp_replace(F.regexp_replace(y, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def domain_slug(host: Column) -> Column:
    """A host as a name for folders and locks."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(host)), "[^a-z0-9.-]+", "_"), "^[._-]+|[._-]+$", "")


def artifact_name(cell: Column, kind: str = "cell") -> Column:
    """Name of a cell's document; null for what isn't a cell."""
    p = cell_parts(cell)
    return F.when(p.isNotNull(), F.concat(F.lit("" if kind == "cell" else f"{kind}-"), cell, F.lit(".json")))


def cell_id(topic: Column, category: Column) -> Column:
    return F.concat_ws("__", topic, category)


def cell_parts(cell: Column) -> Column:
    """(topic, category) struct; null unless there are exactly two parts."""
    p = F.split(cell, "__")
    ok = (F.size(p) == 2) & (p[0] != "") & (p[1] != "")
    return F.when(ok, F.struct(p[0].alias("topic"), p[1].alias("category")))
