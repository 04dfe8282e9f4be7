"""Comparison of runs and validation as queries: a report lists what differs or is
wrong, an empty one means that all is well."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..runtime import prepare


def long_form(rows: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, path, value) of every field, values as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("path"), F.col(c).cast("string").alias("value")) for c in fields])
    return rows.select(F.col(key).cast("string").alias("key"), F.inline(pairs))


def differences(left: DataFrame, right: DataFrame, key: str, permitted: Sequence[str], identity: Sequence[str], content: Sequence[str]) -> DataFrame:
    """(key, path, kind, left_value, right_value, verdict) of each field that is
    added, removed or changed. Clock-derived fields are permitted, identity fields
    violate, known fields are content, and everything else violates too."""
    fields = [c for c in left.columns if c != key]
    a = long_form(left, key, fields).withColumnRenamed("value", "left_value").withColumn("in_left", F.lit(True))
    b = long_form(right, key, [c for c in right.columns if c != key]).withColumnRenamed("value", "right_value").withColumn("in_right", F.lit(True))
    both = a.join(b, ["key", "path"], "full_outer").where(~F.col("left_value").eqNullSafe(F.col("right_value")) | F.col("in_left").isNull() | F.col("in_right").isNull())
    kind = F.when(F.col("in_left").isNull(), "added").when(F.col("in_right").isNull(), "removed").otherwise("changed")
    verdict = F.when(F.col("path").isin(*identity), "violation").when(F.col("path").isin(*permitted), "permitted").when(F.col("path").isin(*content), "content").otherwise("violation")
    return both.select("key", "path", kind.alias("kind"), "left_value", "right_value", verdict.alias("verdict"))


def publication_state(left: DataFrame, right: DataFrame, name: str, digest: str) -> DataFrame:
    """(name, state) of each published document: absent on the right, absent on the
    left (new), differs or identical; an empty digest counts as empty."""
    a = left.select(name, F.col(digest).alias("l"))
    b = right.select(name, F.col(digest).alias("r"))
    state = F.when(F.col("r").isNull(), "absent").when(F.col("l").isNull(), "new").when(F.col("r") == "", "empty").when(F.col("l") != F.col("r"), "differs").otherwise("identical")
    return a.join(b, name, "full_outer").select(name, state.alias("state"))


def set_difference(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """(key, finding): what is missing and what is unexpected."""
    e, p = expected.select(key).distinct(), present.select(key).distinct()
    return e.join(p, key, "left_anti").withColumn("finding", F.lit("missing")).unionByName(p.join(e, key, "left_anti").withColumn("finding", F.lit("unexpected")))


def violations(rows: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """(key, rule) for each rule that a row breaks; a rule that is null is broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]))
    return rows.select(key, F.explode(broken).alias("rule"))


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that stand more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def count_findings(declared: DataFrame, rows: DataFrame, key: str, count: str) -> DataFrame:
    """(key, declared, actual) where a stated count differs from the rows beside it."""
    actual = rows.groupBy(key).agg(F.count("*").alias("actual"))
    joined = declared.select(key, F.col(count).alias("declared")).join(actual, key, "full_outer")
    return joined.select(key, "declared", F.coalesce("actual", F.lit(0).cast("long")).alias("actual")).where(~F.col("declared").eqNullSafe(F.col("actual")))


def fields_refused(schema_fields: Sequence[str], required: Sequence[str], allowed: Sequence[str]) -> dict[str, list[str]]:
    """Required fields that are absent, and fields that nobody knows."""
    have = set(schema_fields)
    return {"missing": sorted(set(required) - have), "unknown": sorted(have - set(allowed) - set(required))}


def _walk(value, path: str, out: list) -> None:
    if isinstance(value, dict):
        out.append((path, f"object({len(value)})"))
        for k in sorted(value):
            _walk(value[k], f"{path}.{k}", out)
    elif isinstance(value, list):
        out.append((path, f"array({len(value)})"))
        for n, v in enumerate(value):
            # elements with an identity are compared by it, not by their place
            own = v.get("record_id", v.get("id")) if isinstance(v, dict) else None
            _walk(v, f"{path}[{n if own is None else own}]", out)
    else:
        out.append((path, json.dumps(value, ensure_ascii=False)))


@pandas_udf(ArrayType(StructType([StructField("path", StringType()), StructField("value", StringType())])))
def walked(document: pd.Series) -> pd.Series:
    """Every path of a JSON text with its value; objects and arrays by their size,
    elements that have an identifier by it. Null for what isn't JSON."""

    def one(text):
        try:
            out: list = []
            _walk(json.loads(text), "$", out)
            return [{"path": p, "value": v} for p, v in out]
        except (TypeError, ValueError, RecursionError):
            return None

    return document.map(one)


def document_differences(left: DataFrame, right: DataFrame, name: str, document: str, permitted: str, content: str) -> DataFrame:
    """(name, path, kind, left_value, right_value, verdict) over whole documents of two
    runs. Paths that match ``permitted`` (clocks, identifiers of the run) or
    ``content`` (regular expressions) are told apart; any other difference is a
    violation. A document that only one run has differs at its root."""
    prepare(left.sparkSession)
    flat = lambda d, v: d.select(F.col(name), F.inline(walked(F.col(document)))).withColumnRenamed("value", v).withColumn(f"_{v}", F.lit(True))
    both = flat(left, "left_value").join(flat(right, "right_value"), [name, "path"], "full_outer")
    both = both.where(~F.col("left_value").eqNullSafe(F.col("right_value")))
    kind = F.when(F.col("_left_value").isNull(), "added").when(F.col("_right_value").isNull(), "removed").otherwise("changed")
    verdict = F.when(F.col("path").rlike(permitted), "permitted").when(F.col("path").rlike(content), "content").otherwise("violation")
    return both.select(name, "path", kind.alias("kind"), "left_value", "right_value", verdict.alias("verdict"))
