"""Delimited scans that infer types and lose no line: what does not fit goes to a table of rejects.

Types are inferred from a sample, as the narrowest that all but a share of its values fit. One pass over all lines then counts
what fails, and a column of which more than that share fails is widened: whole numbers to fractions, dates to times, everything to
text. Every line ends up as a typed row or as a reject, with the reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types from narrow to wide; text takes everything.
CHAINS = (("boolean",), ("bigint", "double"), ("date", "timestamp"))
_PLACE = {kind: (i, j) for i, chain in enumerate(CHAINS) for j, kind in enumerate(chain)}


@dataclass(frozen=True)
class Checked:
    """Typed rows, rejected lines (``line, reason``) and the type of each column."""

    rows: DataFrame
    rejects: DataFrame
    types: dict[str, str]


def wider(a: str, b: str) -> str:
    """The narrowest type that takes the values of both."""
    if a == b:
        return a
    if "string" in (a, b) or _PLACE[a][0] != _PLACE[b][0]:
        return "string"
    return max(a, b, key=lambda kind: _PLACE[kind][1])


def fails(column: str, kind: str) -> Column:
    """Whether a value is there and does not fit."""
    if kind == "string":
        return F.lit(False)
    value = F.col(f"`{column}`")
    wrong = value.try_cast(kind).isNull()
    # casts are more generous than a scan should be: a digit or a letter is no truth value, and a time is more than a date
    if kind == "boolean":
        wrong = ~F.lower(value).isin("true", "false")
    elif kind == "date":
        wrong = wrong | value.contains(":")
    return value.isNotNull() & wrong


def _failures(strings: DataFrame, kinds: Mapping[str, Sequence[str]]) -> tuple[dict[str, dict[str, int]], dict[str, int]]:
    """How many values of each column fail each type, and how many there are, in one pass: one row."""
    wanted = [(c, kind) for c, options in kinds.items() for kind in options]
    counts = [F.count_if(fails(c, kind)).alias(f"f{i}") for i, (c, kind) in enumerate(wanted)]
    present = [F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(kinds)]
    row = strings.agg(F.count("*").alias("lines"), *counts, *present).first()
    out: dict[str, dict[str, int]] = {c: {"string": 0} for c in kinds}
    for i, (c, kind) in enumerate(wanted):
        out[c][kind] = row[f"f{i}"]
    return out, {c: row[f"n{i}"] for i, c in enumerate(kinds)}


def narrowest(failed: Mapping[str, int], n: int, tolerance: float, options: Sequence[str]) -> str:
    """The first of the options, text last, that at most the tolerated share of ``n`` values fails."""
    return next((kind for kind in options if n and failed[kind] <= tolerance * n), "string")


def read_checked(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    sep: str = ",",
    null_value: str = "",
    sample: float = 0.1,
    least: int = 1000,
    tolerance: float = 0.05,
    types: Mapping[str, str] | None = None,
) -> Checked:
    """Read delimited text with a header in every file.

    ``columns`` names the fields where files' headers differ; ``types`` fixes the type of some. A table of under ``least`` sampled
    lines is inferred from all its lines. A column without values is text. A line with too few or too many fields is a reject, and so is one with a
    value that its column's type does not take.
    """
    # the parser must see all fields of a line to know whether it has them all, whatever columns are asked for
    options = {"sep": sep, "header": True, "nullValue": null_value, "mode": "PERMISSIVE", "columnPruning": False}
    names = list(columns) if columns else spark.read.options(**options).csv(path).columns
    (bad,) = [n for n in ("_corrupt_record", "_corrupt_record_") if n not in names][:1]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, bad)])
    strings = spark.read.options(**options, columnNameOfCorruptRecord=bad).schema(schema).csv(path)
    # null beside the line itself; the reader refuses queries of that column alone
    broken = F.coalesce(F.col(bad), F.nullif(F.col(f"`{names[0]}`"), F.col(f"`{names[0]}`")))
    whole = strings.filter(broken.isNull())

    given = dict(types or {})
    open_ = [n for n in names if n not in given]
    every = {c: [kind for chain in CHAINS for kind in chain] for c in open_}
    found: dict[str, str] = {}
    if open_:
        drawn = whole.sample(sample, seed=17) if sample < 1 else whole
        failed, present = _failures(drawn, every)
        if sample < 1 and max(present.values()) < least:
            failed, present = _failures(whole, every)
        found = {c: narrowest(failed[c], present[c], tolerance, every[c]) for c in open_}
        # all lines: widen what the sample did not show
        chains = {c: CHAINS[_PLACE[k][0]][_PLACE[k][1] :] for c, k in found.items() if k != "string"}
        if chains:
            failed, present = _failures(whole, chains)
            found |= {c: wider(found[c], narrowest(failed[c], present[c], tolerance, chain)) for c, chain in chains.items()}
    kinds = {n: given.get(n) or found[n] for n in names}

    wrong = F.array_compact(F.array(*[F.when(fails(n, kind), F.lit(f"{n} is no {kind}")) for n, kind in kinds.items()]))
    judged = strings.withColumn("_reason", F.when(broken.isNotNull(), F.lit("number of fields")).otherwise(F.nullif(F.array_join(wrong, ", "), F.lit(""))))
    rows = judged.filter(F.col("_reason").isNull()).select(*[F.col(f"`{n}`").try_cast(kind).alias(n) for n, kind in kinds.items()])
    line = F.coalesce(broken, F.concat_ws(sep, *[F.coalesce(F.col(f"`{n}`"), F.lit(null_value)) for n in names]))
    return Checked(rows, judged.filter(F.col("_reason").isNotNull()).select(line.alias("line"), F.col("_reason").alias("reason")), kinds)
