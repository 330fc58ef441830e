"""Readers: positional delimited text, term lists, CSV tables with a header.

`read_delimited` reads lines (`spark.read.text`, splittable, one task per
file block) and splits each on the separator with no quoting, as a line
split would; fields are taken by position, so extra fields are ignored and
missing ones are null. Bad-record policy:

  on_bad='drop'  lines with too few fields, or a required field that does
                 not parse as its type, are skipped (`try_cast` + filter);
                 a number is plain decimal (`NaN`, `1e3`, `4d` are none);
  on_bad='null'  unparsable fields become null, the line is kept;
  on_bad='fail'  the first bad line fails the query (ANSI cast /
                 `raise_error`).

A blank line is skipped in every mode, or (`skip_blank=False`) is a line with
too few fields.

Declare a schema: inferring one costs an extra pass over the whole input,
which at scale is a full second scan. `read_csv_table` still offers
inference (optionally on a sample) for exploration.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.scalar import java_trim, parse_double
from quarry.operators.lookup import LINE_ORDER
from quarry.session import scratch_path

FieldSpec = Sequence[tuple[str, str]] | T.StructType


def _fields(schema: FieldSpec) -> list[tuple[str, str]]:
    if isinstance(schema, T.StructType):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return [(n, t) for n, t in schema]


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths: str | Sequence[str], with_order: bool = False) -> DataFrame:
    """(value): the lines of the files. With `with_order` also `line_order`,
    the line's place: number of the path in `paths`, file, start of the block
    in the file, number of the line among those its task reads. A block's lines
    are read in order by one task, so places compare as the lines stand, without
    a pass or a shuffle to number them; places are not consecutive."""
    if not with_order:
        return spark.read.text(_paths(paths))
    parts = []
    for number, path in enumerate(_paths(paths)):
        place = F.struct(
            F.lit(number).alias("input"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
        parts.append(spark.read.text(path).select("value", place.alias(LINE_ORDER)))
    return reduce(DataFrame.unionAll, parts)


def _parse(raw: Column, typ: str, on_bad: str) -> Column:
    if typ == "string":
        return raw
    if typ in ("double", "float"):
        return parse_double(raw, "fail" if on_bad == "fail" else "null").cast(typ)
    return raw.cast(typ) if on_bad == "fail" else raw.try_cast(typ)


def split_fields(
    lines: DataFrame,
    schema: FieldSpec,
    sep: str = ",",
    on_bad: str = "drop",
    trim: bool = True,
    empty_as_null: bool = False,
    required: Sequence[str] | None = None,
    text_col: str = "value",
    with_reason: bool = False,
    max_fields: int = -1,
    skip_blank: bool = True,
) -> DataFrame:
    """Split text lines into typed positional columns (see module notes).

    Columns of `lines` other than the text (a line's place) pass through.
    `skip_blank=False` treats a blank line like any other line: one empty
    field, which `on_bad` then drops, keeps or fails on.
    `max_fields` > 0 splits into at most that many pieces, so the last field
    keeps the rest of the line, separators included (a split with a limit).
    With `with_reason`, no row is dropped: a `reject_reason` column says why
    a line would be (null for good lines)."""
    if on_bad not in ("drop", "null", "fail"):
        raise ValueError("on_bad must be 'drop', 'null' or 'fail'")
    fields = _fields(schema)
    names = [n for n, _ in fields]
    required = list(required) if required is not None else names
    parts = F.split(F.col(text_col), re.escape(sep), max_fields if max_fields > 0 else -1)
    raws, values = {}, {}
    for i, (name, typ) in enumerate(fields):
        raw = F.get(parts, i)
        if trim:
            raw = java_trim(raw)
        if empty_as_null:
            raw = F.when(raw != F.lit(""), raw)
        raws[name] = raw
        values[name] = _parse(raw, typ, on_bad)

    extra = [c for c in lines.columns if c != text_col]
    need = max([names.index(r) for r in required], default=-1) + 1
    short = F.size(parts) < F.lit(need)
    typed_required = [n for n, t in fields if n in required and t != "string"]

    # A blank line holds no record.
    blank = java_trim(F.col(text_col)) == F.lit("")
    if skip_blank:
        lines = lines.filter(~blank)
    else:
        short = short | blank
    if on_bad == "fail":
        # The arity check sits in a filter so column pruning cannot drop it.
        checked = F.when(short, F.raise_error(F.concat(F.lit("too few fields: "), F.col(text_col))))
        return lines.filter(checked.isNull()).select(*[values[n].alias(n) for n in names], *extra)
    if with_reason:
        reason = F.when(short, F.lit("too few fields"))
        for n in typed_required:
            reason = reason.when(values[n].isNull() & raws[n].isNotNull(), F.lit(f"unparsable {n}"))
        parsed = lines.select(
            *[values[n].alias(n) for n in names], *extra, reason.alias("reject_reason"), F.col(text_col).alias("line"),
            F.spark_partition_id().alias("__part"),
        )
        # A filter on the reason added later combines with this one and stays
        # above the projection (see the note below), so the parse runs once.
        return parsed.filter(F.col("__part") >= 0).drop("__part")
    out = lines.select(*[values[n].alias(n) for n in names], *extra)
    if on_bad == "null":
        return out
    # A good line has every required field, and each typed one parsed (or
    # null as written). The flag is computed in the same projection as the
    # values, so the line is split, trimmed and cast once. The filter also
    # reads the (always true) partition-id test: a projection holding a
    # nondeterministic column is not merged into the filter, which would
    # otherwise evaluate the whole parse a second time.
    keep = ~short
    for n in typed_required:
        keep = keep & (values[n].isNotNull() | raws[n].isNull())
    parsed = lines.select(
        *[values[n].alias(n) for n in names], *extra, keep.alias("__keep"), F.spark_partition_id().alias("__part")
    )
    return parsed.filter(F.col("__keep") & (F.col("__part") >= 0)).select(*names, *extra)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: FieldSpec,
    sep: str = ",",
    on_bad: str = "drop",
    trim: bool = True,
    empty_as_null: bool = False,
    required: Sequence[str] | None = None,
    max_fields: int = -1,
    with_order: bool = False,
    skip_blank: bool = True,
) -> DataFrame:
    """Headerless delimited text, several files read as one relation; with
    `with_order` each row carries its line's place (see `read_lines`)."""
    return split_fields(
        read_lines(spark, paths, with_order), schema, sep, on_bad, trim, empty_as_null, required,
        max_fields=max_fields, skip_blank=skip_blank,
    )


def read_delimited_rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: FieldSpec,
    sep: str = ",",
    trim: bool = True,
    required: Sequence[str] | None = None,
) -> DataFrame:
    """The lines `read_delimited(on_bad='drop')` would skip, with the reason."""
    lines = spark.read.text(_paths(paths))
    parsed = split_fields(lines, schema, sep, "null", trim, required=required, with_reason=True)
    return parsed.filter(F.col("reject_reason").isNotNull()).select("line", "reject_reason")


def sort_out(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: FieldSpec,
    sep: str = ",",
    trim: bool = True,
    required: Sequence[str] | None = None,
    max_fields: int = -1,
    skip_blank: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, rejects, counts) of delimited text from one parse of it: the rows
    `read_delimited(on_bad='drop')` gives, the lines it skips with the reason
    (line, reject_reason), and the number of lines per reason (reject_reason,
    n_lines; reasons that occur).

    One job parses the text and writes it partitioned by verdict, so rows and
    rejects are read as folders of their own; the counts are metrics of that
    job, so neither is read to count. The verdict is decided line by line;
    nothing is shuffled."""
    fields = _fields(schema)
    names = [n for n, _ in fields]
    parsed = split_fields(
        read_lines(spark, paths), schema, sep, "null", trim, required=required, with_reason=True,
        max_fields=max_fields, skip_blank=skip_blank,
    )
    bad = F.col("reject_reason").isNotNull()
    parsed = parsed.withColumns(
        {"line": F.when(bad, F.col("line")), "verdict": F.when(bad, F.lit("bad")).otherwise(F.lit("good"))}
    )
    wanted = list(required) if required is not None else names
    reasons = ["too few fields", *[f"unparsable {n}" for n, t in fields if n in wanted and t != "string"]]
    seen = Observation()
    metrics = [F.count_if(F.col("reject_reason") == reason).alias(f"r{i}") for i, reason in enumerate(reasons)]
    path = scratch_path(spark, "sorted-lines")
    parsed.observe(seen, *metrics).write.partitionBy("verdict").parquet(path)
    found = [(reason, seen.get[f"r{i}"]) for i, reason in enumerate(reasons)]
    counts = spark.createDataFrame([x for x in found if x[1]], "reject_reason string, n_lines bigint")
    both = spark.read.schema(parsed.schema).parquet(path)
    rows = both.where(F.col("verdict") == "good").select(*names)
    return rows, both.where(F.col("verdict") == "bad").select("line", "reject_reason"), counts


def read_terms(spark: SparkSession, paths: str | Sequence[str], column: str = "word", trim: bool = False) -> DataFrame:
    """A one-column term list, one term per line (blank lines skipped)."""
    lines = spark.read.text(_paths(paths))
    term = java_trim("value") if trim else F.col("value")
    return lines.select(term.alias(column)).filter(F.col(column) != F.lit(""))


def read_csv_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    schema: T.StructType | str | None = None,
    header: bool = True,
    sampling_ratio: float = 1.0,
    mode: str = "PERMISSIVE",
    infer: bool = True,
) -> DataFrame:
    """CSV with a header line. With `schema` nothing is inferred; without it
    the types are inferred from a `sampling_ratio` share of the rows, or
    (`infer=False`) every column is read as text with no extra pass."""
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    return reader.csv(_paths(paths))
