"""Writers: delimited text, CSV with header, staged intermediates.

Every writer replaces its target and writes one file per partition in
parallel. `single_file=True` funnels the last stage through one task
(`coalesce(1)`): only for small final reports.

How the target is replaced: `commit='overwrite'` is Spark's own overwrite,
which deletes the old files first; a job that fails half-way leaves nothing.
`commit='rename'` writes beside the target and swaps the folders when the job
has succeeded; until then the old result stays, and it stays after a failure
(see `replace_folder`). That suits file systems with an atomic folder rename
(HDFS, local disks), not plain object stores.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from quarry.session import file_system, scratch_path


def to_lines(
    df: DataFrame, sep: str = ",", columns: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Render rows as positional text lines (null -> empty field); `keep`
    columns pass through unrendered (e.g. for a partitioned write)."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (columns or df.columns)]
    return df.select(F.concat_ws(sep, *fields).alias("value"), *keep)


def format_report(df: DataFrame, key: str, pattern: str, columns: Sequence[str]) -> DataFrame:
    """(key, line) report rows: `line` is `pattern` (printf style: %s, %d,
    %.2f) filled with `columns`; numbers are formatted by the JVM, so %.2f
    rounds half-up like `round(x, 2)`."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.format_string(pattern, *[F.col(c) for c in columns]).alias("line"))


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Run `write(folder)` on a fresh folder beside `path`, then put it in the
    place of `path`.

    The old folder is renamed away and the new one renamed to `path`; only then
    is the old one deleted. If the write fails, `path` is untouched and the
    unfinished folder is removed; the rows may therefore be computed from `path`
    itself. Should the process die between the two renames, `recover_folder`
    brings the old result back."""
    path = path.rstrip("/")
    token = os.urandom(6).hex()
    new, old = f"{path}.new-{token}", f"{path}.old-{token}"
    fs, target = file_system(spark, path)
    fresh, aside = file_system(spark, new)[1], file_system(spark, old)[1]
    try:
        write(new)
    except BaseException:
        fs.delete(fresh, True)
        raise
    had_one = fs.exists(target)
    if had_one and not fs.rename(target, aside):
        fs.delete(fresh, True)
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(fresh, target):
        if had_one:
            fs.rename(aside, target)
        fs.delete(fresh, True)
        raise OSError(f"cannot move the new result to {path}")
    if had_one:
        fs.delete(aside, True)
    return path


def recover_folder(spark: SparkSession, path: str) -> bool:
    """Bring back the result that an interrupted `replace_folder` had moved
    aside, where `path` is gone; unfinished and outdated folders beside it are
    removed. Not to be called while a replacement runs. True if it was
    brought back."""
    path = path.rstrip("/")
    fs, target = file_system(spark, path)
    pattern = lambda kind: file_system(spark, f"{path}.{kind}-*")[1]
    aside = sorted((s.getModificationTime(), s.getPath().toString()) for s in fs.globStatus(pattern("old")) or [])
    brought = False
    if not fs.exists(target) and aside:
        brought = fs.rename(file_system(spark, aside.pop()[1])[1], target)
    leftovers = [x for _, x in aside] + [s.getPath().toString() for s in fs.globStatus(pattern("new")) or []]
    for leftover in leftovers:
        fs.delete(file_system(spark, leftover)[1], True)
    return brought


def _committed(df: DataFrame, path: str, commit: str, write: Callable[[str], None]) -> str:
    if commit == "rename":
        return replace_folder(df.sparkSession, path, write)
    if commit != "overwrite":
        raise ValueError("commit must be 'overwrite' or 'rename'")
    write(path)
    return path


def write_delimited(
    df: DataFrame, path: str, sep: str = "\t", single_file: bool = False, commit: str = "overwrite"
) -> str:
    """Headerless delimited text with no quoting (a line per row)."""
    out = to_lines(df, sep)
    if single_file:
        out = out.coalesce(1)
    return _committed(out, path, commit, lambda folder: out.write.mode("overwrite").text(folder))


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = True,
    single_file: bool = False,
    commit: str = "overwrite",
) -> str:
    """CSV with a header line (quoted where needed)."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").option("header", header).option("sep", sep)
    return _committed(out, path, commit, lambda folder: writer.csv(folder))


def stage(df: DataFrame, path: str, commit: str = "overwrite") -> DataFrame:
    """Materialise an intermediate shared by later jobs as parquet and read
    the whole directory back (every part file, not just the first)."""
    _committed(df, path, commit, lambda folder: df.write.mode("overwrite").parquet(folder))
    return df.sparkSession.read.parquet(path)


def stage_observed(df: DataFrame, metrics: Mapping[str, Column], name: str = "observed") -> tuple[DataFrame, Row]:
    """Write the rows and collect aggregates of them in the same job: the
    written table and one row of the metrics. The aggregates are combined in the
    tasks, so nothing is read a second time; each must be an aggregate
    expression without DISTINCT."""
    seen = Observation()
    path = scratch_path(df.sparkSession, name)
    exprs = [c.alias(n) for n, c in metrics.items()]
    df.observe(seen, *exprs).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), Row(**seen.get)
