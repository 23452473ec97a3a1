"""Files in key=value folders, archives by age, and what is new."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import names
from tablewright.sources.delimited import TEXT_OPTIONS


def write_layout(df: DataFrame, path: str, layers: dict[str, object] | None = None, by: list[str] | None = None,
                 format: str = "csv", if_absent: bool = False, sep: str = ",", skip_empty: bool = True, mode: str = "overwrite") -> bool:
    """Write under k1=v1/k2=v2/, fixed layers first, then columns. True when something was written.

    Only the folders that the rows belong to are replaced, or added to with mode "append"; every other folder below path stays as it is. With
    if_absent, folders that hold files already keep them and get no rows. An empty frame is skipped.

    The check for rows starts the frame's plan; turn skip_empty off where that plan is dear.

    Rows are rebalanced by their folder, so a folder gets few files and a folder with most rows several writers.
    """
    if skip_empty and df.isEmpty():
        return False
    target = "/".join([path.rstrip("/"), *(f"{k}={_folder_text(v)}" for k, v in (layers or {}).items())])
    by = by or []
    rows = df
    if if_absent:
        taken = _taken(df, target, by)
        if taken is not None:
            if not by:
                return False
            rows = df.join(taken, reduce(lambda a, b: a & b, [df[c].cast("string").eqNullSafe(taken[f"__{c}"]) for c in by]), "left_anti")
            if rows.isEmpty():
                return False
    writer = (rows.hint("rebalance", *by) if by else rows).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if format == "csv":
        writer = writer.options(**TEXT_OPTIONS).option("sep", sep)
    (writer.partitionBy(*by) if by else writer).format(format).save(target)
    return True


def _folder_text(value: object) -> str:
    """A layer's value as a folder name, escaped as partition folders are."""
    text = "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else str(value)
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "\"#%'*/:=?\\\x7f{[]^" else c for c in text)


def _taken(df: DataFrame, target: str, by: list[str]) -> DataFrame | None:
    """The folders (values of `by` as text) that hold files below target, or None when there are none."""
    listed = (df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*"))
    try:
        files = listed.load(target).select("path")
        if files.isEmpty():
            return None
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    raw = {c: F.url_decode(F.replace(F.regexp_extract("path", f"/{c}=([^/]*)", 1), F.lit("+"), F.lit("%2B"))) for c in by}
    return files.select(*[F.nullif(raw[c], F.lit("__HIVE_DEFAULT_PARTITION__")).alias(f"__{c}") for c in by]).distinct() if by else files


def age_days(name: Column, as_of: date, modified: Column | None = None) -> Column:
    """Days since the date in the name, or since the modification time when it is given."""
    day = names.name_date(name) if modified is None else F.to_date(modified)
    return F.datediff(F.lit(as_of).cast("date"), day)


def is_old(name: Column, as_of: date, days_old: int = 30, modified: Column | None = None) -> Column:
    return F.coalesce(age_days(name, as_of, modified) > days_old, F.lit(False))


def split_by_age(files: DataFrame, as_of: date, days_old: int = 30, name: str = "name",
                 modified: str | None = None) -> DataFrame:
    """Mark every item keep or archive; archived ones get the month folder they go to."""
    stamp = F.col(modified) if modified else None
    old = is_old(F.col(name), as_of, days_old, stamp)
    month = F.concat(F.lit("date="), names.archive_month(names.save_date(F.col(name))))
    return files.withColumns({
        "action": F.when(old, F.lit("archive")).otherwise(F.lit("keep")),
        "folder": F.when(old, month),
    })


def archive(files: DataFrame, archived: DataFrame, as_of: date, days_old: int = 30, name: str = "name"
            ) -> tuple[DataFrame, DataFrame]:
    """(rows to append to the archive, rows that stay live). Items archived before are not appended again."""
    marked = split_by_age(files, as_of, days_old, name)
    old = marked.where(F.col("action") == "archive").drop("action")
    fresh = old.join(archived.select(name), name, "left_anti")
    return fresh, marked.where(F.col("action") == "keep").drop("action", "folder")


def restore(archived: DataFrame, live: DataFrame, name: str = "name") -> DataFrame:
    """Live items plus the archived .zip and .csv items that are not live. The archive stays as it is."""
    back = archived.where(F.endswith(F.col(name), F.lit(".zip")) | F.endswith(F.col(name), F.lit(".csv")))
    return live.unionByName(back.join(live.select(name), name, "left_anti").select(*live.columns))
