"""A stored article table that several jobs and a stream write to while others read it.

    <path>/days/version=<name>/scraped_day=<day>/   the rows of a day, never changed once written
    <path>/versions/<number>.json                   which version of each day is the current one

A writer stages whole new days beside the old ones and then publishes the next number, in one step that fails if another
writer was first. So a reader sees a version whole or not at all, and what a failed writer leaves behind is in no version. A
writer that was too late looks only at the days the other one replaced, and tries the next number.

The file system must not replace an existing file when another is renamed to its name; object stores without that need
a table format of their own instead.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masthead.operators.updates import apply_decisions, written
from masthead.schema import ARTICLE_COLUMNS, ARTICLES, DAY_COLUMN, DAY_S, DECISIONS

NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
KEPT = 50  # versions that `expire` leaves
GRACE_S = 86400  # folders younger than this may belong to a writer at work


@dataclass(frozen=True)
class Version:
    """``days``: day -> name of its version. ``applied``: for each source of updates, the number of its last one."""

    number: int = 0
    days: dict[str, str] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)


class TooManyWriters(RuntimeError):
    """Every attempt to publish was overtaken."""


def _files(spark: SparkSession, path: str):
    """The path and its file system, as objects of the JVM."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    folder, files = _files(spark, f"{path}/versions")
    if not files.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def is_store(spark: SparkSession, path: str) -> bool:
    """Was the table at ``path`` made by :func:`create_store`?"""
    return bool(_numbers(spark, path))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """What a version consists of, the current one by default."""
    if number is None:
        known = _numbers(spark, path)
        if not known:
            return Version()
        number = known[-1]
    place, files = _files(spark, f"{path}/versions/{number:020d}.json")
    stream = files.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(number, **json.loads(text))


def _publish(spark: SparkSession, path: str, new: Version) -> bool:
    """Make a version the current one, unless its number is taken."""
    draft, files = _files(spark, f"{path}/versions/.{uuid.uuid4().hex}")
    place, _ = _files(spark, f"{path}/versions/{new.number:020d}.json")
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps({"days": new.days, "applied": new.applied}).encode()))
    finally:
        out.close()
    if files.getScheme() == "file":  # a local rename replaces; a link does not
        try:
            os.link(draft.toUri().getPath(), place.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            files.delete(draft, False)
    if files.rename(draft, place):
        return True
    files.delete(draft, False)
    return False


def _read_days(spark: SparkSession, path: str, days: dict[str, str]) -> DataFrame:
    if not days:
        return spark.createDataFrame([], f"{ARTICLES}, {DAY_COLUMN} int")
    folders = [f"{path}/days/version={name}/{DAY_COLUMN}={day}" for day, name in days.items()]
    rows = spark.read.schema(f"{ARTICLES}, version string, {DAY_COLUMN} int").option("basePath", f"{path}/days")
    return rows.parquet(*folders).drop("version")


def _from(days: dict[str, str], since: int | None) -> dict[str, str]:
    """The days that hold what was scraped from ``since`` on."""
    if since is None:
        return days
    return {day: name for day, name in days.items() if day != NULL_DAY and int(day) >= since // DAY_S}


def read_store(spark: SparkSession, path: str, since: int | None = None, number: int | None = None) -> DataFrame:
    """The article table as of one version, the current one by default. With ``since`` the folders of older days are not even listed.

    The result stays at that version, whatever is published later.
    """
    return _read_days(spark, path, _from(version(spark, path, number).days, since))


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY_COLUMN, F.expr(f"cast(scraped_at div {DAY_S} as int)"))


def _write_days(rows: DataFrame, path: str) -> dict[str, str]:
    """Write whole days as a version of their own; returns the days that have rows."""
    name = uuid.uuid4().hex
    folder = f"{path}/days/version={name}"  # of its own, as writers side by side would clear each other's unfinished files
    rows.hint("rebalance", DAY_COLUMN).write.partitionBy(DAY_COLUMN).parquet(folder)
    days, files = _files(rows.sparkSession, f"{folder}/{DAY_COLUMN}=*")
    return {found.getPath().getName().split("=", 1)[1]: name for found in files.globStatus(days)}


def create_store(articles: DataFrame, path: str) -> None:
    """Store an article table for several writers. ``path`` must not hold one yet."""
    spark = articles.sparkSession
    if is_store(spark, path):
        raise ValueError(f"there is a stored table in {path}")
    _, files = _files(spark, path)
    files.mkdirs(_files(spark, f"{path}/versions")[0])
    days = _write_days(_day(articles.select(*ARTICLE_COLUMNS)), path)
    if not _publish(spark, path, Version(1, days)):
        raise ValueError(f"somebody else has just made a stored table in {path}")


def _changed(
    spark: SparkSession, path: str, base: Version, decisions: DataFrame, since: int | None, arrivals: DataFrame | None, only: set[str] | None
) -> dict[str, str]:
    """Write new versions of the days that decisions or arrivals touch, of ``only`` these if given."""
    own = {d: v for d, v in _from(base.days, since).items() if only is None or d in only}
    rows = _read_days(spark, path, own)
    hit = rows.select("id", DAY_COLUMN).join(written(decisions).select("id"), "id", "left_semi")
    days = {str(r[0]) for r in hit.select(DAY_COLUMN).distinct().collect()}  # at most the days of the window
    if arrivals is not None:
        arrived = _day(arrivals)
        coming = {NULL_DAY if r[0] is None else str(r[0]) for r in arrived.select(DAY_COLUMN).distinct().collect()}
        coming = {d for d in coming if only is None or d in only}
        days |= coming
    if not days:
        return {}
    rows = _read_days(spark, path, {d: v for d, v in base.days.items() if d in days})
    if arrivals is not None:
        dated = F.coalesce(F.col(DAY_COLUMN).cast("string"), F.lit(NULL_DAY)).isin(sorted(coming))
        new = arrived.filter(dated).join(rows.select("id"), "id", "left_anti")
        rows = rows.unionByName(new.select(*rows.columns))
    return _write_days(apply_decisions(rows, decisions), path)


def update_store(
    spark: SparkSession,
    path: str,
    decisions: DataFrame | None = None,
    since: int | None = None,
    arrivals: DataFrame | None = None,
    source: str | None = None,
    batch: int = 0,
    attempts: int = 20,
) -> Version:
    """Write decisions into the stored table, after adding the ``arrivals`` (rows of the article schema) whose id their day does not hold.

    Only days from ``since`` on are searched for decided articles. Of all days, only those that change are read whole and written
    anew, and nothing is seen of it before all of them are complete. With ``source``, updates are
    numbered by ``batch``, and one that is already in the table changes nothing, so a replay is harmless. Both tables
    must be repeatable, as a writer that is overtaken reads them again for the days that have changed meanwhile.
    """
    if decisions is None:
        decisions = spark.createDataFrame([], DECISIONS)
    base, ours, only = version(spark, path), {}, None
    for _ in range(attempts):
        if source is not None and base.applied.get(source, -1) >= batch:
            return base
        ours |= _changed(spark, path, base, decisions, since, arrivals, only)
        applied = base.applied if source is None else base.applied | {source: batch}
        if not ours and applied == base.applied:
            return base
        new = Version(base.number + 1, base.days | ours, applied)
        if _publish(spark, path, new):
            return new
        now = version(spark, path)
        only = {d for d in base.days.keys() | now.days.keys() if base.days.get(d) != now.days.get(d)}
        ours = {d: v for d, v in ours.items() if d not in only}
        base = now
    raise TooManyWriters(f"{attempts} attempts to update {path} were overtaken by other writers")


def expire(spark: SparkSession, path: str, kept: int = KEPT, grace_s: int = GRACE_S) -> int:
    """Delete all but the last ``kept`` versions, and the days that are in none of those and older than ``grace_s``; returns how many
    folders went. To be run now and then, as every update leaves the days it replaced."""
    numbers = _numbers(spark, path)
    used = {(day, name) for n in numbers[-kept:] for day, name in version(spark, path, n).days.items()}
    for n in numbers[:-kept]:
        place, files = _files(spark, f"{path}/versions/{n:020d}.json")
        files.delete(place, False)
    pattern, files = _files(spark, f"{path}/days/version=*/{DAY_COLUMN}=*")
    gone = 0
    for found in files.globStatus(pattern):
        folder = found.getPath()
        key = folder.getName().split("=", 1)[1], folder.getParent().getName().split("=", 1)[1]
        if key not in used and found.getModificationTime() <= (time.time() - grace_s) * 1000:
            files.delete(folder, True)
            gone += 1
    return gone
