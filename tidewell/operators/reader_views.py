"""Dynamic views that ask for the reader when they are queried.

A view stored by ``create_reader_view`` holds no answer to "is the reader a member?", only the
question: an uncorrelated subquery on a membership table for ``session_user()``.  The same stored view
so gives each reader their own columns and rows, and a changed membership acts on the next
query.  Spark runs the subquery once per query, and its one value is a constant in the scan.

Groups may hold groups: ``close_memberships`` adds to every member the groups above their own.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.security import MASK
from tidewell.session import scratch_path

MEMBER, GROUP = "member", "grp"
READER = "session_user()"


def close_memberships(edges: DataFrame) -> DataFrame:
    """``(member, grp)`` for every direct or inherited membership, each once.

    ``edges``: rows ``(member, grp)``, where a member may be a group itself.  Rows with a null say nothing;
    groups that hold each other are members of each other and of themselves.  Rounds follow the
    depth of the nesting, not the number of members: each joins the pairs found last with the edges of groups, and
    hands its pairs on through Parquet.
    """
    spark = edges.sparkSession
    edges = edges.select(MEMBER, GROUP).dropna().distinct()
    above = edges.select(F.col(MEMBER).alias(GROUP), F.col(GROUP).alias("_above"))
    path, round_no = scratch_path(spark, "memberships"), 0
    edges.write.parquet(f"{path}/round=0")
    while True:
        found = spark.read.parquet(path).select(MEMBER, GROUP)
        last = spark.read.parquet(f"{path}/round={round_no}")
        new = (last.join(above, GROUP).select(MEMBER, F.col("_above").alias(GROUP)).distinct()
               .join(found, [MEMBER, GROUP], "left_anti"))
        round_no += 1
        new.write.parquet(f"{path}/round={round_no}")
        if spark.read.parquet(f"{path}/round={round_no}").isEmpty():
            return found


def _quoted(name: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def member_of(group: str, memberships: str, reader: str = READER) -> str:
    """SQL that is true when the reader is in ``group`` by the stored table ``memberships`` as it is at query time."""
    literal = "'" + group.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"EXISTS (SELECT 1 FROM {_quoted(memberships)} WHERE `{GROUP}` = {literal} AND `{MEMBER}` = {reader})"


def create_reader_view(spark: SparkSession, view: str, source: str, memberships: str,
                       masked: Mapping[str, str] | None = None, rows: Sequence[tuple[str, str]] = (), everyone: str = "false",
                       reader: str = READER) -> None:
    """``CREATE OR REPLACE VIEW view`` over the stored table or view ``source``.

    ``masked``: column → group that sees it; others get ``REDACTED`` (the column becomes a string).
    ``rows``: pairs (group, SQL condition): a reader sees a row when they are in a group whose condition
    the row fulfils, or when ``everyone`` (SQL) holds; without pairs every row is seen.  A condition that
    is null hides the row.  Views stack: ``source`` may be such a view.
    """
    masked = dict(masked or {})
    columns = spark.table(source).columns
    unknown = [c for c in masked if c not in columns]
    if unknown:
        raise ValueError(f"{source} has no column {unknown}")
    select = []
    for c in columns:
        q = _quoted_column(c)
        select.append(f"CASE WHEN {member_of(masked[c], memberships, reader)} THEN CAST({q} AS STRING) ELSE '{MASK}' END AS {q}"
                      if c in masked else q)
    where = ""
    if rows:
        seen = [f"({member_of(g, memberships, reader)} AND ({condition}))" for g, condition in rows]
        where = " WHERE " + " OR ".join([*seen, f"({everyone})"])
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(view)} AS SELECT {', '.join(select)} FROM {_quoted(source)}{where}")


@contextmanager
def as_reader(spark: SparkSession, name: str):
    """Within the block ``session_user()`` is ``name`` for queries planned by this thread, as a server sets it
    for the user that a request comes from.  A query must run, or be written, inside the block."""
    user = spark._jvm.org.apache.spark.sql.catalyst.CurrentUserContext.CURRENT_USER()
    before = user.get()
    user.set(name)
    try:
        yield
    finally:
        user.remove() if before is None else user.set(before)


def _quoted_column(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"
