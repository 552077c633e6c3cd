"""Stream joins.

* stream–static: the static side is a batch DataFrame; with ``fresh=True`` the
  join runs inside ``foreachBatch`` and the static side is re-read per
  micro-batch, so new static files are seen (a file DataFrame lists its files
  once, when it is created).  Only stream rows trigger output.
* stream–stream: both sides buffered in state; with ``bounded_stream_join``
  watermarks and a range of times let Spark drop rows that can match no more, and
  emit outer rows then.
* newest-version join: facts joined with the newest version of their
  dimension row, maintained from both sides per micro-batch without pairing
  a fact with every version of its dimension key.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.window import latest_per_key


def stream_static_join(stream: DataFrame, static: DataFrame, on, how: str = "inner") -> DataFrame:
    return stream.join(static, on, how)


def fresh_static_join(load_static: Callable[[], DataFrame], on, how: str,
                      sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: join each micro-batch to a freshly read static side."""
    def run(batch: DataFrame, epoch: int) -> None:
        sink(batch.join(load_static(), on, how), epoch)
    return run


def stream_stream_join(left: DataFrame, right: DataFrame, on: Sequence[str] | Column, how: str = "inner",
                       watermarks: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Join two streams whose state is kept without bound; key columns listed in ``on`` come once.
    ``watermarks = {"left": (col, delay), "right": (col, delay)}``."""
    if watermarks:
        if "left" in watermarks:
            left = left.withWatermark(*watermarks["left"])
        if "right" in watermarks:
            right = right.withWatermark(*watermarks["right"])
    return left.join(right, list(on) if isinstance(on, tuple) else on, how)


def bounded_stream_join(left: DataFrame, right: DataFrame, on: Sequence[str], times: tuple[str, str], delays: tuple[str, str],
                        earliest: str = "0 seconds", latest: str = "1 hour", how: str = "inner") -> DataFrame:
    """Rows of two streams with equal keys whose times are near: ``left time + earliest <= right time <= left time
    + latest`` (intervals such as ``"6 hours"``, ``"-30 minutes"``).

    Both sides carry a watermark (``delays``), so a buffered row goes once the other side's
    watermark is past every time that it could match, and state follows the range, not
    the stream.  ``how``: ``inner``, ``left_outer``, ``right_outer`` or ``full_outer``; a row without a match
    comes when it leaves the buffer, in the batch after that (Spark holds back rows that may
    still be matched when the input ends).  Input behind the watermark is dropped.

    Columns: the keys once (of the side that has a row), then the left and the right columns;
    other names must not occur on both sides.  A null key matches nothing; rows given
    twice match each for itself.
    """
    keys, (lt, rt) = list(on), times
    rest_l, rest_r = [c for c in left.columns if c not in keys], [c for c in right.columns if c not in keys]
    both = set(rest_l) & set(rest_r)
    if both:
        raise ValueError(f"columns of both sides: {sorted(both)}; rename them on one side")
    a = left.withWatermark(lt, delays[0]).alias("l")
    b = right.withWatermark(rt, delays[1]).alias("r")
    cond = F.expr(f"r.`{rt}` >= l.`{lt}` + INTERVAL '{earliest}' AND r.`{rt}` <= l.`{lt}` + INTERVAL '{latest}'")
    for k in keys:
        cond = cond & (F.col(f"l.`{k}`") == F.col(f"r.`{k}`"))

    def key(k: str) -> Column:
        if how.startswith("full"):
            return F.coalesce(F.col(f"l.`{k}`"), F.col(f"r.`{k}`"))
        return F.col(f"r.`{k}`" if how.startswith("right") else f"l.`{k}`")
    return a.join(b, cond, how).select(*[key(k).alias(k) for k in keys], *[F.col(f"l.`{c}`") for c in rest_l],
                                       *[F.col(f"r.`{c}`") for c in rest_r])


def newest_version_join(new_facts: DataFrame, changed_dims: DataFrame, known_dims: DataFrame,
                        all_facts: DataFrame, key: str, sequence_by: str) -> DataFrame:
    """One micro-batch of ``fact ⋈ newest dimension version`` rows for a newest-wins table.

    ``new_facts`` and ``changed_dims`` are the batch's new fact rows and dimension
    versions; ``known_dims`` are all dimension versions committed so far and
    ``all_facts`` all facts so far.  New facts meet the newest known version of
    their key; the newest version of each key changed in the batch meets that
    key's facts.  Each fact meets at most one dimension row per side, so a key
    with many versions costs one row per fact, not one per (fact, version).
    Upserted newest-wins on ``sequence_by`` (``scd1_upsert``), the batches give the
    same table as joining every fact with every version and keeping the newest.
    """
    def newest(d: DataFrame) -> DataFrame:
        return latest_per_key(d, [key], sequence_by)
    # only versions of keys the new facts carry are aggregated (a semi join first)
    wanted = known_dims.join(new_facts.select(key).distinct(), key, "left_semi")
    return (new_facts.join(newest(wanted), key)
            .unionByName(all_facts.join(newest(changed_dims), key)))
