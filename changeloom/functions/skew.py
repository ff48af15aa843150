"""Joins and aggregates that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions

_HASH, _SLOT, _FAN, _ELIGIBLE = "__key_hash", "__slot", "__fan", "__eligible"
_SKETCH_GROUPS, _SKETCH_TOP, _SKETCH_ITEMS = 256, 64, 1024
# Slots are assigned to partitions by hash, so several per partition even out.
_SLOTS_PER_SHARE, _IDLE_SLOTS = 4, 1 << 20

#: Upper bound of what is broadcast by hint, in bytes of key and value cells.
BROADCAST_BYTES = 8 * 1024 * 1024
_ROW_OVERHEAD, _CELL = 32, 16


def fits_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df``: is it small enough to be sent to every executor?

    Meant for change data, never called on a target table. The row count comes first, which staged parquet
    answers from its footers; only cells of variable width need to be looked at, and only if rows are few.
    """
    rows = df.count()
    fixed = rows * (_ROW_OVERHEAD + _CELL * len(df.columns))
    if fixed > limit_bytes:
        return False
    variable = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    if not variable or not rows:
        return True
    cells = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in variable]
    return fixed + df.agg(F.sum(sum(cells, F.lit(0)))).first()[0] <= limit_bytes


def hot_keys(df: DataFrame, keys: Sequence[str]) -> list[tuple[int, int]]:
    """Hashes of the keys with more than an average shuffle partition's share of the rows, and the number
    of slots to spread each of them over.

    One job over the key columns: map-side frequent-item sketches, of which 256 are merged by exact sums, so
    neither a task nor the driver sees more than 256 x 64 candidates, and at most as many keys come out as
    there are shuffle partitions. The counts are estimates, which is enough to decide where rows are sent.
    """
    n = shuffle_partitions(df.sparkSession)
    sketched = (
        df.select(F.xxhash64(*keys).alias(_HASH))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("__group"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.expr(f"approx_top_k({_HASH}, {_SKETCH_TOP}, {_SKETCH_ITEMS})").alias("top"),
        )
    )
    # Every group also reports its row count, as the item NULL.
    size = F.struct(F.lit(None).cast("long").alias("item"), F.col("rows").alias("count"))
    counted = sketched.select(F.inline(F.concat(F.col("top"), F.array(size))))
    counts = {r["item"]: r["count"] for r in counted.groupBy("item").agg(F.sum("count").alias("count")).collect()}
    share = max(1.0, counts.pop(None, 0) / n)
    return [(item, ceil(count / share * _SLOTS_PER_SHARE)) for item, count in counts.items() if count > share]


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """:func:`lookup_parts` as one DataFrame."""
    joined, idle = lookup_parts(left, right, keys, **options)
    return joined if idle is None else joined.unionByName(idle, allowMissingColumns=True)


def lookup_parts(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    salt_by: Sequence[str],
    eligible: Expr | None = None,
    idle: Expr | None = None,
    how: str = "left",
    small: bool | None = None,
    detect: bool = True,
    rescan: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """``left`` with the columns of the matching row of ``right``, which has one row per key.

    ``left`` may hold any number of rows per key, and one key may hold a large share of it.

    * If ``right`` is small, it is broadcast and ``left`` stays where it is. ``small=None`` measures it.
    * Otherwise rows that ``eligible`` says cannot match do not travel with their key. They bypass the
      shuffle, for which ``left`` is scanned twice, and are returned as the second part, without the columns
      of ``right``. ``idle`` may say the opposite in terms that a scan can use. With ``rescan=False`` they are spread
      evenly instead.
    * The rows of hot keys are spread by a hash of ``salt_by`` over slots in proportion to their number. The
      one matching row of ``right`` is repeated per slot: for all hot keys together at most eight times the
      number of shuffle partitions. The salt depends on row values only, so a task that runs again sends
      every row to the same place. ``detect=False`` states that eligible rows have few rows per key.
    """
    keys = list(keys)
    can_match = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    if small is None:
        small = fits_broadcast(right)
    if small:
        if eligible is None:
            return left.join(F.broadcast(right), keys, how), None
        flagged = F.broadcast(right.withColumn(_ELIGIBLE, F.lit(True)))
        return left.withColumn(_ELIGIBLE, can_match).join(flagged, [*keys, _ELIGIBLE], how).drop(_ELIGIBLE), None

    if not rescan:
        own = -1 - F.pmod(F.xxhash64(*salt_by), F.lit(_IDLE_SLOTS))
        spread = left.withColumn(_SLOT, F.when(can_match, F.lit(0).cast("bigint")).otherwise(own))
        return spread.join(right.withColumn(_SLOT, F.lit(0).cast("bigint")), [*keys, _SLOT], how).drop(_SLOT), None
    matching = left if eligible is None else left.filter(eligible)
    hot = hot_keys(matching, keys) if detect else []
    joined = _salted(matching, right, keys, salt_by, hot, how) if hot else matching.join(right, keys, how)
    return joined, (None if eligible is None or how == "inner" else left.filter(~can_match if idle is None else idle))


def _salted(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    salt_by: Sequence[str],
    hot: list[tuple[int, int]],
    how: str,
) -> DataFrame:
    fans = F.broadcast(left.sparkSession.createDataFrame(hot, f"{_HASH} bigint, {_FAN} int"))
    fan = F.coalesce(F.col(_FAN), F.lit(1))
    slotted = (
        left.withColumn(_HASH, F.xxhash64(*keys))
        .join(fans, _HASH, "left")
        .withColumn(_SLOT, F.pmod(F.xxhash64(*salt_by), fan).cast("int"))
        .drop(_HASH, _FAN)
    )
    repeated = (
        right.withColumn(_HASH, F.xxhash64(*keys))
        .join(fans, _HASH, "left")
        .withColumn(_SLOT, F.explode(F.sequence(F.lit(0), fan - 1)))
        .drop(_HASH, _FAN)
    )
    return slotted.join(repeated, [*keys, _SLOT], how).drop(_SLOT)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Expr]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so a hot key sends one row per
    task rather than all of them.
    """
    rank = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(rank)).filter(F.col("__rank") == 1).drop("__rank")
