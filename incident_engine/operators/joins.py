"""Join one large side with a keyed side of unknown size.

A side is broadcast only after its rows and bytes were counted against a
bound. Beyond the bound the join shuffles. A sketch of the most frequent keys
of the large side, taken in every task and merged, then names the keys that
hold more than one task's share; only rows with those keys are spread, over as
many salts as their share calls for, and only those keys of the other side are
repeated. Rows with a null key match nothing and never reach the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: The most keys that are spread (each has more than its share), and keys the sketch tracks.
HEAVY_KEYS, TRACKED = 256, 4096
_SALT, _HASH, _SALTS = "__salt", "__hash", "__salts"


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                   max_bytes: int = BROADCAST_BYTES) -> bool:
    """Is the frame proven to be within the bound? One pass of partial sums over it.

    The frame is read here and again by the join: hand in a written table.
    """
    text_bytes = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(text_bytes), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def heavy_keys(large: DataFrame, keys: list[str], tasks: int) -> dict[int, int]:
    """Hash of a key to its number of salts, for the keys with more than 1 / ``tasks`` of the rows.

    The sketch has a fixed size per task; at most HEAVY_KEYS entries reach the driver. Counts may
    be a little off, which changes the number of salts and never the result.
    """
    hashed = large.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias(_HASH)).dropna()
    top, rows = hashed.agg(
        F.expr(f"approx_top_k({_HASH}, {HEAVY_KEYS}, {TRACKED})"), F.count(F.lit(1))).first()
    return {x["item"]: -(-x["count"] * tasks // rows) for x in top if x["count"] * tasks > rows}


def join_spread(large: DataFrame, keyed: DataFrame, keys: list[str], how: str = "inner",
                tasks: int | None = None) -> DataFrame:
    """Join by shuffle with the hot keys of ``large`` spread; ``how`` must keep or drop its rows.

    ``large`` is read once more for the sketch: hand in a table or a cheap plan. ``tasks`` is the
    number of tasks to even out for, the session's shuffle partitions by default.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} would repeat rows of the salted side")
    spark = large.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(f"`{k}`").isNotNull()
    matchable, other = large.filter(whole), keyed.filter(whole)
    heavy = heavy_keys(matchable, keys, tasks)
    if heavy:
        salts = F.broadcast(spark.createDataFrame(
            list(heavy.items()), f"{_HASH} long, {_SALTS} long"))  # at most HEAVY_KEYS rows
        by_key = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
        hashable = [F.col(f"`{f.name}`") for f in large.schema.fields
                    if "map<" not in f.dataType.simpleString()]
        # Row content plus partition number: a rerun task gives each row its old
        # salt, and equal rows of different partitions still part.
        spread = F.xxhash64(*hashable, F.spark_partition_id())
        several = F.coalesce(F.col(_SALTS), F.lit(1))
        salted = matchable.withColumn(_SALT, spread).withColumn(_HASH, by_key) \
            .join(salts, _HASH, "left").withColumn(_SALT, F.pmod(F.col(_SALT), several)) \
            .drop(_HASH, _SALTS)
        repeated = other.withColumn(_HASH, by_key).join(salts, _HASH, "left").withColumn(
            _SALT, F.explode(F.sequence(F.lit(0).cast("long"), several - 1))).drop(_HASH, _SALTS)
        joined = salted.join(repeated, [*keys, _SALT], how).drop(_SALT)
    else:
        joined = matchable.join(other, keys, how)
    if how in ("inner", "left_semi"):
        return joined
    return joined.unionByName(large.filter(~whole), allowMissingColumns=True)


def join_keyed(large: DataFrame, keyed: DataFrame, keys: list[str], how: str = "inner",
               broadcast: bool | None = None, salts: int | None = None) -> DataFrame:
    """Join ``large`` with ``keyed`` on ``keys``; ``how`` must keep or drop large rows only.

    Pass ``broadcast`` when the caller has already checked the size. ``salts`` is the number of
    tasks that a key with all rows would be spread over.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} would repeat rows of the salted side")
    if broadcast is None:
        broadcast = fits_broadcast(keyed)
    if broadcast:
        return large.join(F.broadcast(keyed), keys, how)
    return join_spread(large, keyed, keys, how, salts)
