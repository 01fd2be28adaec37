"""Positions, ranks and neighbours that never put one whole group into one task.

An ordered window over a hot key is one sort in one task. Where the order key is an integer, rows
are first cut into ranges of that key; a window then runs within a range, and a much smaller
window over one row per range supplies what came before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as w

from corpusloom.session import materialise

RANGE_WIDTH = 65536
#: Up to so many buckets with a cut pick their rows by a filter, and so many strata reach the rows as literals.
MAX_BUCKETS, MAX_STRATA = 4096, 64


def positions(df: DataFrame, order: str, group: list[str] | None = None, name: str = "position") -> DataFrame:
    """Add the one-based position of every row by ``order``, in its group if there are any.

    Rows are put in ranges of group and order key once; a window numbers them in their range, and one count per
    group and range says where it starts. So no task sees more than a range, however the keys lie. Rows
    without a key come last; equal keys are told apart by a hash of the whole row.
    """
    group = group or []
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])
    keys = [F.col(order).isNull(), F.col(order), tie]
    ranged = materialise(df.repartitionByRange(*group, *keys).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    earlier = w.Window.partitionBy(*group).orderBy("_range").rowsBetween(w.Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    offsets = sizes.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_range").alias("_at"), before)
    local = ranged.withColumn("_local", F.row_number().over(w.Window.partitionBy(*group, "_range").orderBy(*keys)))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group], F.col("_range") == F.col("_at"))
    return local.join(offsets, same).withColumn(name, F.col("_before") + F.col("_local")).select(*df.columns, name)


def neighbours(
    df: DataFrame,
    order: str,
    group: list[str],
    columns: dict[str, tuple[str, int, object]],
    width: int = RANGE_WIDTH,
    range_name: str | None = None,
) -> DataFrame:
    """Add columns of the previous (-1) or next (+1) row, ``{new: (column, step, default)}``.

    ``order`` counts 0, 1, 2, ... without gaps in each group. The rows at the edges of a range are
    copied into the neighbouring range, so that no row needs another range, and the copies are
    dropped afterwards. ``range_name`` names a column that keeps the first place of each row's range; the
    rows lie spread by group and range.
    """
    place = F.pmod(F.col(order), F.lit(width))
    own = F.col(order) - place
    ranges = F.array(own, F.when(place == 0, own - width), F.when(place == width - 1, own + width))
    copies = df.select("*", own.alias("_own"), F.explode(ranges).alias("_range")).where("_range >= 0")
    span = w.Window.partitionBy(*group, "_range").orderBy(order)
    found = [
        (F.lag(column, 1, default) if step < 0 else F.lead(column, 1, default)).over(span).alias(new)
        for new, (column, step, default) in columns.items()
    ]
    rows = copies.select("*", *found).where(F.col("_own") == F.col("_range")).drop("_own")
    return rows.drop("_range") if range_name is None else rows.withColumnRenamed("_range", range_name)


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], salts: int = 16, how: str = "inner", salt: str | None = None
) -> DataFrame:
    """Join a skewed ``left`` with a ``right`` that has at most one row per key.

    Left rows of one key are spread over ``salts`` partitions, and the right rows are repeated that
    many times. Or ``salt`` names a column of the left that spreads a key's rows already, and of the right the array of all values
    it has for the key: rows that lie spread by keys and salt are neither shuffled nor sorted again.
    """
    if salt is not None:
        return left.join(right.withColumn(salt, F.explode(salt)), [*keys, salt], how)
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    salted = left.withColumn("_salt", spread)
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, keys + ["_salt"], how).drop("_salt")


def hashed_key(key: Column, seed: int) -> Column:
    """A repeatable random order: the md5 of seed and key, as hexadecimal text."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def rank_cuts(
    df: DataFrame,
    stratum: str,
    key: str,
    cut_ranks: list[Column],
    seed: int,
    digits: int = 4,
) -> DataFrame:
    """Per stratum, the hashed keys that stand at the given ranks of the hashed order.

    ``cut_ranks`` are expressions over ``n``, the number of rows of the stratum. A histogram of the
    first hexadecimal digits finds the buckets that hold a cut; only rows in those buckets are
    shuffled, joined with them and ordered. Rank 0 yields an empty text, which every key exceeds.
    """
    hashed = df.select(F.col(stratum).alias("stratum"), hashed_key(F.col(key), seed).alias("h"))
    hashed = hashed.withColumn("bucket", F.substring("h", 1, digits))
    counts = hashed.groupBy("stratum", "bucket").agg(F.count("*").alias("c"))
    by_stratum = w.Window.partitionBy("stratum")
    running = counts.select(
        "*",
        F.sum("c").over(by_stratum).alias("n"),
        F.sum("c").over(by_stratum.orderBy("bucket").rowsBetween(w.Window.unboundedPreceding, 0)).alias("upto"),
    )
    wanted = running.select(
        "*", F.posexplode(F.array(*[c.cast("long") for c in cut_ranks])).alias("cut", "rank")
    )
    holds = (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("c"))
    start = (F.col("upto") == F.col("c")) & (F.col("rank") <= 0)
    wanted = materialise(wanted.select("*", holds.alias("holds"), start.alias("start")).where("holds OR start"), "cuts")
    inside = wanted.where("holds").select("stratum", "bucket", "cut", (F.col("rank") - F.col("upto") + F.col("c")).alias("need"))
    # one entry per stratum and bucket with a cut
    buckets = inside.groupBy(F.col("stratum").alias("s"), F.col("bucket").alias("b")).agg(
        F.collect_list(F.struct("need", "cut")).alias("needs")
    )
    few = [r["b"] for r in buckets.select("b").distinct().limit(MAX_BUCKETS + 1).collect()]
    asked = hashed.where(F.col("bucket").isin(few)) if len(few) <= MAX_BUCKETS else hashed
    near = asked.join(buckets, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    ordered = near.withColumn("r", F.row_number().over(w.Window.partitionBy("stratum", "bucket").orderBy("h")))
    hits = ordered.select("stratum", "h", "r", F.explode("needs").alias("need")).where(
        F.col("r") == F.col("need.need")
    )
    zero = wanted.where("start").select("stratum", "cut", F.lit("").alias("h"))
    return hits.select("stratum", F.col("need.cut").alias("cut"), "h").unionByName(zero)


def with_passed_cuts(
    df: DataFrame, stratum: str, key: str, cut_ranks: list[Column], seed: int, name: str
) -> DataFrame:
    """Add how many of the cuts of its stratum the hashed key of a row lies beyond.

    A null stratum is one like any other. The cuts of up to ``MAX_STRATA`` strata come to the rows as literals, so
    that no row is shuffled; more are joined.
    """
    cuts = rank_cuts(df, stratum, key, cut_ranks, seed)
    per_stratum = materialise(cuts.groupBy(F.col("stratum").alias("_stratum")).agg(F.collect_list("h").alias("_cuts")), "cuts")
    few, kind = per_stratum.limit(MAX_STRATA + 1).collect(), df.select(stratum).schema[0].dataType
    if len(few) <= MAX_STRATA and "<" not in kind.simpleString():
        own = F.lit(None).cast("array<string>")
        for r in few:
            same = F.col(stratum).eqNullSafe(F.lit(r["_stratum"]).cast(kind))
            own = F.when(same, F.array(*[F.lit(h) for h in r["_cuts"]]).cast("array<string>")).otherwise(own)
        held = df.withColumn("_cuts", own)
    else:
        held = df.join(per_stratum, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    passed = F.size(F.filter("_cuts", lambda h: h < hashed_key(F.col(key), seed)))
    return held.withColumn(name, passed).select(*df.columns, name)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in a repeatable random order."""
    return df.orderBy(hashed_key(F.col(key), seed), key).limit(n)


def preview(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(key).limit(n)
