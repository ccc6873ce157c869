"""Ranks, running sums and weights over whole tables and strata, without one-task windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import salted_digest
from .lineage import written

def counted_ranks(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, value, n_equal, before, n): each distinct value of a group, how many rows have it, how many have a smaller one, and how many have any.

    Values are counted first (combined before the shuffle), and the counts are written once, in ranges of group and value that Spark
    cuts to even sizes. A value's rank is the sum of the ranges before its own, a row per range, and of the values before it in its
    range; so no task sorts more than a range, however large a group is. Nulls and NaN don't count.
    """
    names = [f"_k{i}" for i in range(len(by))]
    counts = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*(F.col(c).alias(n) for c, n in zip(by, names)), F.col(value).alias("_v")).agg(F.count("*").alias("n_equal"))
    ranged = written(counts.repartitionByRange(*names, "_v").withColumn("_r", F.spark_partition_id()), "counted")
    totals = ranged.groupBy(*names, "_r").agg(F.sum("n_equal").alias("_t"))
    group = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))  # a row per range
    earlier = group.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*names, "_r", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_b"), F.sum("_t").over(group).alias("n"))
    smaller = Window.partitionBy(*names, "_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("_w", F.coalesce(F.sum("n_equal").over(smaller), F.lit(0))).alias("a").join(totals.alias("b"), reduce(lambda x, y: x & y, (F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*names, "_r"])))
    return rows.select(*(F.col(f"a.{n}").alias(c) for c, n in zip(by, names)), F.col("_v").alias(value), "n_equal", (F.col("_b") + F.col("_w")).alias("before"), "n")


def mid_rank(df: DataFrame, value: str, out: str, by: tuple[str, ...] = ()) -> DataFrame:
    """df with the mid-rank of a double column, (rank - 1 + (ties - 1) / 2) / max(1, n - 1), in each group.

    Ranks are those of counted_ranks(), joined back by value. Null values and NaN have no rank and don't count.
    """
    rank = (F.col("before") + (F.col("n_equal") - 1) / 2) / F.greatest(F.lit(1), F.col("n") - 1)
    found = counted_ranks(df, value, by).select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), F.col(value).alias("_mid_value"), rank.alias(out))
    on = F.col(value) == F.col("_mid_value")
    for i, c in enumerate(by):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return df.join(found, on, "left").drop("_mid_value", *(f"_k{i}" for i in range(len(by))))


def with_percentiles(report: DataFrame, rows: DataFrame, wanted: dict[str, tuple[str, float]], by: tuple[str, ...] = (), nearest: bool = False) -> DataFrame:
    """A report (a row per group) with percentiles of the rows of its groups: wanted maps new columns to (column, p).

    Linear between the two nearest values or, with nearest, the value at (n - 1) * p rounded half to even. They are picked by rank
    from counted_ranks(), so a group of any size is spread over tasks; values that aren't finite don't count.
    """
    columns = sorted({c for c, _ in wanted.values()})
    entries = F.array(*(F.struct(F.lit(c).alias("_m"), F.col(c).cast("double").alias("_x")) for c in columns))
    long = rows.select(*by, F.explode(entries).alias("_e")).select(*by, "_e._m", "_e._x").where("not isnan(_x) and abs(_x) <> double('inf')")
    ranked = counted_ranks(long, "_x", (*by, "_m"))
    at = lambda k: F.max(F.when((F.col("before") <= k) & (k < F.col("before") + F.col("n_equal")), F.col("_x")))
    picks = []
    for out, (column, p) in wanted.items():
        place = F.bround((F.col("n") - 1) * F.lit(float(p)), 0) if nearest else (F.col("n") - 1) * F.lit(float(p))
        own = lambda k, c=column: at(F.when(F.col("_m") == c, k))
        part = F.max(F.when(F.col("_m") == column, place - F.floor(place)))
        low, high = own(F.floor(place)), own(F.ceil(place))
        picks.append((low + (high - low) * part).alias(out))
    names = [f"_g{i}" for i in range(len(by))]
    found = ranked.groupBy(*(F.col(c).alias(n) for c, n in zip(by, names))).agg(*picks)
    if not by:
        return report.join(found)  # a row each
    on = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)))
    return report.join(found, on, "left").drop(*names)


def percentiles_of_sets(rows: DataFrame, dims: tuple[str, ...], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """(dimension, value, wanted columns): linear percentiles of all rows ("all", "all") and of the rows of each value of each dimension.

    Values are sorted once for all dimensions, in ranges that are written with their rows' dimensions, and counted per range and
    group where they are. A percentile's ranks lie in two ranges at most; only values of these ranges are ranked, for the groups
    that ask for them. So rows are shuffled once per measure, whatever the number of dimensions. Values that aren't finite don't count.
    """
    columns = sorted({c for c, _ in wanted.values()})
    entries = F.array(*(F.struct(F.lit(c).alias("_m"), F.col(c).cast("double").alias("_x")) for c in columns))
    long = rows.select(*dims, F.explode(entries).alias("_e")).select(*dims, "_e._m", "_e._x").where("not isnan(_x) and abs(_x) <> double('inf')")
    ranged = written(long.repartitionByRange("_m", "_x").withColumn("_r", F.spark_partition_id()), "ranged")
    groups = F.array(F.struct(F.lit("all").alias("dimension"), F.lit("all").alias("value")), *(F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dims))
    each = ranged.select("_m", "_x", "_r", F.explode(groups).alias("_g")).select("_m", "_x", "_r", "_g.*")
    key = ["_m", "dimension", "value"]
    group = Window.partitionBy(*key)  # a row per range
    spans = each.groupBy(*key, "_r").agg(F.count("*").alias("_t"))
    spans = spans.select(*key, "_r", "_t", F.coalesce(F.sum("_t").over(group.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"), F.sum("_t").over(group).alias("_n"))
    asks = F.array(*(F.struct(F.lit(out).alias("_out"), F.lit(c).alias("_c"), F.lit(float(p)).alias("_p")) for out, (c, p) in wanted.items()))
    asked = spans.select("*", F.explode(asks).alias("_a")).where("_a._c = _m").select(*key, "_r", "_t", "_b", "_a._out", ((F.col("_n") - 1) * F.col("_a._p")).alias("_place"))
    inside = lambda k: (F.col("_b") <= k) & (k < F.col("_b") + F.col("_t"))
    low, high = F.floor("_place"), F.ceil("_place")
    asked = written(asked.where(inside(low) | inside(high)), "asked")
    opened = asked.select(*key, "_r", "_b").distinct()
    counts = each.join(opened, [*key, "_r"]).groupBy(*key, "_r", "_b", "_x").agg(F.count("*").alias("_e"))
    upto = Window.partitionBy(*key, "_r").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_to", F.col("_b") + F.sum("_e").over(upto)).drop("_b")
    met = asked.drop("_b", "_t").join(counts, [*key, "_r"])
    holds = lambda k: F.max(F.when((F.col("_to") - F.col("_e") <= k) & (k < F.col("_to")), F.col("_x")))
    found = met.groupBy("dimension", "value", "_out", "_place").agg(holds(low).alias("_lo"), holds(high).alias("_hi"))
    found = found.withColumn("_v", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_place") - low))
    return found.groupBy("dimension", "value").agg(*(F.max(F.when(F.col("_out") == out, F.col("_v"))).alias(out) for out in wanted))


#: Rows of a cell that are summed in one part, about.
PART_ROWS = 1 << 16


def cell_cdf(df: DataFrame, cell: tuple[str, ...], weight: str, order: str, part_rows: int = PART_ROWS) -> DataFrame:
    """df with cdf_lo and cdf_hi: each row's part of [0, 1] in its cell, by weight, in the order of a unique column.

    A cell is cut into hash ranges of its rows, as many as its counted rows ask for, which are summed on their own; the row order is
    by range, then by `order`. Rows without a positive weight have an empty part; the last part ends at 1.
    """
    w = F.when(F.col(weight) > 0, F.col(weight)).otherwise(0.0)
    parts = df.groupBy(*cell).agg(F.ceil(F.count("*") / part_rows).cast("long").alias("_parts"))
    part = F.conv(F.substring(F.sha2(F.col(order).cast("string"), 256), 1, 8), 16, 10).cast("long") % F.col("_parts")
    rows = df.withColumn("_w", w).join(parts, list(cell)).withColumn("_p", part).drop("_parts")
    sums = rows.groupBy(*cell, "_p").agg(F.sum("_w").alias("_s"))
    before = Window.partitionBy(*cell).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*cell, "_p", F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_b"), F.sum("_s").over(Window.partitionBy(*cell)).alias("_t"))
    to_here = Window.partitionBy(*cell, "_p").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_c", F.sum("_w").over(to_here)).join(sums, [*cell, "_p"])
    high = F.least(F.lit(1.0), (F.col("_b") + F.col("_c")) / F.col("_t"))
    low = F.least(F.lit(1.0), (F.col("_b") + F.col("_c") - F.col("_w")) / F.col("_t"))
    return rows.withColumn("cdf_lo", low).withColumn("cdf_hi", high).drop("_w", "_p", "_c", "_b", "_t")


def hash_rank(df: DataFrame, strata: tuple[str, ...], id_col: str, salt: str, out: str = "rank", most: int | None = None) -> DataFrame:
    """df with a rank by salted digest, then id, in each stratum, from 1; with `most`, only the first so many (a literal limit, so that Spark cuts before the sort)."""
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*strata).orderBy(salted_digest(salt, F.col(id_col)), id_col)))
    return ranked if most is None else ranked.where(F.col(out) <= most)


def diverse_rank(df: DataFrame, strata: tuple[str, ...], group: str, id_col: str, salt: str, score: str | None = None, out: str = "rank") -> DataFrame:
    """df with a rank in each stratum in which the best row of every group comes before all other rows.

    Rows are ordered by score (largest first) and salted digest; a missing group is the row itself.
    """
    best = [F.coalesce(F.col(score), F.lit(0.0)).desc()] if score else []
    keyed = df.withColumn("_d", salted_digest(salt, F.col(id_col))).withColumn("_g", F.coalesce(F.nullif(F.col(group).cast("string"), F.lit("")), F.col(id_col).cast("string")))
    keyed = keyed.withColumn("_n", F.row_number().over(Window.partitionBy(*strata, "_g").orderBy(*best, "_d")))
    return keyed.withColumn(out, F.row_number().over(Window.partitionBy(*strata).orderBy((F.col("_n") > 1).cast("int"), *best, "_d"))).drop("_d", "_g", "_n")


def diverse_keys(df: DataFrame, strata: tuple[str, ...], group: str, id_col: str, salt: str, score: str | None = None) -> DataFrame:
    """(strata, id, _n, _s, _d) of rows with unique ids: what diverse_rank() orders by, without a window.

    _n is 0 for the best row of each group, which a minimum per group finds, else 1; _s is the score, turned, and _d the digest.
    """
    turned = -F.coalesce(F.col(score), F.lit(0.0)) if score else F.lit(0.0)
    name = F.coalesce(F.nullif(F.col(group).cast("string"), F.lit("")), F.col(id_col).cast("string"))
    slim = df.select(*dict.fromkeys((*strata, id_col)), name.alias("_g"), turned.alias("_s"), salted_digest(salt, F.col(id_col)).alias("_d"))
    first = slim.groupBy(*strata, "_g").agg(F.min(F.struct("_s", "_d", F.col(id_col).alias("_id"))).alias("_first")).select(F.col("_first._id").alias(id_col), F.lit(0).alias("_n"))
    return slim.drop("_g").join(first, id_col, "left").withColumn("_n", F.coalesce("_n", F.lit(1)))


def diverse_take(df: DataFrame, quotas: DataFrame, strata: tuple[str, ...], group: str, id_col: str, salt: str, score: str | None = None, out: str = "rank") -> DataFrame:
    """The rows of each stratum whose diverse_rank() is within its quota (strata, quota), with that rank; ids must be unique.

    Ids and keys are written once, in ranges of stratum and key that Spark cuts to even sizes, and counted per range; only the ranges
    that begin below a stratum's quota are ranked, each on its own. So no task sorts a stratum.
    """
    keys = ["_n", "_s", "_d"]
    ranged = written(diverse_keys(df, strata, group, id_col, salt, score).repartitionByRange(*strata, *keys).withColumn("_r", F.spark_partition_id()), "ranged")
    earlier = Window.partitionBy(*strata).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    begins = ranged.groupBy(*strata, "_r").agg(F.count("*").alias("_t")).withColumn("_b", F.coalesce(F.sum("_t").over(earlier), F.lit(0)))
    open_ = begins.join(quotas.select(*strata, "quota"), list(strata)).where("_b < quota").select(*strata, "_r", "_b", "quota")
    place = F.col("_b") + F.row_number().over(Window.partitionBy(*strata, "_r").orderBy(*keys))
    chosen = ranged.join(open_, [*strata, "_r"]).withColumn(out, place).where(F.col(out) <= F.col("quota")).select(id_col, out)
    return df.join(chosen, id_col).select(*df.columns, out)


def round_robin(df: DataFrame, strata: tuple[str, ...], id_col: str, n: int, salt: str) -> DataFrame:
    """n rows, one of each stratum in turn, by hash rank; position tells the order."""
    ranked = hash_rank(df, strata, id_col, salt, "_r", most=n)
    first = ranked.orderBy("_r", *strata).limit(n)
    return first.withColumn("position", F.row_number().over(Window.orderBy("_r", *strata))).drop("_r")  # n rows


def inverse_frequency(df: DataFrame, group: str, out: str = "inverse") -> DataFrame:
    """1 over the number of rows of the group; counts are joined, not windowed, so that a hot group stays spread."""
    counts = df.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("_n"))
    return df.join(counts, F.col(group).eqNullSafe(F.col("_g"))).withColumn(out, 1.0 / F.col("_n")).drop("_g", "_n")


def hierarchical_weights(rows: DataFrame, roles: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """rows with sampling_weight, which sums to 1 in each sample_type.

    rows: id, dataset_id, role, sample_type, source_sequence_id; roles: role, target; sources: dataset_id, source_weight (1 if missing).
    A role's target is shared among its datasets by square root of their rows times source weight, then
    renormalised over the roles and datasets that a type has; a dataset's share goes to its sequences equally.
    """
    counts = rows.groupBy("role", "dataset_id").agg(F.count("*").alias("n"))
    counts = counts.join(sources, "dataset_id", "left") if sources is not None else counts.withColumn("source_weight", F.lit(1.0))
    raw = F.sqrt("n") * F.coalesce("source_weight", F.lit(1.0))
    base = counts.withColumn("base", raw / F.sum(raw).over(Window.partitionBy("role"))).select("role", "dataset_id", "base")
    present = counts.select("role").distinct().join(roles, "role")
    target = present.withColumn("target", F.col("target") / F.sum("target").over(Window.partitionBy(F.lit(0)))).select("role", "target")  # a row per role
    cells = rows.select("sample_type", "role", "dataset_id").distinct().join(base, ["role", "dataset_id"]).join(target, "role")
    role_cell = cells.select("sample_type", "role", "target").distinct().withColumn("role_share", F.col("target") / F.sum("target").over(Window.partitionBy("sample_type"))).drop("target")
    cells = cells.join(role_cell, ["sample_type", "role"])
    cells = cells.withColumn("share", F.col("role_share") * F.col("base") / F.sum("base").over(Window.partitionBy("sample_type", "role"))).select("sample_type", "dataset_id", "share")
    per_sequence = rows.groupBy("sample_type", "dataset_id", "source_sequence_id").agg(F.count("*").alias("in_sequence"))
    sequences = per_sequence.groupBy("sample_type", "dataset_id").agg(F.count("*").alias("n_sequences"))
    weights = per_sequence.join(sequences, ["sample_type", "dataset_id"]).join(cells, ["sample_type", "dataset_id"])
    weights = weights.select("sample_type", "dataset_id", "source_sequence_id", (F.col("share") / F.col("n_sequences") / F.col("in_sequence")).alias("sampling_weight"))
    return rows.join(weights, ["sample_type", "dataset_id", "source_sequence_id"])
