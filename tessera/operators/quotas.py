"""Exact quotas from counted cells, and the rows or draws that fill them."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import salted_digest, uniform
from .lineage import held
from .ranks import cell_cdf, diverse_take, hash_rank

EXACT, WHOLE = "decimal(38,18)", "decimal(19,0)"


def _place(cell: str, order: tuple[str, ...]) -> list[Column]:
    """Sort columns: cells in the order given, others behind them, by name."""
    if not order:
        return [F.col(cell)]
    at = F.array_position(F.array(*(F.lit(c) for c in order)), F.col(cell))
    return [F.coalesce(F.nullif(at, F.lit(0)), F.lit(len(order) + 1)), F.col(cell)]


def largest_remainder(cells: DataFrame, cell: str, weight: str, total: Column | int, by: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> DataFrame:
    """cells with quota: total shared by weight, rounded down, the rest to the largest remainders, of equals to the cell that comes
    first in `order`, then by name.

    Whole weights are shared in whole numbers, so remainders are compared as they are, up to products of 38 digits. Other weights are
    added up exactly, in any order to one sum, and remainders compared to nine places. Weights must not be negative; a total needs a positive one.
    """
    total = F.lit(total) if isinstance(total, int) else total
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # a row per cell
    whole = cells.schema[weight].dataType.typeName() in ("byte", "short", "integer", "long")
    w = F.col(weight).cast(WHOLE if whole else EXACT)
    rows = cells.withColumn("_all", F.nullif(F.sum(w).over(group), F.lit(0)))
    if whole:
        rows = rows.withColumn("_s", w * total.cast("decimal(18,0)"))
        rows = rows.withColumns({"_f": F.expr("_s div _all"), "_r": F.col("_s") % F.col("_all")})
    else:
        rows = rows.withColumn("_s", total * F.col(weight) / F.col("_all").cast("double"))
        rows = rows.withColumns({"_f": F.floor("_s").cast("long"), "_r": F.round(F.col("_s") - F.floor("_s"), 9)})
    rows = rows.withColumns({"_f": F.coalesce("_f", F.lit(0)), "_r": F.coalesce("_r", F.lit(0))})
    rows = rows.withColumn("_left", total.cast("long") - F.sum("_f").over(group))
    ranks = group.orderBy(F.col("_r").desc(), *_place(cell, order))
    rows = rows.withColumn("quota", F.col("_f") + (F.row_number().over(ranks) <= F.col("_left")).cast("long"))
    return rows.drop("_all", "_s", "_f", "_r", "_left")


def bounded_proportional(cells: DataFrame, cell: str, capacity: str, total: int, by: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> DataFrame:
    """cells with quota: total shared by capacity, so that no cell gets more than it holds; a total above all capacities raises."""
    held = F.sum(capacity).over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))  # a row per cell
    lacking = F.raise_error(F.concat(F.lit(f"{total} rows wanted, there are "), held.cast("string"))).cast("long")
    rows = largest_remainder(cells, cell, capacity, total, by, order)
    return rows.withColumn("quota", F.when(held < total, lacking).otherwise(F.col("quota")))


def bounded_quota(cells: DataFrame, total: Column | int, cell: str = "cell", weight: str = "weight", capacity: str = "capacity", plan: str = "plan_id") -> DataFrame:
    """(plan_id, cell, weight, capacity) -> the same with quota: shared by weight, no cell above its capacity, all of the total used while there is room.

    A water level: cells in the order of capacity over weight are full as long as the level of the others reaches them; what is
    left is shared among the others by largest remainder. Cells without weight share equally what those with one can't hold.
    """
    total = F.lit(total) if isinstance(total, int) else total
    rows = cells.withColumn("_room", F.greatest(F.coalesce(F.col(capacity).cast("long"), F.lit(0)), F.lit(0)))
    rows = rows.withColumn("_bare", ~F.coalesce(F.col(weight) > 0, F.lit(False)))
    rows = rows.withColumn("_w", F.when(F.col("_bare"), 1.0).otherwise(F.col(weight).cast("double")))
    weighted_room = F.coalesce(F.sum(F.when(~F.col("_bare"), F.col("_room"))).over(Window.partitionBy(plan)), F.lit(0))
    own = Window.partitionBy(plan, "_bare")
    offered = F.when(F.col("_bare"), F.greatest(total - weighted_room, F.lit(0))).otherwise(total)
    rows = rows.withColumn("_pour", F.least(offered.cast("long"), F.sum("_room").over(own)))
    order = own.orderBy(F.col("_room") / F.col("_w"), cell)
    below = F.coalesce(F.sum("_room").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    above = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_full", (F.col("_pour") - below) * F.col("_w") >= F.col("_room") * above)
    rows = rows.withColumn("_rest", F.col("_pour") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_room"))).over(own), F.lit(0)))
    rows = largest_remainder(rows.withColumn("_w", F.when(F.col("_full"), 0.0).otherwise(F.col("_w"))), cell, "_w", F.col("_rest"), (plan, "_bare"))
    return rows.withColumn("quota", F.when(F.col("_full"), F.col("_room")).otherwise(F.col("quota"))).drop("_room", "_bare", "_w", "_pour", "_full", "_rest")


def dataset_quotas(rows: DataFrame, total: int, most: int | None = None, weights: DataFrame | None = None) -> DataFrame:
    """Quotas per dataset: weight times the square root of its rows, `most` rows at most."""
    counts = rows.groupBy(F.lit("all").alias("plan_id"), F.col("dataset_id").alias("cell")).agg(F.count("*").alias("n"))
    if weights is not None:
        counts = counts.join(weights.select(F.col("dataset_id").alias("cell"), F.col("weight").alias("user")), "cell", "left")
    user = F.coalesce("user", F.lit(1.0)) if weights is not None else F.lit(1.0)
    capacity = F.least("n", F.lit(most)) if most is not None else F.col("n")
    return bounded_quota(counts.select("plan_id", "cell", (user * F.sqrt("n")).alias("weight"), capacity.alias("capacity")), total).withColumnRenamed("cell", "dataset_id").drop("plan_id")


def take_quota(ranked: DataFrame, quotas: DataFrame, keys: tuple[str, ...], rank: str = "rank") -> DataFrame:
    """Rows whose rank is within their cell's quota; quotas hold a row per cell."""
    return ranked.join(quotas.select(*keys, "quota"), list(keys)).where(F.col(rank) <= F.col("quota")).drop("quota")


def stratified_sample(rows: DataFrame, strata: tuple[str, ...], id_col: str, n: int, salt: str) -> DataFrame:
    """n rows, strata in proportion, by salted digest: the same rows in any order and partitioning."""
    counts = rows.groupBy(*strata).agg(F.count("*").alias("_n")).withColumn("_cell", F.concat_ws("\x1f", *strata))
    quotas = largest_remainder(counts, "_cell", "_n", F.least(F.lit(n).cast("long"), F.sum("_n").over(Window.partitionBy(F.lit(0)))))  # a row per stratum
    return take_quota(hash_rank(rows, strata, id_col, salt, most=n), quotas, strata)


def cap_and_refill(selected: DataFrame, eligible: DataFrame, most: int, score: str, id_col: str = "id") -> DataFrame:
    """Selected rows, `most` per dataset; what goes is replaced by eligible rows of the same type from datasets with room.

    The worst rows over the cap go. Short types are refilled one after another, by name: the best rows (score, then id) of the
    type in datasets that still have room, which earlier types leave. A type stays short only where no such row is left.
    The loop runs over the short types; each pass is two ranks, and its rows are kept as a checkpoint (id and dataset only).
    """
    best = [F.col(score).desc(), F.col(id_col)]
    kept = selected.withColumn("_r", F.row_number().over(Window.partitionBy("dataset_id").orderBy(*best)))
    short = kept.where(f"_r > {most}").groupBy("sample_type").agg(F.count("*").alias("n")).collect()  # a row per type
    kept = kept.where(f"_r <= {most}").drop("_r")
    pool = eligible.join(selected.select(id_col), id_col, "left_anti")
    used, refill = kept.select("dataset_id"), []
    for sample_type, n in sorted(((r["sample_type"], r["n"]) for r in short), key=lambda x: str(x[0])):
        counts = used.groupBy("dataset_id").agg(F.count("*").alias("_n"))
        open_ = pool.where(F.col("sample_type").eqNullSafe(sample_type)).select(id_col, "dataset_id", score).join(counts, "dataset_id", "left").fillna(0, ["_n"])
        open_ = open_.withColumn("_d", F.row_number().over(Window.partitionBy("dataset_id").orderBy(*best))).where(F.col("_d") + F.col("_n") <= most)
        taken = held(open_.orderBy(*best).limit(n).select(id_col, "dataset_id"))
        used = used.unionByName(taken.select("dataset_id"))
        refill.append(taken.select(id_col))
    if not refill:
        return kept
    return kept.unionByName(pool.join(reduce(DataFrame.unionByName, refill), id_col, "left_semi").select(kept.columns))


def group_holdout(rows: DataFrame, least: int, target: int, most: int, pattern: str = ".*", salt: str = "pretrain_teacher_holdout_v1", plan: Column | None = None) -> DataFrame:
    """(plan_id, dataset_id, n): the whole datasets whose row total is closest to target within [least, most].

    Of equally close totals the larger. Of several ways to a total the one of datasets that come early by salted digest: for every
    total the first dataset that makes it reachable is kept, and the way is read backwards. Only totals that some datasets add up to
    are held (16 bytes each), so memory follows the datasets' sums, not their rows. A plan without a fitting total gives no rows.
    """
    counts = rows.groupBy((plan if plan is not None else F.lit("all")).alias("plan_id"), "dataset_id").agg(F.count("*").alias("n"))
    return holdout_of_counts(counts, least, target, most, pattern, salt)


def holdout_of_counts(counts: DataFrame, least: int, target: int, most: int, pattern: str = ".*", salt: str = "pretrain_teacher_holdout_v1") -> DataFrame:
    """group_holdout() of datasets whose rows are counted: plan_id, dataset_id, n."""
    counts = counts.select("plan_id", "dataset_id", "n").where(F.col("dataset_id").rlike(f"^(?:{pattern})$") & (F.col("n") <= most))
    ordered = counts.withColumn("_d", salted_digest(salt, F.col("dataset_id"), separator="\0"))

    def choose(cells: pd.DataFrame) -> pd.DataFrame:
        sizes = cells.sort_values("_d")["n"].astype(int).tolist()
        totals, opener = np.zeros(1, np.int64), np.full(1, -1, np.int64)  # sums in order, and which dataset made each reachable first
        for k, n in enumerate(sizes):
            fresh = np.setdiff1d(totals[totals <= most - n] + n, totals, assume_unique=True)
            at = np.searchsorted(totals, fresh)
            totals, opener = np.insert(totals, at, fresh), np.insert(opener, at, k)
        fitting = totals[totals >= least]
        if not len(fitting):
            return cells.head(0).drop(columns="_d")
        at, way = min(fitting.tolist(), key=lambda t: (abs(t - target), t < target)), []
        while at:
            way.append(int(opener[np.searchsorted(totals, at)]))
            at -= sizes[way[-1]]
        return cells.sort_values("_d").iloc[way].drop(columns="_d")

    return ordered.groupBy("plan_id").applyInPandas(choose, counts.schema)


def redistribute_missing(fractions: DataFrame, present: DataFrame, by: tuple[str, ...], key: str) -> DataFrame:
    """(by, key, fraction) restricted to the keys present, renormalised to 1 in each group."""
    kept = fractions.join(present.select(*by, key).distinct(), [*by, key], "left_semi")
    return kept.withColumn("fraction", F.col("fraction") / F.sum("fraction").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))))


def tier_type_quota(rows: DataFrame, batch_size: int, fractions: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """(tier, sample_type, quota) of a batch: a tier's rows are its fraction, rounded half up, the last tier by name takes the rest; in a tier
    largest remainder by type counts, equal remainders in the order of types given, then by name."""
    tiers = redistribute_missing(fractions, rows, (), "tier")
    whole = Window.partitionBy(F.lit(0)).orderBy("tier")  # a row per tier
    tiers = tiers.withColumn("_q", F.floor(F.col("fraction") * batch_size + 0.5).cast("long")).withColumn("_last", F.lead("tier").over(whole).isNull())
    before = F.coalesce(F.sum("_q").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tiers = tiers.withColumn("tier_quota", F.when(F.col("_last"), F.lit(batch_size) - before).otherwise(F.col("_q"))).select("tier", "tier_quota")
    cells = rows.groupBy("tier", "sample_type").agg(F.count("*").alias("n")).join(tiers, "tier")
    return largest_remainder(cells, "sample_type", "n", F.col("tier_quota"), ("tier",), order).select("tier", "sample_type", "n", "quota")


def rare_cell_cap(cells: DataFrame, draws: str = "quota", average: float = 4.0, heaviest: float = 16.0, slack: float = 0.0) -> DataFrame:
    """Counted cells (n, total_weight, max_weight, quota) with quota capped so that a row is drawn `average` times on the mean
    and the heaviest `heaviest` times at most; freed tells what was cut. The first step of rare_cell_quota()."""
    cap = F.floor(F.least(F.col("n") * average, heaviest * F.col("total_weight") / F.col("max_weight")) + slack).cast("long")
    return cells.withColumn("_q", F.least(draws, cap)).withColumn("freed", F.col(draws) - F.col("_q")).withColumn(draws, F.col("_q")).drop("_q")


def rare_cell_quota(cells: DataFrame, positives: tuple[str, ...], by: tuple[str, ...] = ("tier",), share: str = "fraction", draws: str = "quota", average: float = 4.0, heaviest: float = 16.0) -> DataFrame:
    """Counted cells (by, sample_type, n, total_weight, max_weight, fraction, quota) with quota capped by rare_cell_cap(), and what was cut
    given to the uncapped positive types of the same group by their fractions, largest remainder, of equals in the order of `positives`.

    freed tells what was cut, added what was given. A row's quota raises an error where its group has draws left over, as no positive
    cell is uncapped, or where the cell is over a limit after all. A group's quotas add up to what they were.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # a row per cell
    at = F.array_position(F.array(*(F.lit(p) for p in positives)), F.col("sample_type"))
    capped = rare_cell_cap(cells, draws, average, heaviest, 1e-12).withColumn("_freed", F.sum("freed").over(group)).withColumn("_at", at)
    open_ = capped.where(f"_at > 0 and freed = 0 and n > 0 and `{share}` > 0")
    given = largest_remainder(open_.select(*by, "sample_type", "_at", share, "_freed"), "_at", share, F.col("_freed"), by)
    rows = capped.join(given.select(*by, "sample_type", F.col("quota").alias("added")), [*by, "sample_type"], "left").fillna(0, ["added"])
    total = F.col(draws) + F.col("added")
    over = (total > F.col("n") * (average + 1e-12)) | (total * F.col("max_weight") / F.col("total_weight") > heaviest + 1e-12)
    lost = F.sum("added").over(group) != F.col("_freed")
    name = F.concat_ws(":", *by, "sample_type")
    checked = F.when(lost, F.raise_error(F.concat(F.lit("no uncapped positive cell for the draws cut in "), name)).cast("long"))
    checked = checked.when(F.coalesce((total > 0) & over, F.lit(False)), F.raise_error(F.concat(F.lit("over its limits after redistribution: "), name)).cast("long"))
    return rows.withColumn(draws, checked.otherwise(total)).drop("_freed", "_at")


def auto_epoch_size(rows: DataFrame, per_batch: DataFrame, limit: float, average: float | None = None, upper: int | None = None) -> DataFrame:
    """The most batches of an epoch of `upper` rows at most in which the heaviest row of no cell is expected more than `limit` times,
    and a cell's rows not more than `average` times on the mean; tightest_cell is the one nearest to its limits.

    rows: cell, weight; per_batch: cell, quota (rows of the cell in a batch). A cell without rows or weight, and limits that no
    whole batch keeps, raise an error.
    """
    shares = rows.groupBy("cell").agg((F.max("weight") / F.nullif(F.sum("weight"), F.lit(0))).alias("top"), F.count("*").alias("n"))
    fits = per_batch.where("quota > 0").join(shares, "cell", "left")
    most = (limit + 1e-12) / (F.col("top") * F.col("quota"))
    if average is not None:
        most = F.least(most, (average + 1e-12) * F.col("n") / F.col("quota"))
    fits = fits.withColumn("_most", F.when(F.col("top").isNull(), F.raise_error(F.concat(F.lit("no rows to draw in "), "cell")).cast("double")).otherwise(most))
    batches = F.floor(F.min("_most")).cast("long")
    if upper is not None:
        batches = F.least(batches, F.floor(F.lit(upper) / F.sum("quota")).cast("long"))
    found = fits.agg(batches.alias("batches"), F.min_by("cell", F.struct("_most", "cell")).alias("tightest_cell"))
    none = F.raise_error(F.concat(F.lit("no whole batch keeps the limits, tightest: "), "tightest_cell")).cast("long")
    return found.withColumn("batches", F.when(F.col("batches") < 1, none).otherwise(F.col("batches")))


#: Slots that are made from one row, and rows and slots of a bucket, about.
SLOTS, BUCKET_ROWS = 1 << 16, 1 << 16


def weighted_draws(rows: DataFrame, quotas: DataFrame, cell: tuple[str, ...], seed: int, epoch: int, id_col: str = "id", weight: str = "weight") -> DataFrame:
    """(cell, slot, id): quota draws with replacement in each cell, by weight; the same for a seed and epoch in any partitioning.

    A slot's uniform number is a digest of seed, epoch, cell and slot; slots are made in chunks, dealt before they are unfolded. The row
    that a slot falls on is found by sorting slots and the rows' parts of [0, 1] together, in as many buckets of [0, 1] as a
    cell's counted rows and draws ask for.
    """
    wanted = quotas.where("quota > 0").select(*cell, F.col("quota").cast("long").alias("quota"))
    chunks = wanted.select(*cell, "quota", F.explode(F.expr(f"sequence(0L, (quota - 1) div {SLOTS})")).alias("_c")).repartition(*cell, "_c")
    slots = chunks.select(*cell, F.explode(F.sequence(F.col("_c") * SLOTS + 1, F.least("quota", (F.col("_c") + 1) * SLOTS))).alias("slot"))
    slots = slots.withColumn("u", uniform(F.lit(seed), F.lit(epoch), *(F.col(c) for c in cell), F.col("slot")))
    sizes = rows.groupBy(*cell).agg(F.count("*").alias("_n")).join(wanted, list(cell)).select(*cell, F.ceil((F.col("_n") + F.col("quota")) / BUCKET_ROWS).cast("long").alias("buckets"))
    return cdf_join(slots, cell_cdf(rows, cell, weight, id_col), cell, id_col, sizes)


def cdf_join(slots: DataFrame, parts: DataFrame, cell: tuple[str, ...], id_col: str, buckets: DataFrame) -> DataFrame:
    """slots (cell, slot, u) joined to the row of parts (cell, cdf_lo, cdf_hi) with cdf_lo <= u < cdf_hi, by buckets of u; buckets: (cell, buckets), how many a cell has."""
    slots, parts, n = slots.join(buckets, list(cell)), parts.where("cdf_hi > cdf_lo").join(buckets, list(cell)), F.col("buckets")
    bucket = lambda c: F.least(F.floor(c * n), n - 1)
    spans = parts.select(*cell, id_col, "cdf_lo", "cdf_hi", "buckets", F.explode(F.sequence(bucket(F.col("cdf_lo")), F.greatest(bucket(F.col("cdf_lo")), F.ceil(F.col("cdf_hi") * n) - 1))).alias("bucket"))
    marks = spans.select(*cell, "bucket", F.greatest("cdf_lo", F.col("bucket") / n).alias("at"), F.lit(0).alias("kind"), F.col(id_col).alias("own"), F.lit(None).cast("long").alias("slot"))
    points = slots.select(*cell, bucket(F.col("u")).alias("bucket"), F.col("u").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(parts.schema[id_col].dataType).alias("own"), "slot")
    order = Window.partitionBy(*cell, "bucket").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = marks.unionByName(points).withColumn("own", F.last("own", ignorenulls=True).over(order))
    return found.where("kind = 1").select(*cell, "slot", F.col("at").alias("u"), F.col("own").alias(id_col))


def mix_weights(hard: DataFrame, replay: DataFrame, fraction: float) -> DataFrame:
    """Both sets with mix_weight: a set's fraction times the row's weight over the set's size."""
    sizes = [t.agg(F.count("*").alias("_n")) for t in (hard, replay)]
    parts = [t.crossJoin(F.broadcast(n)).withColumn("mix_weight", F.col("weight") * f / F.col("_n")).withColumn("mix_role", F.lit(r)).drop("_n") for t, n, f, r in zip((hard, replay), sizes, (fraction, 1 - fraction), ("hard", "replay"))]  # one row each
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def select_replay(rows: DataFrame, budget: int, confirmed: Column, salt: str = "replay", fractions: dict[str, float] | None = None, weights: DataFrame | None = None) -> DataFrame:
    """All negatives, then positives up to the budget: quotas by sample_type (fractions, equal without any), in a type by dataset
    (weight times the square root of its rows), one row of each sequence first.

    Raises where a negative is not confirmed, or where the negatives alone exceed the budget.
    """
    present = F.coalesce("present", F.lit(False))
    negatives, positives = rows.where(~present), rows.where(present)
    if wrong := negatives.where(~F.coalesce(confirmed, F.lit(False))).select("id").limit(5).collect():
        raise ValueError(f"unconfirmed negatives: {[r['id'] for r in wrong]}")
    left = budget - negatives.count()
    if left < 0:
        raise ValueError(f"confirmed negatives exceed the budget of {budget} by {-left}")
    counts = positives.groupBy("sample_type", "dataset_id").agg(F.count("*").alias("capacity"))
    shares = rows.sparkSession.createDataFrame([(k, float(v)) for k, v in (fractions or {}).items()], "cell string, weight double")
    types = counts.groupBy(F.lit("all").alias("plan_id"), F.col("sample_type").alias("cell")).agg(F.sum("capacity").alias("capacity")).join(shares, "cell", "left").fillna(0.0, ["weight"])
    types = bounded_quota(types.select("plan_id", "cell", "weight", "capacity"), left).select(F.col("cell").alias("sample_type"), F.col("quota").alias("type_quota"))
    user = F.lit(1.0)
    if weights is not None:
        counts, user = counts.join(weights.select("dataset_id", F.col("weight").alias("user")), "dataset_id", "left"), F.coalesce("user", F.lit(1.0))
    cells = counts.join(types, "sample_type").select(F.col("sample_type").alias("plan_id"), F.col("dataset_id").alias("cell"), (user * F.sqrt("capacity")).alias("weight"), "capacity", "type_quota")
    quotas = bounded_quota(cells, F.col("type_quota")).select(F.col("plan_id").alias("sample_type"), F.col("cell").alias("dataset_id"), "quota")
    chosen = diverse_take(positives, quotas, ("sample_type", "dataset_id"), "source_sequence_id", "id", salt)
    return negatives.unionByName(chosen.select(rows.columns))


def expected_draws(rows: DataFrame, quotas: DataFrame, by: str, most_share: float | None = None) -> DataFrame:
    """Expected draws and their share of each value of `by`: rows (cell, weight), quotas (cell, quota).

    With most_share, a value with a larger share of all draws is marked in within_limit.
    """
    totals = rows.groupBy("cell").agg(F.sum("weight").alias("_t")).join(quotas, "cell").select("cell", (F.col("quota") / F.col("_t")).alias("_f"))
    drawn = rows.groupBy("cell", by).agg(F.sum("weight").alias("_w")).join(totals, "cell").groupBy(by).agg(F.sum(F.col("_w") * F.col("_f")).alias("expected"))
    drawn = drawn.withColumn("share", F.col("expected") / F.sum("expected").over(Window.partitionBy(F.lit(0))))  # a row per value
    return drawn if most_share is None else drawn.withColumn("within_limit", F.col("share") <= most_share + 1e-12)


def balanced_order(quotas: DataFrame, by: tuple[str, ...], order: tuple[str, ...] = ()) -> DataFrame:
    """(by, sample_type, quota) -> (by, position, sample_type): at each position the type furthest behind its share, of equals the first in
    the order of types given, then by name.

    Smooth weighted round robin: every type gains its quota at each step and the leading one pays their sum. The order repeats
    after the quotas over their greatest common divisor, so only one period is made in Python; groups run in parallel.
    """

    places = {name: k for k, name in enumerate(order)}

    def period(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells[cells["quota"] > 0].sort_values("sample_type", key=lambda names: names.map(lambda x: (places.get(x, len(places)), x)))
        if cells.empty:
            return pd.DataFrame(columns=[*by, "_times", "_order"])
        quota = cells["quota"].to_numpy("int64")
        times = int(np.gcd.reduce(quota))
        gain, standing, turns = quota // times, np.zeros(len(quota), "int64"), []
        for _ in range(int(gain.sum())):
            standing += gain
            turns.append(int(standing.argmax()))
            standing[turns[-1]] -= gain.sum()
        names = cells["sample_type"].to_numpy()
        return pd.DataFrame({**{c: [cells[c].iloc[0]] for c in by}, "_times": [times], "_order": [[names[k] for k in turns]]})

    types = ", ".join(f"`{c}` {quotas.schema[c].dataType.simpleString()}" for c in by)
    periods = quotas.groupBy(*by).applyInPandas(period, types + ", _times long, _order array<string>")
    turns = periods.select(*by, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)).alias("_turn"), "_order")
    return turns.select(*by, "_turn", F.size("_order").alias("_size"), F.posexplode("_order").alias("_at", "sample_type")).select(*by, (F.col("_turn") * F.col("_size") + F.col("_at")).alias("position"), "sample_type")


def draw_report(draws: DataFrame) -> DataFrame:
    """(batch, id) draws: all, distinct ids, and the most draws of one id."""
    return draws.groupBy("id").agg(F.count("*").alias("n")).agg(F.sum("n").alias("draws"), F.count("*").alias("unique_ids"), F.max("n").alias("most_repeats"))


def draws_per_batch(draws: DataFrame, tiers: list[str], types: list[str]) -> DataFrame:
    """(batch, tier, sample_type) draws -> a row per batch with the draws of each tier and each sample type, as columns of their names."""
    counts = [F.count_if(F.col("tier") == t).alias(t) for t in tiers] + [F.count_if(F.col("sample_type") == t).alias(t) for t in types]
    return draws.groupBy("batch").agg(F.count("*").alias("draws"), *counts)


def epoch_plan_check(plan: DataFrame, drawn: DataFrame, cell: tuple[str, ...]) -> DataFrame:
    """Cells whose drawn rows differ from the plan's quota, cells missing on either side included."""
    counts = drawn.groupBy(*cell).agg(F.count("*").alias("drawn"))
    joined = plan.select(*cell, F.col("quota").alias("planned")).join(counts, list(cell), "full_outer").fillna(0, ["planned", "drawn"])
    return joined.where("planned <> drawn")


def group_size_stats(rows: DataFrame, group: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Least, median, p90 and most rows of a group."""
    sizes = rows.groupBy(*by, group).agg(F.count("*").alias("n"))
    return sizes.groupBy(*by).agg(F.count("*").alias("groups"), F.min("n").alias("least"), F.percentile("n", F.lit(0.5)).alias("median"), F.percentile("n", F.lit(0.9)).alias("p90"), F.max("n").alias("most"))


def loss_mass(draws: DataFrame, tiers: list[str]) -> DataFrame:
    """(batch, tier, weight): each tier's mean share of a batch's weight."""
    sums = draws.groupBy("batch").pivot("tier", tiers).agg(F.sum("weight")).fillna(0.0, tiers)
    total = sum((F.col(f"`{t}`") for t in tiers[1:]), F.col(f"`{tiers[0]}`"))
    return sums.agg(*(F.avg(F.col(f"`{t}`") / total).alias(t) for t in tiers))


def round_budget(scores: DataFrame, recorded: DataFrame, budget: int) -> DataFrame:
    """The rows with the largest scores that fit into what earlier rounds left of a budget, none of theirs among them."""
    left = max(0, budget - recorded.select("id").distinct().count())
    return scores.join(recorded, "id", "left_anti").orderBy(F.col("score").desc(), "id").limit(left)


def budget_left(recorded: DataFrame, budget: int, id_col: str = "id") -> int:
    """What recorded rows leave of a budget; raises where they exceed it or an id is recorded twice."""
    found = recorded.agg(F.count("*").alias("n"), F.count_distinct(id_col).alias("ids")).first()
    if found["n"] != found["ids"]:
        raise ValueError("recorded ids must be unique")
    if found["n"] > budget:
        raise ValueError(f"{found['n']} recorded rows exceed the budget of {budget}")
    return budget - found["n"]
