"""Selections for review and the members of training stages, made of quotas, ranks and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import salted_digest
from .joins import coverage_problems, exclude_occupied, exclude_replay, require_empty
from .mining import disagreement_score
from .lineage import written
from .quotas import bounded_quota, budget_left, cap_and_refill, mix_weights
from .ranks import diverse_keys, diverse_take
from .sets import union_all


def select(rows: DataFrame, occupied: DataFrame, fractions: dict[str, float], n: int, per_dataset: int | None, salt: str, score: str | None = None, id_col: str = "id") -> DataFrame:
    """n rows (id, dataset_id, sample_type, source_sequence_id, tokens) none of whose tokens is occupied.

    Types share n by their fractions, a type's datasets by the square root of their rows; what a type or dataset lacks goes to
    the others. In a dataset one row of each sequence comes first, the best by score. With a cap per dataset over all types,
    rows above it are replaced by others of their type where there is room.
    """
    free = exclude_occupied(rows, occupied, id_col)
    counts = free.groupBy("sample_type", "dataset_id").agg(F.count("*").alias("n"))
    weights = rows.sparkSession.createDataFrame([(k, float(v)) for k, v in fractions.items()], "cell string, weight double")
    types = counts.groupBy(F.col("sample_type").alias("cell")).agg(F.sum("n").alias("capacity")).join(weights, "cell", "left").fillna(0.0, ["weight"])
    types = bounded_quota(types.select(F.lit("all").alias("plan_id"), "cell", "weight", "capacity"), n).select(F.col("cell").alias("sample_type"), F.col("quota").alias("type_quota"))
    capacity = F.least("n", F.lit(per_dataset)) if per_dataset is not None else F.col("n")
    cells = counts.join(types, "sample_type").select(F.col("sample_type").alias("plan_id"), F.col("dataset_id").alias("cell"), F.sqrt("n").alias("weight"), capacity.alias("capacity"), "type_quota")
    quotas = bounded_quota(cells, F.col("type_quota")).select(F.col("plan_id").alias("sample_type"), F.col("cell").alias("dataset_id"), "quota")
    chosen = diverse_take(free, quotas, ("sample_type", "dataset_id"), "source_sequence_id", id_col, salt, score).select(rows.columns)
    if per_dataset is None:
        return chosen
    keyed = lambda df: df.withColumn("_score", F.coalesce(F.col(score), F.lit(0.0)) if score else F.lit(0.0))
    return cap_and_refill(keyed(chosen), keyed(free), per_dataset, "_score", id_col).drop("_score")


def select_removed(evidence: DataFrame, catalog: DataFrame, occupied: DataFrame, fractions: dict[str, float], n: int, per_dataset: int | None, salt: str, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Hard negatives from removal evidence (id, partition) that the catalog holds, and the evidence that can't be used: id, problem."""
    known = evidence.join(catalog.select(id_col, F.lit(True).alias("_known")), id_col, "left")
    problem = F.when(F.col("partition") != "negative_removed", "not_removed").when(F.col("_known").isNull(), "not_in_catalog")
    wrong = known.select(id_col, problem.alias("problem")).where("problem is not null")
    held = catalog.join(evidence.where("partition = 'negative_removed'").select(id_col).distinct(), id_col, "left_semi")
    chosen = select(held, occupied, fractions, n, per_dataset, salt, id_col=id_col)
    return chosen.withColumn("tie_break", salted_digest(salt, F.col(id_col))), wrong


def select_disagreement(teachers: DataFrame, predictions: DataFrame, occupied: DataFrame, fractions: dict[str, float], n: int, per_dataset: int | None, salt: str, weights: dict[str, float] | None = None, id_col: str = "roi_id") -> DataFrame:
    """The teacher's positives on which a student disagrees most; predictions (id, predicted, hand_flag) must cover them exactly."""
    require_empty(coverage_problems(teachers, predictions, id_col), "prediction coverage")
    free = exclude_occupied(teachers, occupied, id_col).where(F.col("sample_type").isin(list(fractions)))
    scored = written(disagreement_score(free.join(predictions.select(id_col, "predicted", "hand_flag"), id_col), weights, id_col), "disagreement")
    chosen = select(scored, occupied, fractions, n, per_dataset, salt, "disagreement", id_col)
    return chosen.withColumn("tie_break", salted_digest(salt, F.col(id_col)))


def disagreement_round(teachers: DataFrame, predictions: DataFrame, ledger: DataFrame, recorded: DataFrame, budget: int, round_id: str, fractions: dict[str, float], salt: str, weights: dict[str, float] | None = None, id_col: str = "roi_id") -> tuple[DataFrame, DataFrame]:
    """The next round of disagreements, and the ledger with its identity tokens.

    ledger: (token, round_id) of all that earlier rounds and published batches hold; a row that shares a token with it can't be
    chosen, and the pool is ranked anew without such rows. What newly recorded rows (id) leave of the budget is the round's
    size, the round's name salts its draw. A round that the ledger has, and recorded rows above the budget, raise. Rows and ledger are
    written, so that later rounds don't work out earlier ones again.
    """
    if not ledger.where(F.col("round_id") == round_id).isEmpty():
        raise ValueError(f"round {round_id} is in the ledger")
    left = budget_left(recorded, budget, id_col)
    chosen = select_disagreement(teachers, predictions, ledger, fractions, left, None, f"{salt}:{round_id}", weights, id_col)
    chosen = written(chosen.withColumn("round_id", F.lit(round_id)), "round")
    tokens = chosen.select(F.explode("tokens").alias("token"), "round_id").distinct()
    return chosen, written(ledger.select("token", "round_id").unionByName(tokens), "ledger")


def stage_members(stage: str, base: DataFrame, negatives: DataFrame | None = None, hard: DataFrame | None = None, hard_fraction: float = 0.55, id_col: str = "roi_id") -> DataFrame:
    """The rows of a training stage: geometry (positives only), multitask (positives and negatives) or multi_finetune (hard rows
    and the base rows that they don't hold, as replay, with mix_weight). Raises where a stage's rule is broken."""
    require_empty(base.where("not coalesce(present, false)").select(id_col), "base rows must be positives")
    if stage == "geometry":
        if negatives is not None:
            raise ValueError("geometry takes no negatives")
        return base
    if stage == "multitask":
        if negatives is None or negatives.isEmpty():
            raise ValueError("multitask needs negatives")
        return union_all(base, negatives)
    if stage != "multi_finetune":
        raise ValueError(f"unknown stage {stage}")
    if not 0 < hard_fraction < 1:
        raise ValueError("hard and replay fractions must be positive and add up to 1")
    parts = [t for t in (hard, negatives) if t is not None]
    if hard is None or hard.isEmpty():
        raise ValueError("multi_finetune needs hard rows")
    chosen = union_all(*parts)
    replay = exclude_replay(base, chosen.select(id_col), id_col)
    if replay.isEmpty():
        raise ValueError("no base row is left for replay")
    return mix_weights(chosen, replay, hard_fraction)


def smoke_set(rows: DataFrame, quotas: dict[str, int], salt: str, id_col: str = "id") -> DataFrame:
    """A small fixed set by category (rows come with `category`): what gold negatives lack goes to pseudo negatives at runtime, and each known hand is in it.

    A hand that no chosen positive has replaces the last row of the first positive category that can give one.
    """
    spark = rows.sparkSession
    held = rows.where(F.col("category").isin(list(quotas)))
    have = {r["category"]: r["n"] for r in held.groupBy("category").agg(F.count("*").alias("n")).collect()}  # a row per category
    wanted = dict(quotas)
    short = max(0, wanted.get("gold_negative", 0) - have.get("gold_negative", 0))
    wanted["gold_negative"] = wanted.get("gold_negative", 0) - short
    if short:
        wanted["pseudo_neg_runtime"] = wanted.get("pseudo_neg_runtime", 0) + short
    table = spark.createDataFrame([(k, v) for k, v in wanted.items() if v > 0], "category string, quota long")
    chosen = written(diverse_take(held, table, ("category",), "source_sequence_id", id_col, salt), "smoke")
    hand = F.lower("handedness")
    positive = F.col("category").isin("gold_positive", "pseudo_positive")
    known = held.where(positive & hand.isin("left", "right", "unknown")).select(id_col, hand.alias("hand"))
    missing = known.select("hand").distinct().join(chosen.where(positive).select(hand.alias("hand")).distinct(), "hand", "left_anti")
    keys = diverse_keys(held.where(positive), ("category",), "source_sequence_id", id_col, salt).join(known.join(missing, "hand"), id_col)
    forced = keys.groupBy("hand").agg(F.min(F.struct("category", "_n", "_s", "_d", F.col(id_col).alias("_id"))).alias("_k")).select("hand", "_k.category", F.col("_k._id").alias(id_col))  # a row per hand
    forced = forced.withColumn("_slot", F.row_number().over(Window.partitionBy("category").orderBy("hand"))).join(table, "category")
    out = chosen.join(forced.select("category", (F.col("quota") + 1 - F.col("_slot")).alias("rank")), ["category", "rank"], "left_anti")
    return out.select(rows.columns).unionByName(held.join(forced.select(id_col), id_col).select(rows.columns))
