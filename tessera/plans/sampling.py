"""Registered queries on quotas, selections, draws and stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins, quotas, scoring, selection
from ..operators.contracts import SAMPLE_TYPES
from . import adapters as A
from . import queries as _earlier  # noqa: F401  (its SQL is used here)
from .registry import SQL, query, rounded

#: A fixed order of types, in which equal shares are served.
_ORDER = ("type-2", "type-0", "type-3", "type-1")


def _level_sql(source: str, total: str, plan: str = "plan_id", name: str = "leveled") -> str:
    """The water level over cells with capacity and weight, as CTEs up to `name` (with quota)."""
    return f"""lv1 as (select *, weight <= 0 as bare, case when weight > 0 then weight else 1 end as w, ({total})::bigint as total, coalesce(sum(capacity) filter (weight > 0) over (partition by {plan}), 0) as weighted from {source}),
lv2 as (select *, least(case when bare then greatest(total - weighted, 0) else total end, sum(capacity) over (partition by {plan}, bare)) as pour from lv1),
lv3 as (select *, (pour - coalesce(sum(capacity) over (partition by {plan}, bare order by capacity / w, cell rows between unbounded preceding and 1 preceding), 0)) * w >= capacity * sum(w) over (partition by {plan}, bare order by capacity / w, cell rows between current row and unbounded following) as is_full from lv2),
lv4 as (select *, pour - coalesce(sum(capacity) filter (is_full) over (partition by {plan}, bare), 0) as rest, sum(case when is_full then 0 else w end) over (partition by {plan}, bare) as open_w from lv3),
lv5 as (select *, case when is_full or open_w = 0 then 0 else rest * w / open_w end as share from lv4),
{name} as (select *, case when is_full then capacity else floor(share)::bigint + (row_number() over (partition by {plan}, bare order by round(share - floor(share), 9) desc, cell) <= rest - sum(floor(share)) over (partition by {plan}, bare))::int end::bigint as quota from lv5)""".replace("lv", f"{name}_lv")


@query(f"""{A.with_sql('strata')}, n as (select 'all' as plan_id, dataset_id as cell, count(*) as n from strata group by 2), c as (select *, sqrt(n) as weight, least(n, (select count(*) from strata) // 8) as capacity from n),
{_level_sql('c', '(select count(*) from strata) // 2')} select cell as dataset_id, quota from leveled""")
def dataset_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows shared among datasets by the square root of their sizes, an eighth of all per dataset at most."""
    rows = A.strata_rows(spark, sf_dir)
    n = rows.count()
    return quotas.dataset_quotas(rows, n // 2, n // 8).select("dataset_id", "quota")


@query(f"""{A.with_sql('strata')}, c as (select tier as plan_id, dataset_id || sample_type as cell, case when dataset_id = 'ds-0' then 0 else 1 + (max(id) % 3) end::double as weight, count(*) as capacity from strata group by tier, dataset_id, sample_type),
{_level_sql('c', "case when plan_id = 'tier-0' then (select count(*) from strata) * 45 // 100 else (select count(*) from strata) // 10 end")} select plan_id, cell, quota from leveled""")
def bounded_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans with a total of their own; cells without weight get what the others can't hold."""
    rows = A.strata_rows(spark, sf_dir)
    n = rows.count()
    cells = rows.groupBy(F.col("tier").alias("plan_id"), "dataset_id", "sample_type").agg(F.count("*").alias("capacity"), F.max("id").alias("m"))
    weight = F.when(F.col("dataset_id") == "ds-0", 0.0).otherwise((1 + F.col("m") % 3).cast("double"))
    cells = cells.select("plan_id", F.concat("dataset_id", "sample_type").alias("cell"), weight.alias("weight"), "capacity")
    return quotas.bounded_quota(cells, F.when(F.col("plan_id") == "tier-0", n * 45 // 100).otherwise(n // 10)).select("plan_id", "cell", "quota")


@query(f"""{A.with_sql('strata')}, c as (select status, sample_type, count(*) as n from strata group by all), s as (select *, n * 50 // (sum(n) over (partition by status))::bigint as f, n * 50 % (sum(n) over (partition by status))::bigint as r from c)
select status, sample_type, n, (f + (row_number() over (partition by status order by r desc, list_position({list(_ORDER)}, sample_type)) <= 50 - sum(f) over (partition by status))::int)::bigint as quota from s""")
def proportional_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = A.strata_rows(spark, sf_dir).groupBy("status", "sample_type").agg(F.count("*").alias("n"))
    return quotas.bounded_proportional(cells, "sample_type", "n", 50, ("status",), _ORDER)


@query(f"""{A.with_sql('strata')}, n as (select dataset_id, count(*) as n from strata group by 1), lim as (select count(*) // 4 as least from strata),
o as (select *, row_number() over (order by sha256('hold' || chr(0) || dataset_id)) - 1 as k from n where n <= (select 2 * least from lim)),
m as (select mask, sum(n)::bigint as total from (select unnest(range(1, (1::bigint << (select count(*) from o)))) as mask), o where (mask >> k) & 1 = 1 group by mask),
best as (select mask from m, lim where total between least and 2 * least order by abs(total - (least + least // 10)), total < least + least // 10, mask limit 1)
select dataset_id, n from o, best where (mask >> k) & 1 = 1""")
def group_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole datasets that hold about 27.5 % of all rows. In the SQL a way is a bit mask in the order of digests: the smallest one opens its total first."""
    rows = A.strata_rows(spark, sf_dir)
    least = rows.count() // 4
    return quotas.group_holdout(rows, least, least + least // 10, 2 * least, salt="hold").select("dataset_id", "n")


@query(f"""{A.with_sql('strata')}, f(tier, fraction) as (values ('tier-0', 0.4::double), ('tier-1', 0.2::double), ('tier-9', 0.4::double)), p as (select tier, fraction / sum(fraction) over () as fraction from f where tier in (select tier from strata)),
q as (select tier, case when tier = 'tier-1' then 33 - floor(max(case when tier = 'tier-0' then fraction end) over () * 33 + 0.5) else floor(fraction * 33 + 0.5) end::bigint as tq from p),
c as (select tier, sample_type, count(*) as n from strata group by all), s as (select *, n * tq // (sum(n) over (partition by tier))::bigint as f, n * tq % (sum(n) over (partition by tier))::bigint as r from c join q using (tier))
select tier, sample_type, n, (f + (row_number() over (partition by tier order by r desc, list_position({list(_ORDER)}, sample_type)) <= tq - sum(f) over (partition by tier))::int)::bigint as quota from s""")
def tier_type_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of 33 rows by tier, the share of an absent tier redistributed, and by type inside a tier."""
    fractions = spark.createDataFrame([("tier-0", 0.4), ("tier-1", 0.2), ("tier-9", 0.4)], "tier string, fraction double")
    return quotas.tier_type_quota(A.strata_rows(spark, sf_dir), 33, fractions, _ORDER)


@query(f"""{A.with_sql('strata')}, s as (select sample_type as cell, max(weight) / sum(weight) as top, count(*) as n from strata group by 1), q as (select 'type-' || i as cell, i + 1 as quota from range(4) t(i)),
m as (select cell, quota, least((40 + 1e-12) / (top * quota), (0.5 + 1e-12) * n / quota) as most from s join q using (cell)) select least(floor(min(most)), (select count(*) from strata) * 10 // sum(quota))::bigint as batches, arg_min(cell, most) as tightest_cell from m""")
def epoch_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.strata_rows(spark, sf_dir).withColumnRenamed("sample_type", "cell")
    per_batch = spark.range(4).select(F.concat(F.lit("type-"), "id").alias("cell"), (F.col("id") + 1).alias("quota"))
    return quotas.auto_epoch_size(rows, per_batch, 40.0, 0.5, rows.count() * 10)


@query(f"""{A.with_sql('strata')}, h as (select *, weight * 0.55::double / count(*) over () as mix_weight, 'hard' as mix_role from strata where id % 5 = 0), b as (select *, weight * (1 - 0.55::double) / count(*) over () as mix_weight, 'replay' as mix_role from strata where id % 5 <> 0 and id % 2 = 0)
select mix_role, count(*) as n, round(sum(mix_weight), 4) as total from (select * from h union all select * from b) group by 1""")
def stage_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a finetuning stage: hard rows, and the even base rows that are not among them as replay."""
    rows = A.strata_rows(spark, sf_dir).withColumns({"roi_id": F.col("id"), "present": F.lit(True)})
    mixed = selection.stage_members("multi_finetune", rows.where("id % 2 = 0"), hard=rows.where("id % 5 = 0"), hard_fraction=0.55)
    return mixed.groupBy("mix_role").agg(F.count("*").alias("n"), F.round(F.sum("mix_weight"), 4).alias("total"))


def _cap_sql(types: list[str]) -> str:
    """Selected rows capped per dataset, then each short type refilled in turn."""
    best = "order by weight desc, id"
    ctes = [f"sel as (select *, row_number() over (partition by dataset_id {best}) as r from strata where id % 3 = 0), kept as (select * from sel where r <= cap()), short as (select sample_type, count(*) as n from sel where r > cap() group by 1), used_0 as (select id, dataset_id from kept)"]
    for k, t in enumerate(types):
        ctes.append(f"""open_{k} as (select p.id, p.weight, p.dataset_id, row_number() over (partition by p.dataset_id order by p.weight desc, p.id) as d, coalesce(u.n, 0) as n from strata p left join (select dataset_id, count(*) as n from used_{k} group by 1) u using (dataset_id) where p.id % 3 <> 0 and p.sample_type = '{t}'),
          take_{k} as (select id, dataset_id from (select *, row_number() over ({best}) as o from open_{k} where d + n <= cap()) where o <= coalesce((select n from short where sample_type = '{t}'), 0)), used_{k + 1} as (select * from used_{k} union all select * from take_{k})""")
    return ", ".join(ctes)


@query((f"{A.with_sql('strata')}, " + _cap_sql([f"type-{k}" for k in range(4)]) + " select id, dataset_id from used_4").replace("cap()", "((select count(*) from strata) // 22)"))
def cap_and_refill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows, a cap per dataset, what goes replaced by other rows of its type from datasets with room."""
    rows = A.strata_rows(spark, sf_dir)
    return quotas.cap_and_refill(rows.where("id % 3 = 0"), rows.where("id % 3 <> 0"), rows.count() // 22, "weight").select("id", "dataset_id")


def _diverse_sql(rows: str, strata: str, salt: str, score: str = "") -> str:
    best = f"{score} desc, " if score else ""
    return f"""keyed as (select *, sha256('{salt}' || chr(31) || id) as d from {rows}), firsts as (select *, row_number() over (partition by {strata}, source_sequence_id order by {best}d) as nth from keyed),
ranked as (select *, row_number() over (partition by {strata} order by (nth > 1)::int, {best}d) as rank from firsts)"""


@query(f"""{A.with_sql('strata')}, rows_ as (select *, id % 10 <> 0 as present from strata), neg as (select id, sample_type, dataset_id from rows_ where not present), pos as (select * from rows_ where present),
n as (select sample_type, dataset_id, count(*) as n from pos group by all), t as (select 'all' as plan_id, sample_type as cell, sum(n)::bigint as capacity, case sample_type when 'type-1' then 0.6 when 'type-3' then 0.2 else 0 end::double as weight from n group by 2),
{_level_sql('t', '(select count(*) from strata) // 2 - (select count(*) from neg)')}, tq as (select cell as sample_type, quota as tq from leveled),
c2 as (select sample_type as plan_id, dataset_id as cell, sqrt(n) as weight, n as capacity, tq from n join tq using (sample_type)), {_level_sql('c2', 'tq', name='of_type')},
{_diverse_sql('pos', 'sample_type, dataset_id', 'replay')} select id, sample_type, dataset_id from neg union all select id, sample_type, dataset_id from ranked join of_type on plan_id = sample_type and cell = dataset_id where rank <= quota""")
def replay_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of all rows: confirmed negatives, then positives by type and dataset."""
    rows = A.strata_rows(spark, sf_dir).withColumn("present", F.col("id") % 10 != 0)
    chosen = quotas.select_replay(rows, rows.count() // 2, F.col("id") % 10 == 0, fractions={"type-1": 0.6, "type-3": 0.2})
    return chosen.select("id", "sample_type", "dataset_id")


@query(f"""{A.with_sql('strata')}, free as (select * from strata where id % 7 <> 0 and id % 4 = 1 and id % 3 = 0), n as (select sample_type, dataset_id, count(*) as n from free group by all),
c2 as (select sample_type as plan_id, dataset_id as cell, sqrt(n) as weight, n as capacity from n), {_level_sql('c2', 'least((select count(*) from strata) // 20, (select count(*) from free))')},
{_diverse_sql('free', 'sample_type, dataset_id', 'removed')} select id, null as problem from ranked join leveled on plan_id = sample_type and cell = dataset_id where rank <= quota
union all select id, case when id % 4 <> 1 then 'not_removed' else 'not_in_catalog' end from strata where id % 4 <> 1 or id % 3 <> 0""")
def removed_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives from removal evidence that a catalog holds and no earlier batch has taken, and the evidence that can't be used."""
    rows = A.strata_rows(spark, sf_dir)
    evidence = rows.select("id", F.when(F.col("id") % 4 == 1, "negative_removed").otherwise("quarantine").alias("partition"))
    catalog = rows.where("id % 3 = 0").withColumn("tokens", F.array(F.concat(F.lit("p:"), "id")))
    occupied = rows.where("id % 7 = 0").select(F.concat(F.lit("p:"), "id").alias("token"))
    chosen, wrong = selection.select_removed(evidence, catalog, occupied, {f"type-{k}": 1.0 for k in range(4)}, rows.count() // 20, None, "removed")
    return chosen.select("id", F.lit(None).cast("string").alias("problem")).unionByName(wrong)


@query(f"""{A.with_sql('strata')} select id, weight as score from strata where id % 9 <> 0 order by weight desc, id limit greatest((select count(*) from strata) // 4 - (select count(*) from strata where id % 9 = 0), 0)""")
def round_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What earlier rounds left of a budget of a quarter of all rows, filled with the largest scores."""
    rows = A.strata_rows(spark, sf_dir)
    return quotas.round_budget(rows.select("id", F.col("weight").alias("score")), rows.where("id % 9 = 0").select("id"), rows.count() // 4)


def _round_sql(k: int) -> str:
    """Round k: ranks over the rows without a token of the ledger, quotas by type and dataset, the best of each sequence first."""
    rank = lambda v: f"((rank() over (order by {v})) - 1 + (count(*) over (partition by {v}) - 1) / 2) / greatest(1, count(*) over () - 1)"
    return f"""free_{k} as (select * from pool where token not in (select token from ledger_{k})), score_{k} as (select *, 1.0::double * {rank('mean_nme')} + 0.5::double * {rank('p90_nme')} as score from free_{k}),
n_{k} as (select sample_type, dataset_id, count(*) as n from free_{k} group by all), t_{k} as (select 'all' as plan_id, sample_type as cell, sum(n)::bigint as capacity, case sample_type when 'POS_RUNTIME' then 0.7 else 0.3 end::double as weight from n_{k} group by 2),
{_level_sql(f't_{k}', f'(select count(*) from lab) // 20 - (select count(*) from lab where v % 90 = {k})', name=f'types_{k}')}, tq_{k} as (select cell as sample_type, quota as tq from types_{k}),
c_{k} as (select sample_type as plan_id, dataset_id as cell, sqrt(n) as weight, n as capacity, tq from n_{k} join tq_{k} using (sample_type)), {_level_sql(f'c_{k}', 'tq', name=f'cells_{k}')},
keyed_{k} as (select *, sha256('rounds:r{k}' || chr(31) || roi_id) as d from score_{k}), firsts_{k} as (select *, row_number() over (partition by sample_type, dataset_id, source_sequence_id order by score desc, d) as nth from keyed_{k}),
chosen_{k} as (select r.* from (select *, row_number() over (partition by sample_type, dataset_id order by (nth > 1)::int, score desc, d) as rank from firsts_{k}) r join cells_{k} on plan_id = sample_type and cell = dataset_id where rank <= quota),
ledger_{k + 1} as (select token from ledger_{k} union select token from chosen_{k})"""


@query(f"""{A.with_sql('labels')}, lab as (select *, roi_id[5:]::bigint as v from labels), metrics as ({SQL['disagreement_metrics']}),
pool as (select roi_id, dataset_id, 's' || v // 6 as source_sequence_id, case when palm_valid then 'POS_RUNTIME' else 'POS_LOW_PALM' end as sample_type, 'raw:' || raw_image_id as token, mean_nme, p90_nme from lab join metrics using (roi_id)),
ledger_1 as (select distinct 'raw:' || raw_image_id as token from lab where v % 40 = 0), {', '.join(_round_sql(k) for k in (1, 2, 3))}
select roi_id, round_id, sample_type from (select *, 'r1' as round_id from chosen_1 union all select *, 'r2' from chosen_2 union all select *, 'r3' from chosen_3)""")
def disagreement_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds from one pool: rows on which a student disagrees most, none with an image of an earlier round or of a published row."""
    v = F.substring("roi_id", 5, 20).cast("long")
    labels = A.roi_labels(spark, sf_dir).withColumns({
        "v": v, "source_sequence_id": F.concat(F.lit("s"), F.floor(v / 6)), "sample_type": F.when(F.col("palm_valid"), SAMPLE_TYPES[0]).otherwise(SAMPLE_TYPES[1]), "tokens": F.array(F.concat(F.lit("raw:"), "raw_image_id")),
    })
    predictions = A.roi_predictions(spark, sf_dir).where("predicted is not null")
    teachers = labels.where("present").join(predictions.select("roi_id"), "roi_id", "left_semi").select("roi_id", "dataset_id", "sample_type", "source_sequence_id", "tokens", "points")
    predictions = predictions.join(teachers.select("roi_id"), "roi_id", "left_semi")
    ledger = labels.where("v % 40 = 0").select(F.explode("tokens").alias("token"), F.lit("published").alias("round_id")).distinct()
    budget, rounds = labels.count() // 20, []
    for k in (1, 2, 3):
        recorded = labels.where(v % 90 == k).select("roi_id")
        chosen, ledger = selection.disagreement_round(teachers, predictions, ledger, recorded, budget, f"r{k}", {SAMPLE_TYPES[0]: 0.7, SAMPLE_TYPES[1]: 0.3}, "rounds", {"mean_nme": 1.0, "p90_nme": 0.5})
        rounds.append(chosen.select("roi_id", "round_id", "sample_type"))
    return rounds[0].unionByName(rounds[1]).unionByName(rounds[2])


@query("""with e as (select vec_id as v, embedding[1]::double as x, embedding[2]::double as y from embeddings), m as (select regr_slope(y, x) as slope, regr_intercept(y, x) as intercept from e where v % 10 < 8)
select 'roi-' || v as roi_id, round(intercept + slope * x, 6) as score, round(y - (intercept + slope * x), 6) as residual from e, m""")
def scored_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line fitted on the training rows, as the model of a predictor that scores all rows in batches of 256."""
    e = F.col("embedding")
    rows = A.table(spark, sf_dir, "embeddings").select(F.concat(F.lit("roi-"), "vec_id").alias("roi_id"), "vec_id", e[0].cast("double").alias("x"), e[1].cast("double").alias("y"))
    model = rows.where("vec_id % 10 < 8").agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept")).first().asDict()  # one row
    predict = lambda m, batch: batch[["roi_id"]].assign(score=m["intercept"] + m["slope"] * batch["x"], residual=batch["y"] - m["intercept"] - m["slope"] * batch["x"])
    return rounded(scoring.score_rows(rows, predict, "roi_id string, score double, residual double", model, 256))


@query(f"""{A.with_sql('strata', recursive=True)}, q as (select tier, sample_type, count(*) // 100 + 1 as quota from strata group by all), t as (select tier, list(sample_type order by list_position({list(_ORDER)}, sample_type)) as names, list(quota order by list_position({list(_ORDER)}, sample_type)) as quota, sum(quota)::bigint as total from q group by 1),
o as (select tier, 0::bigint as position, list_transform(quota, lambda x: 0::bigint) as used, null::varchar as sample_type from t
  union all select o.tier, o.position + 1, list_transform(used, lambda u, i: u + (i = pick)::int), names[pick] from o, t, lateral (select list_position(d, list_max(d)) as pick from (select list_transform(quota, lambda x, i: case when used[i] < x then (o.position + 1) * x - used[i] * total end) as d)) where t.tier = o.tier and o.position < total)
select tier, position - 1 as position, sample_type from o where position > 0""")
def balanced_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of a plan's types: at each place the one furthest behind its share."""
    cells = A.strata_rows(spark, sf_dir).groupBy("tier", "sample_type").agg((F.floor(F.count("*") / 100) + 1).alias("quota"))
    return quotas.balanced_order(cells, ("tier",), _ORDER)


_DRAWS_SQL = "dr as (select id, tier, sample_type, weight, id % 8 as batch from strata union all select id, tier, sample_type, weight, id % 8 from strata where id % 6 = 0)"


def _draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.strata_rows(spark, sf_dir).withColumn("batch", F.col("id") % 8)
    return rows.union(rows.where("id % 6 = 0"))


@query(f"""{A.with_sql('strata')}, {_DRAWS_SQL} select batch, count(*) as draws, {', '.join(f"count(*) filter (tier = 'tier-{k}') as \"tier-{k}\"" for k in range(2))}, {', '.join(f"count(*) filter (sample_type = 'type-{k}') as \"type-{k}\"" for k in range(4))} from dr group by 1""")
def draws_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotas.draws_per_batch(_draws(spark, sf_dir), ["tier-0", "tier-1"], [f"type-{k}" for k in range(4)])


@query(f"""{A.with_sql('strata')}, {_DRAWS_SQL}, s as (select batch, sum(weight) filter (tier = 'tier-0') as a, sum(weight) filter (tier = 'tier-1') as b from dr group by 1), n as (select id, count(*) as n from dr group by 1)
select (select sum(n)::bigint from n) as draws, (select count(*) from n) as unique_ids, (select max(n) from n) as most_repeats, round(avg(coalesce(a, 0) / (coalesce(a, 0) + coalesce(b, 0))), 6) as "tier-0", round(avg(coalesce(b, 0) / (coalesce(a, 0) + coalesce(b, 0))), 6) as "tier-1" from s""")
def draw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = _draws(spark, sf_dir)
    return rounded(quotas.draw_report(draws).crossJoin(quotas.loss_mass(draws, ["tier-0", "tier-1"])))  # a row each


@query(f"""{A.with_sql('strata')}, p as (select tier, sample_type, count(*) as planned from strata where sample_type <> 'type-3' group by all), d as (select tier, sample_type, count(*) as drawn from strata where id % 11 <> 0 or sample_type = 'type-0' group by all)
select tier, sample_type, coalesce(planned, 0) as planned, coalesce(drawn, 0) as drawn from p full outer join d using (tier, sample_type) where planned is distinct from drawn""")
def epoch_plan_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan that lacks a type against draws that lack some rows."""
    rows = A.strata_rows(spark, sf_dir)
    plan = rows.where("sample_type <> 'type-3'").groupBy("tier", "sample_type").agg(F.count("*").alias("quota"))
    return quotas.epoch_plan_check(plan, rows.where("id % 11 <> 0 or sample_type = 'type-0'"), ("tier", "sample_type"))


_SMOKE = {"gold_positive": 8, "pseudo_positive": 8, "gold_negative": 40, "pseudo_neg_runtime": 4, "pseudo_neg_low": 4}


@query(f"""{A.with_sql('labels', 'published')}, r as (select v as id, present, handedness, 's' || v // 4 as source_sequence_id, case when v % 3 = 0 or (not present and v % 45 = 5) then case when present then 'gold_positive' else 'gold_negative' end when present then 'pseudo_positive' when palm_valid then 'pseudo_neg_runtime' else 'pseudo_neg_low' end as category from published),
{_diverse_sql('r', 'category', 'smoke')}, have as (select count(*) as n from r where category = 'gold_negative'),
want(category, quota) as (select 'gold_positive', 8::bigint union all select 'pseudo_positive', 8 union all select 'gold_negative', least(40, n) from have union all select 'pseudo_neg_runtime', 4 + greatest(40 - n, 0) from have union all select 'pseudo_neg_low', 4),
chosen as (select * from ranked join want using (category) where rank <= quota), hands as (select distinct lower(handedness) as hand from ranked where category in ('gold_positive', 'pseudo_positive')),
missing as (select hand from hands where hand not in (select lower(handedness) from chosen where category in ('gold_positive', 'pseudo_positive'))),
forced as (select r.id, r.category, hand from missing join (select *, row_number() over (partition by lower(handedness) order by category, rank) as nth from ranked where category in ('gold_positive', 'pseudo_positive')) r on lower(r.handedness) = hand and nth = 1),
slots as (select f.id, f.category, quota + 1 - row_number() over (partition by f.category order by hand) as rank from forced f join want using (category))
select id, category, handedness from chosen where (category, rank) not in (select category, rank from slots) union all select r.id, r.category, r.handedness from ranked r join slots s using (id)""")
def smoke_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small set by category; what gold negatives lack goes to pseudo negatives at runtime, and each known hand is in it."""
    rows = A.published(spark, sf_dir).withColumn("id", F.col("v"))
    positive = F.col("present")
    gold = (F.col("v") % 3 == 0) | (~positive & (F.col("v") % 45 == 5))
    category = F.when(gold, F.when(positive, "gold_positive").otherwise("gold_negative")).when(positive, "pseudo_positive").when(F.col("proposal_kind") == "runtime", "pseudo_neg_runtime").otherwise("pseudo_neg_low")
    rows = rows.select("id", "present", "handedness", category.alias("category"), F.concat(F.lit("s"), F.floor(F.col("v") / 4)).alias("source_sequence_id"))
    return selection.smoke_set(rows, _SMOKE, "smoke").select("id", "category", "handedness")


@query(f"""{A.with_sql('labels')}, r as (select roi_id, present, palm_valid, roi_id[5:]::bigint as v from labels), b as (select * from r where present), h as (select * from b where v % 5 = 1 or v % 7 = 3)
select 'geometry' as stage, roi_id, null as mix_role from b union all select 'multitask', roi_id, null from b union all select 'multitask', roi_id, null from r where not present and palm_valid
union all select 'multi_finetune', roi_id, 'hard' from h union all select 'multi_finetune', roi_id, 'hard' from r where not present and palm_valid union all select 'multi_finetune', roi_id, 'replay' from b where roi_id not in (select roi_id from h)""")
def stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members of the three training stages."""
    rows = A.roi_labels(spark, sf_dir).select("roi_id", "present", "palm_valid", F.substring("roi_id", 5, 20).cast("long").alias("v"), F.lit(1.0).alias("weight"))
    base, negatives, hard = rows.where("present"), rows.where("not present and palm_valid"), rows.where("present and (v % 5 = 1 or v % 7 = 3)")
    stages = {"geometry": selection.stage_members("geometry", base), "multitask": selection.stage_members("multitask", base, negatives), "multi_finetune": selection.stage_members("multi_finetune", base, negatives, hard)}
    role = lambda df: F.col("mix_role") if "mix_role" in df.columns else F.lit(None).cast("string")
    made = [df.select(F.lit(name).alias("stage"), "roi_id", role(df).alias("mix_role")) for name, df in stages.items()]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query(f"""{A.with_sql('assets')} select id, split from assets where id % 3 > 0""")
def replay_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = A.asset_rows(spark, sf_dir)
    return joins.exclude_replay(assets, assets.where("id % 3 = 0").select("id"), "id").select("id", "split")
