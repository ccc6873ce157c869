"""The registered queries of the library, over the driver's tables, with equal SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import points as P
from ..functions import text as X
from ..operators import contracts, detections, joins, metrics, mining, quotas, ranks, telemetry
from . import adapters as A
from .registry import SQL, query, rounded

CORE = [0, 5, 9, 13, 17]


def measured(spark: SparkSession, sf_dir: str, run: str = "candidate") -> DataFrame:
    labels = A.roi_labels(spark, sf_dir)
    return metrics.row_measures(joins.coverage_join(labels, A.roi_predictions(spark, sf_dir, run), "roi_id"))


def _measured_sql(run: str = "candidate", name: str = "m") -> str:
    """Row measures; x and y of points and predictions are compared pointwise."""
    return f"""{name}_0 as (
      select l.*, p.predicted, p.hand_flag, p.handedness_score,
        case when present then list_transform(range(1, 22), lambda i: 255.0 * sqrt(pow(predicted[i].x - points[i].x, 2) + pow(predicted[i].y - points[i].y, 2))) end as err,
        greatest(255.0 * sqrt(pow(list_max(list_transform(points, lambda q: q.x)) - list_min(list_transform(points, lambda q: q.x)), 2) + pow(list_max(list_transform(points, lambda q: q.y)) - list_min(list_transform(points, lambda q: q.y)), 2)), 1e-6) as diagonal_px,
        sqrt(pow(list_max(list_transform(predicted, lambda q: q.x)) - list_min(list_transform(predicted, lambda q: q.x)), 2) + pow(list_max(list_transform(predicted, lambda q: q.y)) - list_min(list_transform(predicted, lambda q: q.y)), 2)) as own_spread
      from labels l join {run} p using (roi_id)
    ), {name} as (
      select * exclude (err), case when predicted is not null then err end as errors_px, case when predicted is not null then list_sum(err) / 21 end as error_px,
        case when predicted is not null then list_sum(err) / 21 / diagonal_px end as nme,
        hand_flag >= 0.5 as predicted_present, case when handedness_score >= 0.5 then 'Right' else 'Left' end as predicted_handedness,
        coalesce(own_spread * 255 < 0.05 * sqrt(2 * 255.0 * 255.0), false) as collapsed
      from {name}_0
    )"""


def _confusion_sql(t: str, p: str) -> str:
    tp, fp, tn, fn = (f"count(*) filter ({c})" for c in (f"{t} and {p}", f"not {t} and {p}", f"not {t} and not {p}", f"{t} and not {p}"))
    pr, re = f"coalesce({tp} / nullif({tp} + {fp}, 0), 0.0)", f"coalesce({tp} / nullif({tp} + {fn}, 0), 0.0)"
    return f"""{tp} as tp, {fp} as fp, {tn} as tn, {fn} as fn, round(coalesce(({tp} + {tn}) / nullif(count(*), 0), 0.0), 6) as accuracy, round({pr}, 6) as precision, round({re}, 6) as recall,
      round(coalesce(2 * {pr} * {re} / nullif({pr} + {re}, 0), 0.0), 6) as f1, round(coalesce({fp} / nullif({fp} + {tn}, 0), 0.0), 6) as fpr, round(coalesce({fn} / nullif({fn} + {tp}, 0), 0.0), 6) as fnr"""


_PCK_SQL = ", ".join(f"round(coalesce(sum(case when present and predicted is not null then len(list_filter(errors_px, lambda e: e <= diagonal_px * {t})) end) / nullif(count(*) filter (present) * 21, 0), 0.0), 6) as pck_{round(100 * t):03d}" for t in metrics.PCK)
_LANDMARK_SQL = f"""count(*) filter (present) as gt_positive, count(error_px) as n_predicted, round(coalesce(count(error_px) / nullif(count(*) filter (present), 0), 0.0), 6) as coverage, round(avg(error_px), 6) as mean_px,
      round(quantile_cont(error_px, 0.5), 6) as median_px, round(quantile_cont(error_px, 0.9), 6) as p90_px, round(quantile_cont(error_px, 0.95), 6) as p95_px, round(avg(nme), 6) as mean_nme, round(quantile_cont(nme, 0.5), 6) as median_nme, {_PCK_SQL}"""
_K, _R, _S = "(present and handedness in ('Left', 'Right'))", "(handedness = 'Right')", "(predicted_handedness = 'Right')"
_HAND_SQL = f"""count(*) filter {_K} as hand_eligible, count(*) filter (present and handedness not in ('Left', 'Right')) as hand_excluded,
      round(coalesce(count(*) filter ({_K} and {_R} = {_S}) / nullif(count(*) filter {_K}, 0), 0.0), 6) as hand_accuracy,
      round(coalesce(count(*) filter ({_K} and not {_R} and not {_S}) / nullif(count(*) filter ({_K} and not {_R}), 0), 0.0), 6) as left_recall,
      round(coalesce(count(*) filter ({_K} and {_R} and {_S}) / nullif(count(*) filter ({_K} and {_R}), 0), 0.0), 6) as right_recall"""
_COLLAPSE_SQL = "count(*) filter (present and collapsed) as collapse_count, round(coalesce(count(*) filter (present and collapsed) / nullif(count(*) filter (present), 0), 0.0), 6) as collapse_rate"
_DIMS = metrics.DIMENSIONS
_DIM_SQL = "case " + " ".join(f"when grouping({d}) = 0 then '{d}'" for d in _DIMS) + " else 'all' end as dimension, case " + " ".join(f"when grouping({d}) = 0 then {d}" for d in _DIMS) + " else 'all' end as value"


@query(f"""{A.with_sql('labels', 'candidate')}, {_measured_sql()}
select {_DIM_SQL}, count(*) as n, {_confusion_sql('present', 'predicted_present')}, {_LANDMARK_SQL}, {_HAND_SQL}, {_COLLAPSE_SQL}
from m group by grouping sets ((), {', '.join(f'({d})' for d in _DIMS)})""")
def eval_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.grouped_report(measured(spark, sf_dir)))


@query(f"""{A.with_sql('labels', 'candidate')}, {_measured_sql()}, t as (select unnest([0.1, 0.25, 0.5, 0.75, 0.9]) as threshold)
select threshold::double as threshold, tp, fp, tn, fn, round(p, 6) as precision, round(r, 6) as recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0.0), 6) as f1 from (
  select *, coalesce(tp / nullif(tp + fp, 0), 0.0) as p, coalesce(tp / nullif(tp + fn, 0), 0.0) as r from (
    select threshold, count(*) filter (present and hand_flag >= threshold) as tp, count(*) filter (not present and hand_flag >= threshold) as fp,
      count(*) filter (not present and hand_flag < threshold) as tn, count(*) filter (present and hand_flag < threshold) as fn from m, t group by 1))""")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.threshold_sweep(measured(spark, sf_dir), "present", "hand_flag", [0.1, 0.25, 0.5, 0.75, 0.9]))


@query(f"""{A.with_sql('labels', 'candidate')}, {_measured_sql()}
select i::integer as landmark_id, count(*) as n, round(avg(errors_px[i + 1]), 6) as mean_px from m, range(21) t(i) where errors_px is not null group by i""")
def per_landmark_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.per_landmark_error(measured(spark, sf_dir)))


_SCORED_SQL = """scored as (
  select *, list_sum(unit) / 21 * 255 as error_px2, 1 - hand_flag as presence_error, handedness in ('Left', 'Right') as hand_known,
    case when handedness = 'Right' then 1 - handedness_score when handedness = 'Left' then handedness_score else 0 end as handedness_error,
    (own_spread < 0.05 or hand_flag < 0.5) as collapse
  from (select *, list_transform(errors_px, lambda v: v / 255) as unit from m where present and predicted is not null and split = 'train')
), ranked as (
  select *, round(error_px2, 9) as er, count(*) over () as nn, rank() over (order by round(error_px2, 9)) as rk, count(*) over (partition by round(error_px2, 9)) as ties from scored
), difficult as (select *, (rk - 1 + (ties - 1) / 2) / greatest(1, nn - 1) as error_rank from ranked)"""


def difficult(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mining.score_rows(joins.coverage_join(A.roi_labels(spark, sf_dir), A.roi_predictions(spark, sf_dir), "roi_id"))
    return mining.difficulty(rows.withColumn("error_px", F.round("error_px", 9)))


@query(f"""{A.with_sql('labels', 'candidate')}, {_measured_sql()}, {_SCORED_SQL}
select roi_id, round(error_rank, 6) as error_rank, round(0.8 * error_rank + 0.1 * presence_error + 0.1 * handedness_error, 6) as difficulty, round(er, 6) as error_px, 1 as round_id
from difficult where roi_id not in (select roi_id from difficult where er > 25 and roi_id like '%0')
order by round(0.8 * error_rank + 0.1 * presence_error + 0.1 * handedness_error, 9) desc, er desc, roi_id limit 50""")
def hard_mining_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second round of mining; the first took the ids that end in 0 with a large error."""
    rows = difficult(spark, sf_dir).withColumn("difficulty", F.round("difficulty", 9))
    ledger = rows.where("error_px > 25 and roi_id like '%0'").select("roi_id", F.lit(0).alias("round_id"))
    return rounded(mining.mine_round(rows, ledger, 50, 1).select("roi_id", "error_rank", "difficulty", "error_px", "round_id"))


@query(f"""{A.with_sql('labels', 'candidate')}, {_measured_sql()}, {_SCORED_SQL}, d as (select *, 0.8 * error_rank + 0.1 * presence_error + 0.1 * handedness_error as difficulty from difficult)
select *, row_number() over (order by p90_difficulty desc, p90_px desc, capture_source_id)::integer as source_rank from (
select capture_source_id, count(*) as n, round(avg(er), 6) as mean_px, round(quantile_cont(er, 0.5), 6) as median_px, round(quantile_cont(er, 0.9), 6) as p90_px,
  round(avg(len(list_filter(unit, lambda v: v <= 0.05)) / 21), 6) as pck_005, round(avg(len(list_filter(unit, lambda v: v <= 0.10)) / 21), 6) as pck_010, round(avg(collapse::integer), 6) as collapse_rate,
  round(avg(difficulty), 6) as mean_difficulty, round(quantile_cont(difficulty, 0.9), 6) as p90_difficulty, round(avg((hand_flag < 0.5)::integer), 6) as presence_error_rate,
  round(coalesce(count(*) filter (hand_known and handedness_error > 0.5) / nullif(count(*) filter (hand_known), 0), 0.0), 6) as handedness_error_rate, round(avg(diagonal_px / 255), 6) as mean_pose_span,
  round(quantile_cont(diagonal_px / 255, 0.5), 6) as median_pose_span, arg_min(distance, roi_id) as distance, arg_min(lighting, roi_id) as lighting, count(*) filter (roi_id not like '%0') as eligible
from d group by 1)""")
def hard_source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = difficult(spark, sf_dir).withColumn("fresh", ~F.col("roi_id").endswith("0"))
    report = rounded(mining.source_report(rows, eligible="fresh").drop("source_rank"))
    order = Window.orderBy(F.col("p90_difficulty").desc(), F.col("p90_px").desc(), "capture_source_id")  # a row per source
    return report.withColumn("source_rank", F.row_number().over(order))


@query(f"""{A.with_sql('labels')}
select 'capture_splits' as "check", capture_source_id as key, array_to_string(list_sort(list(distinct split)), ',') as detail from labels group by 2 having count(distinct split) > 1
union all select 'raw_image_splits', raw_image_id, array_to_string(list_sort(list(distinct split)), ',') from labels group by 2 having count(distinct split) > 1
union all select 'capture_variants', capture_source_id, array_to_string(list_sort(list(distinct proposal_variant)), ',') from labels group by 2 having count(distinct proposal_variant) > 1
union all select 'performer_splits_warning', split_part(capture_source_id, '-', 7), array_to_string(list_sort(list(distinct split)), ',') from labels group by 2 having count(distinct split) > 1""")
def membership_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.membership_violations(A.roi_labels(spark, sf_dir))


@query(f"""{A.with_sql('assets')}, c as (select split, digest, count(*) as n from assets group by all)
select 'exact' as kind, a.split as left_set, b.split as right_set, count(*) as n_tokens, sum(a.n + b.n)::bigint as n_rows from c a join c b on a.digest = b.digest and a.split < b.split group by all""")
def leakage_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.leakage_pairs(A.asset_rows(spark, sf_dir), "split", "digest")


@query(f"""{A.with_sql('assets')} select digest, count(*) as n, min(id) as first, max(id) as last from assets group by 1 having count(*) > 1""")
def duplicate_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.duplicate_content(A.asset_rows(spark, sf_dir), "digest", "id")


_SAMPLE_N = 500


@query(f"""{A.with_sql('strata')}, c as (select status, priority, count(*) as n from strata group by all),
s as (select *, n * {_SAMPLE_N} // (sum(n) over ())::bigint as f, (n * {_SAMPLE_N}) % (sum(n) over ())::bigint as rem from c),
q as (select status, priority, f + (row_number() over (order by rem desc, status || chr(31) || priority) <= {_SAMPLE_N} - sum(f) over ())::integer as quota from s),
r as (select *, row_number() over (partition by status, priority order by sha256('sample' || chr(31) || id), id) as rank from strata)
select id, status, priority, rank::integer as rank from r join q using (status, priority) where rank <= quota""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotas.stratified_sample(A.strata_rows(spark, sf_dir), ("status", "priority"), "id", _SAMPLE_N, "sample").select("id", "status", "priority", "rank")


@query(f"""{A.with_sql('strata')}, n as (select dataset_id, role, count(*) as n from strata group by all), b as (select *, sqrt(n) / sum(sqrt(n)) over (partition by role) as base from n),
t(role, target) as (values ('role-0', 0.6), ('role-1', 0.2), ('role-2', 0.2)), e as (select role, target / sum(target) over () as target from t where role in (select role from n)),
c as (select distinct sample_type, s.dataset_id, s.role, base, target from strata s join b using (dataset_id, role) join e using (role)),
rc as (select sample_type, role, target / sum(target) over (partition by sample_type) as share from (select distinct sample_type, role, target from c)),
d as (select sample_type, dataset_id, rc.share * base / sum(base) over (partition by sample_type, role) as share from c join rc using (sample_type, role)),
q as (select sample_type, dataset_id, source_sequence_id, count(*) as k from strata group by all), qs as (select sample_type, dataset_id, count(*) as s from q group by all)
select id, round(share / s / k, 9) as sampling_weight from strata join q using (sample_type, dataset_id, source_sequence_id) join qs using (sample_type, dataset_id) join d using (sample_type, dataset_id)""")
def hierarchical_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles = spark.createDataFrame([("role-0", 0.6), ("role-1", 0.2), ("role-2", 0.2)], "role string, target double")
    return rounded(ranks.hierarchical_weights(A.strata_rows(spark, sf_dir), roles).select("id", "sampling_weight"), 9)


def _draw_cells(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = A.strata_rows(spark, sf_dir)
    cells = rows.groupBy("tier", "sample_type").agg(F.count("*").alias("n"))
    return rows, quotas.largest_remainder(cells, "sample_type", "n", F.lit(400), ("tier",))


@query(f"""{A.with_sql('strata')}, c as (select tier, sample_type, count(*) as n from strata group by all),
s as (select *, n * 400 // (sum(n) over (partition by tier))::bigint as f, (n * 400) % (sum(n) over (partition by tier))::bigint as rem from c)
select tier, sample_type, n, (f + (row_number() over (partition by tier order by rem desc, sample_type) <= 400 - sum(f) over (partition by tier))::integer)::bigint as quota from s""")
def tier_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _draw_cells(spark, sf_dir)[1].select("tier", "sample_type", "n", "quota")


@query(f"""{A.with_sql('strata')}, c as (select tier, sample_type, count(*) as n from strata group by all),
s as (select *, n * 400 // (sum(n) over (partition by tier))::bigint as f, (n * 400) % (sum(n) over (partition by tier))::bigint as rem from c),
q as (select tier, sample_type, (f + (row_number() over (partition by tier order by rem desc, sample_type) <= 400 - sum(f) over (partition by tier))::integer)::bigint as quota from s),
p as (select *, ('0x' || substr(sha256(id::varchar), 1, 8))::bigint % ceil(count(*) over (partition by tier, sample_type) / 65536)::bigint as part from strata),
o as (select tier, sample_type, id, sum(weight) over w / sum(weight) over (partition by tier, sample_type) as hi, (sum(weight) over w - weight) / sum(weight) over (partition by tier, sample_type) as lo from p window w as (partition by tier, sample_type order by part, id)),
d as (select tier, sample_type, slot, ('0x' || substr(sha256('7' || chr(31) || '3' || chr(31) || tier || chr(31) || sample_type || chr(31) || slot), 1, 12))::bigint / 281474976710656.0 as u from q, unnest(range(1, quota + 1)) t(slot))
select d.tier, d.sample_type, slot, u, id from d join o on d.tier = o.tier and d.sample_type = o.sample_type and u >= lo and u < hi""")
def weighted_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cells = _draw_cells(spark, sf_dir)
    return quotas.weighted_draws(rows, cells, ("tier", "sample_type"), seed=7, epoch=3)


@query(f"""{A.with_sql('strata')}, k as (select *, sha256('diverse' || chr(31) || id) as d from strata), g as (select *, row_number() over (partition by dataset_id, source_sequence_id order by weight desc, d) as n from k),
r as (select *, row_number() over (partition by dataset_id order by (n > 1)::integer, weight desc, d)::integer as rank from g)
select id, dataset_id, rank from r where rank <= 25""")
def diverse_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranks.diverse_rank(A.strata_rows(spark, sf_dir), ("dataset_id",), "source_sequence_id", "id", "diverse", "weight")
    return ranked.where("rank <= 25").select("id", "dataset_id", "rank")


@query(f"""{A.with_sql('strata')} select id, round(((rank() over (partition by status order by weight)) - 1 + (count(*) over (partition by status, weight) - 1) / 2) / greatest(1, count(*) over (partition by status) - 1), 9) as weight_rank from strata""")
def mid_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranks.mid_rank(A.strata_rows(spark, sf_dir), "weight", "weight_rank", ("status",)).select("id", "weight_rank"), 9)


_CORNERS = "[" + ", ".join(f"[rx + {a} * cos(ra) * rs - {b} * sin(ra) * rs, ry + {a} * sin(ra) * rs + {b} * cos(ra) * rs]" for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))) + "]"


@query(f"""{A.with_sql('labels')}, neg as (select roi_id, dataset_id, source_group_id, {_CORNERS} as q from (select *, 0.5 + e[43]::double as rx, 0.5 + e[44]::double as ry, 0.05 + abs(e[45]::double) as rs, 6 * e[46]::double as ra from labels where not present)),
pts as (select n.roi_id, p.roi_id as pos, p.points[i + 1].x as x, p.points[i + 1].y as y, q from neg n join labels p using (dataset_id, source_group_id), (select unnest({CORE}) as i) c where p.present),
edges as (select roi_id, pos, x, y, q[(k + 3) % 4 + 1][1] as ax, q[(k + 3) % 4 + 1][2] as ay, q[k + 1][1] as bx, q[k + 1][2] as b_y from pts, range(4) t(k)),
hits as (select roi_id, pos, x, y, bool_or(abs((x - ax) * (b_y - ay) - (y - ay) * (bx - ax)) <= 1e-6 and (x - ax) * (x - bx) + (y - ay) * (y - b_y) <= 1e-6)
  or sum(case when ((ay > y) <> (b_y > y)) and x < (bx - ax) * (y - ay) / (b_y - ay) + ax then 1 else 0 end) % 2 = 1 as inside from edges group by all),
best as (select roi_id, max(n) as n from (select roi_id, pos, count(*) filter (inside) as n from hits group by all) group by 1)
select roi_id, coalesce(n, 0)::integer as overlap from neg left join best using (roi_id)""")
def negative_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = A.roi_labels(spark, sf_dir)
    return joins.negative_overlap(labels.where("not present"), labels.where("present"), CORE).select("roi_id", "overlap")


@query(f"""{A.with_sql('labels', 'candidate', 'baseline')}, {_measured_sql()}, {_measured_sql('baseline', 'b')}
select roi_id, round(b.error_px, 6) as baseline_px, round(m.error_px, 6) as candidate_px, round(m.error_px - b.error_px, 6) as delta_px,
  case when m.error_px < b.error_px then 'improved' when m.error_px > b.error_px then 'regressed' when m.error_px = b.error_px then 'equal' end as outcome from m join b using (roi_id)""")
def paired_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(joins.paired_runs(measured(spark, sf_dir, "baseline"), measured(spark, sf_dir)))


_BONES_SQL = "[" + ", ".join(f"[{a + 1}, {b + 1}]" for a, b in P.BONES) + "]"


@query(f"""{A.with_sql('labels', 'candidate')}, {_measured_sql()}, d as (select *, list_sum(list_transform({_BONES_SQL}, lambda z: sqrt(pow((predicted[z[2]].x - predicted[z[1]].x) - (points[z[2]].x - points[z[1]].x), 2) + pow((predicted[z[2]].y - predicted[z[1]].y) - (points[z[2]].y - points[z[1]].y), 2)))) / 20 as bone from m)
select dataset_id, count(*) as records, count(error_px) as positive_records, round(avg(error_px), 6) as mean_px, round(avg(nme), 6) as mean_nme, round(avg(bone), 6) as mean_bone_error, count(*) filter (own_spread < 0.1) as collapse_count,
  round(avg((present = predicted_present)::integer), 6) as presence_accuracy, round(avg(case when handedness in ('Left', 'Right') then (handedness = predicted_handedness)::integer end), 6) as handedness_accuracy,
  {', '.join(f"round(coalesce(sum(len(list_filter(errors_px, lambda e: e <= {t} * 255.0))) / nullif(count(errors_px) * 21, 0), 0.0), 6) as pck_{round(100 * t):03d}" for t in metrics.PCK)} from d group by 1""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_summary(spark, sf_dir).drop("p90_px")  # run_p90 has it


def _run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measured(spark, sf_dir).withColumn("bone_error", P.bone_vector_error(F.col("points"), F.col("predicted"))).withColumn("predicted_spread", P.diagonal(F.col("predicted")))
    return rounded(metrics.run_summary(rows, ("dataset_id",)))


@query(f"""{A.with_sql('labels', 'candidate')}, {_measured_sql()}, l as (select dataset_id, list_sort(list(error_px) filter (isfinite(error_px))) as v from m group by 1)
select dataset_id, round(v[round_even((len(v) - 1) * 0.9::double, 0)::integer + 1], 6) as p90_px from l""")
def run_p90(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_summary(spark, sf_dir).select("dataset_id", "p90_px")


_EDGES_SQL = "[" + ", ".join(f"[{a + 1}, {b + 1}]" for a, b in P.EDGES) + "]"


def _edge_sql(p: str) -> str:
    return f"list_sum(list_transform({_EDGES_SQL}, lambda z: sqrt(pow({p}[z[1]].x - {p}[z[2]].x, 2) + pow({p}[z[1]].y - {p}[z[2]].y, 2))))"


@query(f"""{A.with_sql('labels', 'candidate')}, g as (select roi_id, points, predicted, hand_flag, greatest(sqrt(pow(points[6].x - points[18].x, 2) + pow(points[6].y - points[18].y, 2)), 0.05) as scale,
  list_sort(list_transform(range(1, 22), lambda i: sqrt(pow(predicted[i].x - points[i].x, 2) + pow(predicted[i].y - points[i].y, 2)))) as e, {_edge_sql('points')} as te, {_edge_sql('predicted')} as se,
  list_sum(list_transform({_BONES_SQL}, lambda z: sqrt(pow((predicted[z[2]].x - predicted[z[1]].x) - (points[z[2]].x - points[z[1]].x), 2) + pow((predicted[z[2]].y - predicted[z[1]].y) - (points[z[2]].y - points[z[1]].y), 2)))) / 20 as bone
  from labels join candidate using (roi_id) where present and predicted is not null)
select roi_id, round(list_sum(e) / 21, 6) as mean_l2, round(list_sum(e) / 21 / scale, 6) as mean_nme, round(e[19] / scale, 6) as p90_nme, round(e[21] / scale, 6) as max_nme,
  round(ln(greatest(se, 1e-8) / greatest(te, 1e-8)), 6) as collapse_log_ratio, round(bone / scale, 6) as bone_vector_nme, round(abs(1 - hand_flag), 6) as hand_flag_error from g""")
def disagreement_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.roi_labels(spark, sf_dir).join(A.roi_predictions(spark, sf_dir), "roi_id").where("present and predicted is not null")
    found = P.disagreement(F.col("points"), F.col("predicted"), F.col("hand_flag"))
    names = ("mean_l2", "mean_nme", "p90_nme", "max_nme", "collapse_log_ratio", "bone_vector_nme", "hand_flag_error")
    return rounded(rows.select("roi_id", *(found[n].alias(n) for n in names)))


def _area_sql(p: str) -> str:
    return " * ".join(f"(list_max(list_transform({p}, lambda q: q.{c})) - list_min(list_transform({p}, lambda q: q.{c})))" for c in "xy")


@query(f"""{A.with_sql('labels', 'candidate')}
select roi_id, round(sqrt(pow(points[6].x - points[18].x, 2) + pow(points[6].y - points[18].y, 2)), 6) as teacher_palm_width, round({_edge_sql('points')}, 6) as teacher_edge_length, round({_edge_sql('predicted')}, 6) as student_edge_length,
  round({_area_sql('points')}, 6) as teacher_bbox_area, round({_area_sql('predicted')}, 6) as student_bbox_area from labels join candidate using (roi_id) where present and predicted is not null""")
def disagreement_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five measures that disagreement_metrics leaves out."""
    rows = A.roi_labels(spark, sf_dir).join(A.roi_predictions(spark, sf_dir), "roi_id").where("present and predicted is not null")
    found = P.disagreement(F.col("points"), F.col("predicted"), F.col("hand_flag"))
    names = ("teacher_palm_width", "teacher_edge_length", "student_edge_length", "teacher_bbox_area", "student_bbox_area")
    return rounded(rows.select("roi_id", *(found[n].alias(n) for n in names)))


_RANKED = ", ".join(f"({w} * ((rank() over (order by {v})) - 1 + (count(*) over (partition by {v}) - 1) / 2) / greatest(1, count(*) over () - 1)) as r{i}" for i, (w, v) in enumerate(((1.0, "mean_nme"), (0.5, "p90_nme"), (0.5, "abs(collapse_log_ratio)"), (0.5, "bone_vector_nme"))))


@query("with d as (" + SQL["disagreement_metrics"] + f"), k as (select roi_id, {_RANKED} from d) select roi_id, round(r0 + r1 + r2 + r3, 6) as disagreement from k")
def disagreement_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.roi_labels(spark, sf_dir).join(A.roi_predictions(spark, sf_dir), "roi_id").where("present and predicted is not null")
    return rounded(mining.disagreement_score(rows).select("roi_id", "disagreement"))


_T = telemetry.TIMINGS
_STATS_SQL = ", ".join(f"round(avg({t}), 9) as {t}_avg, round(list_sort(list({t}))[(count(*) - 1) // 2 + 1], 9) as {t}_p50, round(list_sort(list({t}))[greatest(ceil(round(count(*) * 0.95, 9)), 1)::integer], 9) as {t}_p95, round(max({t}), 9) as {t}_max" for t in _T)


@query(f"""{A.with_sql('frames')}, w as (select run_id, frame_index // 20 as w, * exclude (run_id) from frames)
select run_id, w as "window", count(*) as frames, max(frame_index) as frame_index, round(sum(loop_ms), 9) as window_ms, {_STATS_SQL}, round(avg(1000 / loop_ms), 9) as fps_avg,
  round(list_sort(list(1000 / loop_ms))[greatest(ceil(round(count(*) * 0.95, 9)), 1)::integer], 9) as fps_p95 from w group by 1, 2 having count(*) = 20""")
def frame_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(telemetry.frame_windows(A.frames(spark, sf_dir), 20), 9)


@query(f"""{A.with_sql('frames')}, w as (select run_id, frame_index // 20 as w, count(*) as n, sum(loop_ms) as ms, avg(loop_ms) as lavg, list_sort(list(loop_ms))[19] as lp95, avg(1000 / loop_ms) as favg, list_sort(list(1000 / loop_ms))[19] as fp95 from frames group by 1, 2 having count(*) = 20),
c as (select *, sum(n) over o as total, sum(ms) over o / 1000 as s, n * 1000 / ms as fw from w window o as (partition by run_id order by w))
select run_id, w as "window", total::bigint as total_frames, round(total / s, 6) as fps_total, round(fw, 6) as fps_window, round(fw / 90, 6) as realtime_ratio, floor(10 * greatest(0, least(1, fw / 90)))::integer as realtime_score,
  round(100 * greatest(0, least(1, (s * 90 - total) / (s * 90))), 6) as drop_pct, greatest(0, least(10, floor(11 - lp95 * 90 / 1000)))::integer as latency_score,
  round(100 * abs(lp95 - lavg) / lavg, 6) as loop_jitter_pct, round(100 * abs(fp95 - favg) / favg, 6) as fps_jitter_pct from c""")
def window_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = telemetry.window_scores(telemetry.frame_windows(A.frames(spark, sf_dir), 20))
    names = ("fps_total", "fps_window", "realtime_ratio", "realtime_score", "drop_pct", "latency_score", "loop_jitter_pct", "fps_jitter_pct")
    return rounded(scored.select("run_id", "window", F.col("total_frames").cast("long").alias("total_frames"), *names))


@query(f"""{A.with_sql('frames')}, w as (select run_id, frame_index // 20 as w, avg(loop_ms) as l, avg(palm_total_ms) as p, max(loop_ms) as t from frames group by 1, 2 having count(*) = 20),
m as (select run_id, w, unnest([{{'m': 'summary.frame', 'v': w * 20 + 19}}, {{'m': 'summary.total_frames', 'v': w * 20 + 20}}, {{'m': 'summary.window_frames', 'v': 20}}, {{'m': 'stage_ms.loop_avg', 'v': printf('%.6f', l)::double}}, {{'m': 'stage_ms.palm_avg', 'v': printf('%.6f', p)::double}}, {{'m': 'latency.loop_max', 'v': printf('%.6f', t)::double}}], recursive := true) from w)
select run_id, m as metric, count(*) as windows, round(avg(v), 8) as mean, round(quantile_cont(v, 0.5), 8) as p50, round(quantile_cont(v, 0.95), 8) as p95, round(min(v), 8) as least, round(max(v), 8) as most, round(arg_max(v, w), 8) as latest from m group by 1, 2""")
def perf_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines made of the frames, parsed again and rolled up; numbers have 6 decimals in the lines."""
    parsed = telemetry.parse_lines(A.perf_lines(spark, sf_dir))
    return rounded(telemetry.window_rollup(telemetry.log_metrics(parsed)), 8)


@query(f"""{A.with_sql('history')} select run, metric, min(epoch) as epoch, b as value from history join (select run, metric, min(value) as b from history group by all) using (run, metric) where value = b group by run, metric, b""")
def best_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_epoch(A.history(spark, sf_dir))


def _covers(limit: str) -> str:
    """Whether a kept box q covers the box b too much."""
    both = "greatest(0, least(q.x2, b.x2) - greatest(q.x1, b.x1)) * greatest(0, least(q.y2, b.y2) - greatest(q.y1, b.y1))"
    return f"{both} / ((q.x2 - q.x1) * (q.y2 - q.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {both} + 1e-6) > {limit}"


def _suppressed_sql(order: str, limit: str, full: str) -> str:
    box = "{'box_id': box_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'score': score, 'head': head}"
    kept = box.replace(": ", ": b.")
    return f"""{A.with_sql('boxes', recursive=True)}, ordered as (select *, row_number() over (partition by image order by {order} score desc, box_id) as n from boxes),
steps as (select image, 0::bigint as n, list_slice([{box}], 1, 0) as kept from ordered where n = 1
  union all select s.image, b.n, case when {full} or len(list_filter(s.kept, lambda q: {_covers(limit)})) > 0 then s.kept else list_append(s.kept, {kept}) end
  from steps s join ordered b on b.image = s.image and b.n = s.n + 1),
stay as (select image, unnest(arg_max(kept, n), recursive := true) from steps group by image),
ranked as (select *, row_number() over (partition by image order by score desc, box_id)::integer as rank from stay)"""


@query(f"""{_suppressed_sql('', '0.3', 'len(s.kept) >= 5')} select image, box_id, x1, y1, x2, y2, score, rank from ranked""")
def nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections.nms(A.boxes(spark, sf_dir), 0.3, 5)


@query(f"""{_suppressed_sql('head,', 'case when b.head = 0 then 0.3 else 0.1 end', 'len(s.kept) >= 5 and len(list_filter(s.kept, lambda q: q.head = 1)) > 0')} select image, box_id, head, x1, y1, x2, y2, score, rank from ranked where rank <= 5""")
def nms_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections.nms_two_stage(A.boxes(spark, sf_dir), 0.3, 0.1, 5)


@query(f"""{A.with_sql('boxes')}, p as (select image, count(*) filter (score >= 0.25) as a, count(*) filter (score >= 0.5) as b, count(*) filter (score >= 0.75) as c from boxes group by 1),
u as (select unnest([{{'threshold': 0.25::double, 'n': a}}, {{'threshold': 0.5::double, 'n': b}}, {{'threshold': 0.75::double, 'n': c}}], recursive := true) from p)
select threshold, count(*) filter (n = 0) as none, count(*) filter (n = 1) as one, count(*) filter (n >= 2) as two_or_more, sum(n)::bigint as total from u group by 1""")
def roi_count_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roi_count_table(A.boxes(spark, sf_dir), [0.25, 0.5, 0.75])


@query(f"""{A.with_sql('labels')}, x as (select *, list_min(list_transform(points, lambda p: p.x)) as x0, list_max(list_transform(points, lambda p: p.x)) as x1, list_min(list_transform(points, lambda p: p.y)) as y0, list_max(list_transform(points, lambda p: p.y)) as y1 from labels),
m as (select *, least(x0, y0, 1 - x1, 1 - y1) as mg from x)
select dataset_id, count(*) as n, round(avg((x0 < 0 or y0 < 0 or x1 > 1 or y1 > 1)::integer), 6) as out_of_range_rate, round(avg(x1 - x0), 6) as mean_width, round(quantile_cont(x1 - x0, 0.5), 6) as median_width,
  round(avg(y1 - y0), 6) as mean_height, round(quantile_cont(y1 - y0, 0.5), 6) as median_height, round(avg(mg), 6) as mean_margin, round(quantile_cont(mg, 0.5), 6) as median_margin from m group by 1""")
def occupancy_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.occupancy_stats(A.roi_labels(spark, sf_dir), ("dataset_id",)))


@query(f"""{A.with_sql('labels')}, pose as (select i, avg(points[i].x) as x, avg(points[i].y) as y from labels, range(1, 22) t(i) where split = 'train' and present group by 1),
e as (select roi_id, avg(255 * sqrt(pow(p.x - points[i].x, 2) + pow(p.y - points[i].y, 2))) as px from labels, pose p where split = 'test' and present group by 1)
select count(*) as gt_positive, count(*) as n_predicted, round(avg(px), 6) as mean_px, round(quantile_cont(px, 0.5), 6) as median_px, round(quantile_cont(px, 0.9), 6) as p90_px from e""")
def constant_pose_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = A.roi_labels(spark, sf_dir).where("present")
    report = metrics.constant_pose_baseline(labels.where("split = 'train'"), labels.where("split = 'test'"))
    return rounded(report.select("gt_positive", "n_predicted", "mean_px", "median_px", "p90_px"))


@query(f"""{A.with_sql('labels')}, u as (select unnest([{{'dimension': 'dataset_id', 'value': dataset_id}}, {{'dimension': 'split', 'value': split}}, {{'dimension': 'handedness', 'value': handedness}}, {{'dimension': 'present', 'value': present::varchar}}, {{'dimension': 'proposal_variant', 'value': proposal_variant}}], recursive := true) from labels)
select dimension, value, count(*) as n from u group by all""")
def audit_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.audit_counters(A.roi_labels(spark, sf_dir), ["dataset_id", "split", "handedness", "present", "proposal_variant"])


@query(f"""{A.with_sql('strata')} select dataset_id, count(*) as "groups", min(n) as least, quantile_cont(n, 0.5) as median, round(quantile_cont(n, 0.9), 6) as p90, max(n) as most from (select dataset_id, source_sequence_id, count(*) as n from strata group by all) group by 1""")
def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quotas.group_size_stats(A.strata_rows(spark, sf_dir), "source_sequence_id", ("dataset_id",)))


@query(f"""{A.with_sql('strata')} select sample_type, round(sum(weight / t * 100), 4) as expected, round(sum(weight / t * 100) / sum(sum(weight / t * 100)) over (), 6) as share, sum(weight / t * 100) / sum(sum(weight / t * 100)) over () <= 0.25::double + 1e-12 as within_limit from (select *, sum(weight) over (partition by status) as t from strata) group by 1""")
def expected_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.strata_rows(spark, sf_dir).withColumn("cell", F.col("status"))
    cells = rows.select("cell").distinct().withColumn("quota", F.lit(100))
    found = quotas.expected_draws(rows, cells, "sample_type", 0.25)
    return found.select("sample_type", F.round("expected", 4).alias("expected"), F.round("share", 6).alias("share"), "within_limit")


@query(f"""{A.with_sql('strata')}, r as (select *, row_number() over (partition by status, priority order by sha256('robin' || chr(31) || id), id) as n from strata), t as (select *, row_number() over (order by n, status, priority)::integer as position from r)
select id, status, priority, position from t where position <= 40""")
def review_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.round_robin(A.strata_rows(spark, sf_dir), ("status", "priority"), "id", 40, "robin").select("id", "status", "priority", "position")


@query("""select event_id, coalesce(json_extract_string(props, '$.k'), '<missing>') as k, coalesce(json_extract_string(props, '$.a.b'), '<missing>') as ab,
  ('0x' || substr(sha256('11' || chr(31) || event_id), 1, 12))::bigint / 281474976710656.0 as u from events""")
def dotted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.table(spark, sf_dir, "events")
    return events.select("event_id", X.dotted(F.col("props"), "k").alias("k"), X.dotted(F.col("props"), "a.b").alias("ab"), X.uniform(F.lit(11), F.col("event_id")).alias("u"))


@query(f"""{A.with_sql('labels', 'candidate')}, p as (select roi_id from candidate where predicted is not null union all select 'roi-0' union all select 'roi-none' union all select roi_id from candidate where roi_id like '%7'),
a as (select roi_id, count(*) as n_labels from labels group by 1), b as (select roi_id, count(*) as n_predictions from p group by 1)
select roi_id, coalesce(n_labels, 0) as n_labels, coalesce(n_predictions, 0) as n_predictions, case when n_predictions is null then 'missing' when n_labels is null then 'extra' else 'duplicate' end as problem
from a full outer join b using (roi_id) where n_predictions is null or n_labels is null or n_labels > 1 or n_predictions > 1""")
def coverage_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with gaps, an unknown id and repeats against the labels."""
    made = A.roi_predictions(spark, sf_dir)
    extra = spark.createDataFrame([("roi-0",), ("roi-none",)], "roi_id string")
    given = made.where("predicted is not null").select("roi_id").union(extra).union(made.where("roi_id like '%7'").select("roi_id"))
    return joins.coverage_problems(A.roi_labels(spark, sf_dir), given, "roi_id")


@query(f"""{A.with_sql('assets')}, o as (select id, digest from assets where id % 7 <> 0), n as (select id, case when id % 5 = 0 then sha256(digest) else digest end as digest from assets where id % 11 <> 0)
select id, case when n.digest is null then 'removed' when o.digest is null then 'added' else 'modified' end as change from o full outer join n using (id) where o.digest is distinct from n.digest""")
def snapshot_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = A.asset_rows(spark, sf_dir).select("id", "digest")
    changed = F.when(F.col("id") % 5 == 0, F.sha2("digest", 256)).otherwise(F.col("digest"))
    return joins.snapshot_drift(assets.where("id % 7 <> 0"), assets.where("id % 11 <> 0").withColumn("digest", changed), "id", "digest")


@query(f"""{A.with_sql('assets')}, g as (select token, min(id) as winner from (select id, unnest(['d:' || digest, 'p:' || id // 3]) as token from assets where split <> 'train') group by 1),
r as (select distinct id, unnest(['d:' || digest, 'p:' || id // 3]) as token from assets where split = 'train') select id, count(*) as n_tokens, min(winner) as winner from r join g using (token) group by 1""")
def supersede_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training assets that share a digest or parent with one outside training, and which one wins."""
    tokens = F.array(F.concat(F.lit("d:"), "digest"), F.concat(F.lit("p:"), F.floor(F.col("id") / 3)))
    assets = A.asset_rows(spark, sf_dir).withColumn("tokens", tokens)
    return joins.supersede(assets.where("split <> 'train'"), assets.where("split = 'train'"), "id")[1]


def _skeleton_sql(p: str) -> str:
    return _edge_sql(p).replace(_EDGES_SQL, _BONES_SQL)


@query(f"""{A.with_sql('labels', 'candidate')}, g as (select dataset_id, {_skeleton_sql('predicted')} / {_skeleton_sql('points')} as r from labels join candidate using (roi_id) where predicted is not null)
select dataset_id, count(*) as n, round(avg(r), 6) as mean_length_ratio, count(*) filter (r < 0.7) as below_070, count(*) filter (r < 0.5) as below_050 from g group by 1""")
def gold_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.roi_labels(spark, sf_dir).join(A.roi_predictions(spark, sf_dir), "roi_id").where("predicted is not null")
    return rounded(metrics.gold_relative(rows, ("dataset_id",)).drop("mean_area_ratio"))  # gold_relative_area has it


@query(f"""{A.with_sql('labels', 'candidate')} select dataset_id, round(avg({_area_sql('predicted')} / nullif({_area_sql('points')}, 0)), 6) as mean_area_ratio from labels join candidate using (roi_id) where predicted is not null group by 1""")
def gold_relative_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.roi_labels(spark, sf_dir).join(A.roi_predictions(spark, sf_dir), "roi_id").where("predicted is not null")
    return rounded(metrics.gold_relative(rows, ("dataset_id",)).select("dataset_id", "mean_area_ratio"))


@query(f"""{A.with_sql('frames')}, w as (select run_id, frame_index // 20 as w, count(*) as n, sum(loop_ms) as ms, max(loop_ms) as top from frames group by 1, 2 having count(*) = 20)
select run_id, count(*) as windows, sum(n)::bigint as frames, max(w) * 20 + 20 as last_total_frames, sum((w * 20 + 19) // 3 - (w * 20 + 2) // 3 + 1)::bigint as inferences, 0::bigint as hand_calls, round(sum(ms), 6) as total_ms, round(sum(n) * 1000.0 / sum(ms), 6) as fps, round(max(top), 6) as slowest_ms from w group by 1""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(telemetry.run_metrics(telemetry.frame_windows(A.frames(spark, sf_dir), 20), 3, "palm"))


@query(f"""{A.with_sql('assets')} select "group", count(*) as n_files, sha256(string_agg(id || ':' || digest || chr(10), '' order by id || ':' || digest || chr(10))) as fingerprint from assets group by 1""")
def source_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.fingerprint(A.asset_rows(spark, sf_dir).withColumn("path", F.col("id").cast("string")), ("group",))


@query(f"""{A.with_sql('assets')}, l as (select "group", id || ':' || digest || chr(10) as line, ('0x' || substr(sha256(id::varchar), 1, 8))::bigint % ceil(count(*) over (partition by "group") / 64)::bigint as p from assets),
d as (select "group", p, count(*) as n, sha256(string_agg(line, '' order by line)) as d from l group by all) select "group", sum(n)::bigint as n_files, sha256(string_agg(d, chr(10) order by p)) as fingerprint from d group by 1""")
def source_tree_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As source_fingerprints, for sources of any size."""
    return joins.tree_fingerprint(A.asset_rows(spark, sf_dir).withColumn("path", F.col("id").cast("string")), ("group",), 64)


@query(f"""{A.with_sql('strata')} select id, 1.0 / count(*) over (partition by source_sequence_id) as inverse from strata""")
def inverse_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.inverse_frequency(A.strata_rows(spark, sf_dir), "source_sequence_id").select("id", "inverse")


@query(f"""{A.with_sql('strata')}, c as (select tier, sample_type, count(*) as n, sum(weight) as w, max(weight) as m from strata group by all)
select tier, sample_type, least(200, floor(least(n * 0.02, 4.0 * w / m)))::bigint as quota, 200 - least(200, floor(least(n * 0.02, 4.0 * w / m)))::bigint as freed from c""")
def rare_cell_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.strata_rows(spark, sf_dir)
    cells = rows.groupBy("tier", "sample_type").agg(F.count("*").alias("n"), F.sum("weight").alias("total_weight"), F.max("weight").alias("max_weight")).withColumn("quota", F.lit(200).cast("long"))
    return quotas.rare_cell_cap(cells, average=0.02, heaviest=4.0).select("tier", "sample_type", "quota", "freed")


@query(f"""{A.with_sql('strata')}, c as (select status, sample_type, count(*) as n, sum(weight) as w, max(weight) as m, case sample_type when 'type-1' then 2 when 'type-3' then 1 else 0 end as part from strata group by all),
q as (select *, case when part > 0 then n // 8 else n end as planned from c),
k as (select *, least(planned, floor(least(n * 0.9::double, 4.0 * w / m) + 1e-12))::bigint as cut from q),
f as (select *, sum(planned - cut) over (partition by status)::bigint as freed_all, case when cut = planned then part else 0 end as own from k),
g as (select *, sum(own) over (partition by status)::bigint as parts from f),
r as (select *, case when own > 0 then freed_all * own // parts else 0 end as base, case when own > 0 then freed_all * own % parts else -1 end as rest from g),
o as (select *, row_number() over (partition by status order by rest desc, sample_type) <= freed_all - sum(base) over (partition by status) as more from r)
select status, sample_type, (cut + base + more::int)::bigint as quota, (planned - cut)::bigint as freed, (base + more::int)::bigint as added from o""")
def rare_cell_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.strata_rows(spark, sf_dir)
    cells = rows.groupBy("status", "sample_type").agg(F.count("*").alias("n"), F.sum("weight").alias("total_weight"), F.max("weight").alias("max_weight"))
    fraction = F.when(F.col("sample_type") == "type-1", 0.50).when(F.col("sample_type") == "type-3", 0.25).otherwise(0.0)
    cells = cells.withColumn("fraction", fraction).withColumn("quota", F.when(fraction > 0, F.floor(F.col("n") / 8)).otherwise(F.col("n")).cast("long"))
    found = quotas.rare_cell_quota(cells, ("type-1", "type-3"), ("status",), average=0.9, heaviest=4.0)
    return found.select("status", "sample_type", "quota", "freed", "added")
