"""Golden values, order independence and violations of the keypoint operators, on small tables."""

import hashlib
import math

import numpy as np

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import points as P
from tessera.functions import stats, text
from tessera.operators import scoring, contracts, detections, joins, metrics, mining, quotas, ranks, selection, sets, telemetry

POINTS = "array<struct<id:int,x:double,y:double>>"


def pose(dx=0.0, scale=1.0):
    return [(i, 0.3 + dx + scale * 0.02 * (i % 5), 0.3 + scale * 0.02 * (i // 5)) for i in range(21)]


def label(i, present=True, predicted=True, hand="Left", split="train", **more):
    row = dict(roi_id=f"r{i}", dataset_id=f"ds-{i % 2}", capture_source_id=f"white-near-bright-c1-{split}-s01-p1", split=split, present=present, palm_valid=True, handedness=hand, points=pose(), predicted=pose(0.01) if predicted else None, hand_flag=0.9, handedness_score=0.2)
    return row | more


SCHEMA = f"roi_id string, dataset_id string, capture_source_id string, split string, present boolean, palm_valid boolean, handedness string, points {POINTS}, predicted {POINTS}, hand_flag double, handedness_score double"


def table(spark, rows):
    return spark.createDataFrame([tuple(r[f.split()[0]] for f in SCHEMA.replace(POINTS, "P").split(", ")) for r in rows], SCHEMA)


# metrics

def test_a_positive_without_prediction_counts_as_missed(spark):
    got = metrics.landmark_metrics(metrics.row_measures(table(spark, [label(0, predicted=False)]))).first()
    assert (got.gt_positive, got.n_predicted, got.coverage, got.pck_010, got.mean_px) == (1, 0, 0.0, 0.0, None)


def test_unknown_handedness_counts_for_landmarks_only(spark):
    rows = metrics.row_measures(table(spark, [label(0, hand="unknown"), label(1, hand="Left")]))
    hand, marks = metrics.handedness_metrics(rows).first(), metrics.landmark_metrics(rows).first()
    assert (hand.hand_eligible, hand.hand_excluded, hand.left_recall, hand.right_recall, marks.n_predicted) == (1, 1, 1.0, 0.0, 2)
    assert marks.mean_px == pytest.approx(2.55)


def test_grouped_report_has_each_dimension(spark):
    got = metrics.grouped_report(metrics.row_measures(table(spark, [label(i) for i in range(4)])), ("dataset_id", "split")).collect()
    assert sorted((r.dimension, r.value, r.n) for r in got) == [("all", "all", 4), ("dataset_id", "ds-0", 2), ("dataset_id", "ds-1", 2), ("split", "train", 4)]


def test_sweep_equals_confusion_at_each_threshold(spark):
    rows = spark.createDataFrame([(i % 3 == 0, (i * 37 % 100) / 100) for i in range(60)], "t boolean, s double")
    for r in metrics.threshold_sweep(rows, "t", "s", [0.0, 0.3, 0.37, 1.1]).collect():
        want = metrics.confusion(rows.withColumn("p", F.col("s") >= r.threshold), "t", "p").first()
        assert (r.tp, r.fp, r.tn, r.fn, r.f1) == (want.tp, want.fp, want.tn, want.fn, want.f1)


def test_best_epoch_takes_the_first_best(spark):
    rows = spark.createDataFrame([(1, e, m, v) for m, vs in (("loss", [3.0, 1.0, 1.0, float("nan")]), ("val_accuracy", [0.1, 0.9, 0.9, 0.2])) for e, v in enumerate(vs, 1)], "run int, epoch int, metric string, value double")
    assert {(r.metric, r.epoch) for r in metrics.best_epoch(rows).collect()} == {("loss", 2), ("val_accuracy", 2)}


def test_losses_and_gates(spark):
    rows = table(spark, [label(i) for i in range(3)]).withColumn("weight", F.lit(2.0))
    loss = metrics.weighted_losses(rows).first()
    assert loss.huber == pytest.approx(0.01**2 / 2) and loss.bone_vector == pytest.approx(0) and loss.presence_bce == pytest.approx(-math.log(0.9))
    gate = metrics.fit_gate(rows, {"mean": 0.004, "max": 0.01}).first()
    assert gate["mean"] == pytest.approx(0.005) and not gate.mean_ok and gate.max_ok
    heads = metrics.multihead_gate(rows).first()
    assert heads.presence_accuracy == 1.0 and heads.handedness_accuracy == 1.0


def test_pose_baseline_and_low_quantiles(spark):
    rows = table(spark, [label(i) for i in range(5)])
    assert metrics.constant_pose_baseline(rows, rows).first().mean_px == pytest.approx(0)
    small = rows.withColumn("points", F.transform("points", lambda p: F.struct(p["id"].alias("id"), (p["x"] * 0.1).alias("x"), (p["y"] * 0.1).alias("y"))))
    assert metrics.low_quantile_flags(small, rows).first().low == ["skeleton_length", "bbox_area", "palm_width"]
    assert metrics.low_quantile_flags(rows, rows).count() == 0
    assert metrics.gold_relative(rows).first().mean_length_ratio == pytest.approx(1.0)
    health = metrics.output_health(rows).first()
    assert (health.n_predicted, health.rows_out) == (5, 0)
    said = metrics.abstain_report(metrics.row_measures(rows), rows.limit(2).select("roi_id")).collect()
    assert sorted((r.answered, r.n) for r in said) == [(False, 3), (True, 2)]


# points

def test_points_and_rectangles(spark):
    one = table(spark, [label(0)]).withColumn("rect", F.struct(F.lit(0.5).alias("x_center"), F.lit(0.5).alias("y_center"), F.lit(0.4).alias("width"), F.lit(0.2).alias("height"), F.lit(0.7).alias("rotation_rad")))
    quad = P.corners(F.col("rect"))
    back = P.unproject(P.project(F.col("points"), quad), quad)
    got = one.select(P.mean_error(F.col("points"), back).alias("e"), P.in_polygon(F.lit(0.5), F.lit(0.5), quad).alias("middle"), P.in_polygon(quad[0][0], quad[0][1], quad).alias("corner"), P.in_polygon(F.lit(0.9), F.lit(0.5), quad).alias("out"), *(v.alias(k) for k, v in P.disagreement(F.col("points"), F.col("points"), F.lit(1.0)).items()))
    r = got.first()
    assert r.e < 1e-12 and r.middle and r.corner and not r.out
    assert r.mean_l2 == r.max_nme == r.collapse_log_ratio == r.bone_vector_nme == r.hand_flag_error == 0
    shuffled = one.select(P.canonical_points(F.reverse("points")).alias("p"), P.canonical_points(F.slice("points", 1, 20)).alias("short")).first()
    assert [p.id for p in shuffled.p] == list(range(21)) and shuffled.short is None
    px = F.transform("points", lambda p: F.struct(p["id"].alias("id"), (p["x"] * 256).alias("x"), (p["y"] * 256).alias("y")))
    assert one.select(P.pixel_convention(F.col("points"), px).alias("c")).first().c.scale == 256
    assert one.select(P.decode_vector(F.array(*map(F.lit, [float(k) for k in range(42)]))).alias("v")).first().v[20] == (20, 40.0, 41.0)
    angle = spark.range(1).select(P.normalise_angle(F.lit(math.pi)).alias("a")).first().a
    assert angle == pytest.approx(-math.pi)


def test_percentile_rules(spark):
    rows = spark.createDataFrame([(float(v),) for v in range(1, 121)], "v double")
    r = rows.agg(stats.ceil_percentile(F.col("v"), 0.95).alias("c"), stats.lower_median(F.col("v")).alias("m"), stats.linear_percentile(F.col("v"), 0.5).alias("l")).first()
    assert (r.c, r.m, r.l) == (114.0, 60.0, 60.5)


def test_text_functions(spark):
    rows = spark.createDataFrame([("white-near-bright-c1-val-s01-p2", 'a=1 b="x y" c=2.5', "a/../b", "2026-07-14T10:00:00Z", '{"k": {"m": 3}}')], "c string, l string, p string, t string, j string")
    r = rows.select(text.capture_parts(F.col("c")).alias("c"), text.key_values(F.col("l")).alias("l"), text.unsafe_path(F.col("p")).alias("p"), text.is_timestamp(F.col("t")).alias("t"), text.dotted(F.col("j"), "k.m").alias("j"), text.dotted(F.col("j"), "x").alias("x")).first()
    assert r.c.valid and r.c.split == "val" and r.l == {"a": "1", "b": "x y", "c": "2.5"} and r.p and r.t and (r.j, r.x) == ("3", "<missing>")
    toks = spark.createDataFrame([("A", " b ", None)], "x string, y string, z string").select(text.tokens({"n": [F.col("x"), F.col("y"), F.col("z")]}).alias("t")).first().t
    assert toks == ["n:a", "n:b"]
    nested = spark.createDataFrame([('{"b": {"z": [1, {"d": 1, "c": 2}], "a": "q"}, "a": null}',), ("[2, 1]",), ("no json",)], "j string")
    assert [r[0] for r in nested.select(text.canonical_json(F.col("j"))).collect()] == ['{"a":null,"b":{"a":"q","z":[1,{"c":2,"d":1}]}}', "[2,1]", None]
    assert nested.select(text.dotted(F.col("j"), "b").alias("b"), text.dotted(F.col("j"), "b.a").alias("a")).first() == ('{"a":"q","z":[1,{"c":2,"d":1}]}', "q")
    ids = spark.createDataFrame([("G1", "D", "I.png", "n1", "root")], "crop_id string, dataset_id string, image string, native_source_crop_id string, native_source_root string")
    assert ids.select(text.identity_tokens(ids.columns)).first()[0] == ["parent:g1", "source_image:d:i.png", "native:root:n1"]
    own = spark.createDataFrame([("G1", "D", "C", "abc", "s")], "global_crop_id string, dataset_id string, source_crop_id string, image_sha256 string, session_id string")
    assert own.select(text.lineage_tokens(own.columns, groups=True)).first()[0] == ["global_crop_lineage:G1", "dataset_source_crop:D\x1fC", "roi_image_sha256:abc", "session_id:s"]


# quotas and ranks

def test_largest_remainder(spark):
    cells = spark.createDataFrame([("b", 1), ("a", 1)], "cell string, weight int")
    assert dict(quotas.largest_remainder(cells, "cell", "weight", 7).select("cell", "quota").collect()) == {"a": 4, "b": 3}


def test_shares_of_large_totals(spark):
    # shares that are equal to six places, of which 30 million take parts of a row and more
    n = [1000001, 1000000, 1000002]
    cells = spark.createDataFrame([("c", n[0]), ("a", n[1]), ("b", n[2])], "cell string, n long")
    assert {r.cell: r.quota for r in quotas.largest_remainder(cells, "cell", "n", 1).collect()} == {"a": 0, "b": 1, "c": 0}
    total = 30_000_000
    shares = {c: total * k // sum(n) for c, k in zip("cab", n)}
    for c in sorted(shares, key=lambda c: -(total * dict(zip("cab", n))[c] % sum(n)))[: total - sum(shares.values())]:
        shares[c] += 1
    assert {r.cell: r.quota for r in quotas.largest_remainder(cells, "cell", "n", total).collect()} == shares
    sizes = [10**7, 2 * 10**7, 3 * 10**7]
    rows = spark.createDataFrame([("p", f"d{k}", float(math.sqrt(v)), v) for k, v in enumerate(sizes)], "plan_id string, cell string, weight double, capacity long")
    exact = [total // 2 * math.sqrt(v) / sum(map(math.sqrt, sizes)) for v in sizes]
    got = [r.quota for r in quotas.bounded_quota(rows, total // 2).orderBy("cell").collect()]
    assert sum(got) == total // 2 and all(abs(a - b) < 1 for a, b in zip(got, exact))


def test_bounded_quotas(spark):
    cells = spark.createDataFrame([("p", "a", 1.0, 2), ("p", "b", 1.0, 100), ("p", "c", 2.0, 100), ("q", "a", 0.0, 5)], "plan_id string, cell string, weight double, capacity int")
    got = {(r.plan_id, r.cell): r.quota for r in quotas.bounded_quota(cells, 12).collect()}
    assert got == {("p", "a"): 2, ("p", "b"): 3, ("p", "c"): 7, ("q", "a"): 5}
    once = dict(quotas.bounded_proportional(cells.where("plan_id = 'p'"), "cell", "capacity", 12).select("cell", "quota").collect())
    assert once == {"a": 0, "b": 6, "c": 6}
    with pytest.raises(Exception, match="203 rows wanted, there are 202"):
        quotas.bounded_proportional(cells.where("plan_id = 'p'"), "cell", "capacity", 203).collect()
    own = cells.withColumn("wanted", F.when(F.col("plan_id") == "p", 150).otherwise(3))
    assert {(r.plan_id, r.cell): r.quota for r in quotas.bounded_quota(own, F.col("wanted")).collect()} == {("p", "a"): 2, ("p", "b"): 49, ("p", "c"): 99, ("q", "a"): 3}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0.0, 1.0, 2.0, 3.5]), st.integers(0, 9)), min_size=1, max_size=6), st.integers(0, 40))
def test_bounded_quotas_fill_up_to_the_level(spark, cells, total):
    got = quotas.bounded_quota(spark.createDataFrame([("p", k, w, n) for k, (w, n) in enumerate(cells)], "plan_id string, cell int, weight double, capacity int"), total).collect()
    assert sum(r.quota for r in got) == min(total, sum(n for _, n in cells)) and all(0 <= r.quota <= r.capacity for r in got)
    weighted = [r for r in got if r.weight > 0]
    assert not any(r.quota for r in got if not r.weight) or all(r.quota == r.capacity for r in weighted)
    level = max([(r.quota - 1) / r.weight for r in weighted], default=0)
    assert all(r.quota == r.capacity or (r.quota + 1) / r.weight >= level for r in weighted)


def test_stratified_sample_does_not_depend_on_order(spark):
    rows = spark.createDataFrame([(i, "x" if i < 10 else "y") for i in range(20)], "id int, t string")
    a = quotas.stratified_sample(rows.repartition(1), ("t",), "id", 8, "s").select("id", "t").collect()
    b = quotas.stratified_sample(rows.orderBy(F.rand(3)).repartition(7), ("t",), "id", 8, "s").select("id", "t").collect()
    assert sorted(a) == sorted(b) and [sum(r.t == t for r in a) for t in "xy"] == [4, 4]


def test_group_holdout(spark):
    rows = spark.createDataFrame([(d,) for d, n in (("old", 8), ("new-a", 3), ("new-b", 4), ("new-c", 6)) for _ in range(n)], "dataset_id string")
    chosen = quotas.group_holdout(rows, 5, 7, 8, "new-.*")
    assert {r.dataset_id: r.n for r in chosen.collect()} == {"new-a": 3, "new-b": 4}
    large = spark.createDataFrame([("old", 6 * 10**9), ("a", 3 * 10**9), ("b", 10**9 + 1)], "dataset_id string, n long")  # counted rows: memory follows the datasets
    found = quotas.holdout_of_counts(large.withColumn("plan_id", F.lit("p")), 10**9, 4 * 10**9, 10**10, salt="s")
    assert {r.dataset_id for r in found.collect()} == {"a", "b"}
    assert quotas.group_holdout(rows, 100, 100, 100).count() == 0
    # a total that several sets reach: the one of datasets that come early by salted digest
    equal = spark.createDataFrame([(d,) for d in "abcd" for _ in range(2)], "dataset_id string")
    early = sorted("abcd", key=lambda d: hashlib.sha256(f"s\0{d}".encode()).hexdigest())[:2]
    assert {r.dataset_id for r in quotas.group_holdout(equal, 4, 4, 5, salt="s").collect()} == set(early)


def test_hierarchical_weights(spark):
    rows = spark.createDataFrame([(1, "d1", "main", "POS", "clip-a"), (2, "d1", "main", "POS", "clip-a"), (3, "d1", "main", "POS", "clip-b"), (4, "d2", "side", "POS", "c")], "id int, dataset_id string, role string, sample_type string, source_sequence_id string")
    roles = spark.createDataFrame([("main", 0.60), ("side", 0.20), ("none", 0.20)], "role string, target double")
    w = {r.id: r.sampling_weight for r in ranks.hierarchical_weights(rows, roles).collect()}
    assert sum(w.values()) == pytest.approx(1) and w[4] == pytest.approx(0.25) and w[1] + w[2] == pytest.approx(w[3])


def test_tier_quota_of_a_batch(spark):
    rows = spark.createDataFrame([(t, f"{k}") for t in ("gold", "pseudo") for k in range(2) for _ in range(10)], "tier string, sample_type string")
    fractions = spark.createDataFrame([("gold", 0.40), ("pseudo", 0.60), ("absent", 0.5)], "tier string, fraction double")
    got = quotas.tier_type_quota(rows, 32, fractions).groupBy("tier").agg(F.sum("quota")).collect()
    assert dict(got) == {"gold": 13, "pseudo": 19}


def test_mid_rank_and_no_single_task(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate([5.0, 1.0, 1.0, 3.0, None])], "id int, v double")
    ranked = ranks.mid_rank(rows, "v", "r")
    assert dict(ranked.select("id", "r").collect()) == {0: 1.0, 1: pytest.approx(1 / 6), 2: pytest.approx(1 / 6), 3: pytest.approx(2 / 3), 4: None}


def test_mid_rank_in_ranges_equals_one_range(spark):
    values = [float(i * 37 % 101) for i in range(500)]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    want = {i: (sum(x < v for x in values) + (values.count(v) - 1) / 2) / 499 for i, v in enumerate(values)}
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would merge the small ranges
        for n in (1, 13):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r.id: r.r for r in ranks.mid_rank(rows, "v", "r").collect()}
            assert got == pytest.approx(want, abs=1e-12)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_percentiles_of_sets_equal_numpy(spark, partitions):
    """Ties, a group of one row, a hot value, values that aren't finite."""
    rng, rows = np.random.default_rng(1), []
    for i in range(900):
        v = [0.25, float(rng.integers(6)), float(rng.normal()), float("nan"), None, float("inf")][min(int(rng.integers(9)), 5) if i % 3 else 0]
        rows.append((f"a{rng.integers(4)}", "only" if i == 5 else f"b{i % 2}", v, float(rng.normal()), None))
    table_ = spark.createDataFrame(rows, "a string, b string, x double, y double, z double")
    wanted = {"x50": ("x", 0.5), "x95": ("x", 0.95), "x0": ("x", 0.0), "y1": ("y", 1.0), "y33": ("y", 0.33), "z50": ("z", 0.5)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {(r.dimension, r.value): r for r in ranks.percentiles_of_sets(table_, ("a", "b"), wanted).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    groups = {("all", "all"): rows} | {(d, v): [r for r in rows if r[k] == v] for k, d in enumerate("ab") for v in {r[k] for r in rows}}
    assert set(got) == set(groups)
    for g, own in groups.items():
        for out, (c, p) in wanted.items():
            values = [r["abxyz".index(c)] for r in own if r["abxyz".index(c)] is not None and math.isfinite(r["abxyz".index(c)])]
            assert got[g][out] == (pytest.approx(np.quantile(values, p)) if values else None)


def test_draws_follow_weights_and_partitions_do_not_matter(spark):
    rows = spark.createDataFrame([(i, "c", float(i % 4)) for i in range(40)], "id int, cell string, weight double")
    plan = spark.createDataFrame([("c", 4000)], "cell string, quota long")
    a = quotas.weighted_draws(rows.repartition(1), plan, ("cell",), 1, 1)
    b = quotas.weighted_draws(rows.repartition(9), plan, ("cell",), 1, 1)
    assert sorted(a.collect()) == sorted(b.collect())
    share = {r[0]: r[1] / 4000 for r in a.groupBy(F.col("id") % 4).count().collect()}
    assert a.where("id is null").count() == 0 and 0 not in share and all(abs(share[k] - k / 6) < 0.03 for k in (1, 2, 3))
    other = quotas.weighted_draws(rows, plan, ("cell",), 1, 2)
    assert sorted(other.collect()) != sorted(a.collect())
    batches = a.withColumns({"batch": F.col("slot") % 2, "tier": F.lit("g"), "sample_type": F.lit("t")}) if "slot" in a.columns else None
    assert batches is None or sum(r.g for r in quotas.draws_per_batch(batches, ["g"], ["t"]).collect()) == a.count()
    report = quotas.draw_report(a).first()
    assert report.draws == 4000 and report.unique_ids == 30
    assert quotas.epoch_plan_check(plan, a, ("cell",)).count() == 0 and quotas.epoch_plan_check(plan, a.limit(10), ("cell",)).first().drawn == 10


def test_cap_and_refill_keeps_totals_and_caps(spark):
    pool = spark.createDataFrame([(i, f"d{i % 3}", f"t{i % 2}", float(i)) for i in range(60)], "id int, dataset_id string, sample_type string, score double")
    chosen = pool.where("dataset_id = 'd0'").limit(12).unionByName(pool.where("dataset_id = 'd1'").limit(2))
    got = quotas.cap_and_refill(chosen, pool, 6, "score")
    sizes = dict(got.groupBy("dataset_id").count().collect())
    assert got.count() == 14 == got.select("id").distinct().count() and max(sizes.values()) <= 6


def test_refill_gives_on_room_that_a_type_does_not_use(spark):
    kinds = "id string, dataset_id string, sample_type string, score double"
    chosen = spark.createDataFrame([("a1", "d0", "A", 0.9), ("a2", "d0", "A", 0.5), ("b1", "d0", "B", 0.4)], kinds)
    free = spark.createDataFrame([("a3", "d2", "A", 0.85), ("a4", "d1", "A", 0.8), ("b2", "d1", "B", 0.7)], kinds)
    got = quotas.cap_and_refill(chosen, chosen.unionByName(free), 1, "score")
    assert sorted(r.id for r in got.collect()) == ["a1", "a3", "b2"]


def test_balanced_order_and_epoch_size(spark):
    order = quotas.balanced_order(spark.createDataFrame([("e", "a", 2), ("e", "b", 1)], "epoch string, sample_type string, quota int"), ("epoch",)).orderBy("position")
    assert [r.sample_type for r in order.collect()] == ["a", "b", "a"]
    rows = spark.createDataFrame([("c", 3.0), ("c", 1.0), ("d", 1.0), ("d", 1.0)], "cell string, weight double")
    best = quotas.auto_epoch_size(rows, spark.createDataFrame([("c", 2), ("d", 1)], "cell string, quota int"), 9.0).first()
    assert (best.batches, best.tightest_cell) == (6, "c")
    mass = quotas.loss_mass(spark.createDataFrame([(1, "g", 1.0), (1, "p", 3.0), (2, "g", 1.0)], "batch int, tier string, weight double"), ["g", "p"]).first()
    assert (mass.g, mass.p) == (0.625, 0.375)


def test_cut_draws_go_to_uncapped_positives(spark):
    kinds = "tier string, sample_type string, n long, total_weight double, max_weight double, fraction double, quota long"
    cells = spark.createDataFrame([("g", "NEG", 2, 2.0, 1.0, 0.2, 15), ("g", "P", 100, 100.0, 1.0, 0.4, 40), ("g", "Q", 100, 100.0, 1.0, 0.4, 40), ("h", "P", 10, 10.0, 1.0, 1.0, 10)], kinds)
    got = {(r.tier, r.sample_type): (r.quota, r.freed, r.added) for r in quotas.rare_cell_quota(cells, ("Q", "P")).collect()}
    assert got == {("g", "NEG"): (8, 7, 0), ("g", "P"): (43, 0, 3), ("g", "Q"): (44, 0, 4), ("h", "P"): (10, 0, 0)}
    for bad in (cells.where("sample_type = 'NEG'"), cells.withColumn("n", F.expr("if(sample_type = 'NEG', n, 10)"))):
        with pytest.raises(Exception, match="redistribution|uncapped"):
            quotas.rare_cell_quota(bad, ("Q", "P")).collect()


def test_epoch_size_keeps_both_limits_and_the_upper_bound(spark):
    rows = spark.createDataFrame([("c", 1.0)] * 4 + [("d", 1.0)] * 8, "cell string, weight double")
    plan = spark.createDataFrame([("c", 2), ("d", 2)], "cell string, quota int")
    assert tuple(quotas.auto_epoch_size(rows, plan, 9.0).first()) == (18, "c")
    assert tuple(quotas.auto_epoch_size(rows, plan, 9.0, average=3.0).first()) == (6, "c")
    assert tuple(quotas.auto_epoch_size(rows, plan, 9.0, 3.0, upper=19).first()) == (4, "c")
    for bad in (dict(average=0.1), dict(upper=3)):
        with pytest.raises(Exception, match="whole batch"):
            quotas.auto_epoch_size(rows, plan, 9.0, **bad).collect()
    with pytest.raises(Exception, match="no rows to draw"):
        quotas.auto_epoch_size(rows.where("cell = 'c'"), plan, 9.0).collect()


def test_replay_splits_positives_by_type_first(spark):
    rows = [(i, "d0", "POS", f"s{i}", True) for i in range(40)] + [(100 + i, f"d{i % 2}", "LOW", f"s{i}", True) for i in range(10)] + [(200, "d0", "NEG", "s", False)]
    rows = spark.createDataFrame(rows, "id int, dataset_id string, sample_type string, source_sequence_id string, present boolean")
    count = lambda **more: dict(quotas.select_replay(rows, 13, F.lit(True), **more).groupBy("sample_type").count().collect())
    assert count() == {"NEG": 1, "POS": 6, "LOW": 6} and count(fractions={"POS": 0.75, "LOW": 0.25}) == {"NEG": 1, "POS": 9, "LOW": 3}
    for budget, confirmed in ((0, True), (13, False)):
        with pytest.raises(ValueError):
            quotas.select_replay(rows, budget, F.lit(confirmed))


@pytest.mark.parametrize("partitions", [1, 6])
def test_diverse_take_equals_the_ranks(spark, partitions):
    """One stratum holds all rows but a few; no window is over a stratum alone."""
    rows = spark.createDataFrame([(i, "hot" if i > 9 else "cold", f"s{i % 37}" if i % 5 else None, float(i % 11)) for i in range(400)], "id int, t string, g string, score double").repartition(partitions)
    plan = spark.createDataFrame([("hot", 90), ("cold", 100), ("none", 3)], "t string, quota long")
    for score in ("score", None):
        want = quotas.take_quota(ranks.diverse_rank(rows, ("t",), "g", "id", "z", score), plan, ("t",))
        got = ranks.diverse_take(rows, plan, ("t",), "g", "id", "z", score)
        assert {(r.id, r["rank"]) for r in got.collect()} == {(r.id, r["rank"]) for r in want.collect()} and got.count() == 100
        text = got._jdf.queryExecution().optimizedPlan().toString()
        assert all("_r" in line for line in text.splitlines() if line.lstrip(" :+-").startswith("Window [row_number"))


def test_ties_follow_the_order_given(spark):
    cells = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "cell string, weight int")
    assert {r.cell: r.quota for r in quotas.largest_remainder(cells, "cell", "weight", 4, order=("c", "a")).collect()} == {"a": 1, "b": 1, "c": 2}
    assert {r.cell: r.quota for r in quotas.largest_remainder(cells, "cell", "weight", 4).collect()} == {"a": 2, "b": 1, "c": 1}
    plan = spark.createDataFrame([("t", "x", 2), ("t", "y", 2)], "tier string, sample_type string, quota long")
    assert [r.sample_type for r in quotas.balanced_order(plan, ("tier",), ("y", "x")).orderBy("position").collect()] == ["y", "x", "y", "x"]


def test_many_draws_of_a_cell_come_in_chunks(spark):
    rows = spark.createDataFrame([("c", i, 1.0) for i in range(50)], "cell string, id int, weight double")
    plan = spark.createDataFrame([("c", 200_001)], "cell string, quota long")
    draws = quotas.weighted_draws(rows, plan, ("cell",), 1, 1)
    found = draws.agg(F.count("*").alias("n"), F.count_distinct("slot").alias("slots"), F.count_distinct("id").alias("ids"), F.max("slot").alias("top")).first()
    assert tuple(found) == (200_001, 200_001, 50, 200_001)


def test_round_robin_and_diverse_rank(spark):
    rows = spark.createDataFrame([(i, "ab"[i % 2], f"s{i // 4}", float(i)) for i in range(12)], "id int, t string, source_sequence_id string, score double")
    assert [r.t for r in ranks.round_robin(rows, ("t",), "id", 4, "z").orderBy("position").collect()] == ["a", "b", "a", "b"]
    first = ranks.diverse_rank(rows, (), "source_sequence_id", "id", "z", "score").where("rank <= 3").orderBy("rank").collect()
    assert [r.id for r in first] == [11, 7, 3]
    left = quotas.round_budget(rows, rows.where("id = 11"), 3)
    assert [r.id for r in left.collect()] == [10, 9]


# joins

def test_join_violations(spark):
    a = spark.createDataFrame([("1", "x", "u"), ("2", "y", "v"), ("3", "z", "w")], "id string, v string, digest string")
    b = spark.createDataFrame([("1", "x", "u"), ("2", "q", "v"), ("4", "z", "t")], "id string, v string, digest string")
    assert sorted(joins.registry_mismatch(a, b, "id", ["v"]).collect()) == [("2", "different"), ("3", "unregistered")]
    assert {(r.id, r.problem) for r in joins.mapping_diff(a, b, "id", "v").collect()} == {("2", "different"), ("3", "left_only"), ("4", "right_only")}
    assert {(r.id, r.problem) for r in joins.coverage_problems(a, b.union(b.where("id = '1'")), "id").collect()} == {("1", "duplicate"), ("3", "missing"), ("4", "extra")}
    assert {(r.id, r.change) for r in joins.snapshot_drift(a, b, "id", "digest").collect()} == {("3", "removed"), ("4", "added")}
    assert [tuple(r) for r in joins.row_diff(a, b.where("id = '2'"), "id").where("id = '2'").select("id", "column").collect()] == [("2", "v")]
    assert {(r.id, r.problem) for r in joins.partition_check(a, a.where("id = '1'"), a.where("id <= '2'"), "id").collect()} == {("1", "in_both"), ("3", "in_none")}
    moved = spark.createDataFrame([("1", None, "x"), ("2", "y", "v"), ("2", "y", "v"), (None, "q", "q")], "id string, v string, digest string")
    whole = spark.createDataFrame([("1", "x", None), ("2", "y", "v")], "id string, v string, digest string")
    assert {(r.id, r.problem) for r in joins.partition_check(whole, moved, whole.limit(0), "id").collect()} == {("1", "different"), ("2", "repeated"), (None, "no_key")}
    left = spark.sql("select 1 as id, named_struct('a', 1, 'b', map('x', 1, 'y', 2)) as s, array(1, 2) as l, 'only' as one, cast(null as string) as n")
    right = spark.sql("select 1 as id, named_struct('a', 1, 'b', map('x', 3, 'z', 2)) as s, array(1, 3) as l, 'u' as n")
    assert {tuple(r)[1:] for r in joins.row_diff(left, right, "id").collect()} == {("s.b.x", "1", "3"), ("s.b.y", "2", "<missing>"), ("s.b.z", "<missing>", "2"), ("l", "[1,2]", "[1,3]"), ("one", '"only"', "<missing>"), ("n", "null", '"u"')}
    with pytest.raises(ValueError):
        joins.require_empty(joins.mapping_diff(a, b, "id", "v"), "decisions")
    joins.require_empty(a.where("false"), "nothing")
    good, bad = joins.restore_provenance(a.select("id", "v"), b, "id", ["digest"], ["v"])
    assert (good.count(), sorted(r.id for r in bad.collect())) == (1, ["2", "3"])


def test_tokens_leakage_and_supersede(spark):
    gold = spark.createDataFrame([("g1", ["t1", "t2"]), ("g2", ["t3"])], "id string, tokens array<string>")
    replay = spark.createDataFrame([("r1", ["t2", "t3"]), ("r2", ["t9"])], "id string, tokens array<string>")
    kept, audit = joins.supersede(gold, replay, "id")
    assert [r.id for r in kept.collect()] == ["r2"] and audit.first().asDict() == {"id": "r1", "n_tokens": 2, "winner": "g1"}
    assert [r.id for r in joins.check_leakage(replay, gold, "id").collect()] == ["r1"]
    assert [r.id for r in joins.exclude_occupied(replay, spark.createDataFrame([("t9",)], "token string"), "id").collect()] == ["r1"]
    assert joins.token_conflicts(gold.union(replay), "id").count() == 2
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("c", "x"), ("b", "y")], "s string, d string")
    assert sorted((r.left_set, r.right_set, r.n_tokens, r.n_rows) for r in joins.leakage_pairs(rows, "s", "d").collect()) == [("a", "b", 1, 3), ("a", "c", 1, 3), ("b", "c", 1, 2)]
    assert {tuple(r) for r in joins.identity_occupancy(gold.withColumn("path", F.lit("f")), "path").collect()} == {("f", 2, 3)}


def test_review_and_paths(spark):
    m = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")], "path string, digest string")
    kept = m.withColumn("crop_id", F.concat(F.lit("k"), "path"))
    reviewed = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "9"), ("z", "0")], "path string, digest string")
    conflicts = spark.createDataFrame([("kb",), ("kb",), ("kc",), ("other",)], "crop_id string")
    states = joins.review_partition(kept, m, reviewed, conflicts)
    assert {r.path: (r.state, r.problem) for r in states.collect()} == {"a": ("admitted", None), "b": ("quarantined", None), "c": ("removed", None), "d": ("modified", "reviewed_modified"), "z": ("unknown", "unknown_reviewed")}
    assert not joins.conservation_check(states).first().conserved and joins.conservation_check(states.where("problem is null")).first().conserved
    # candidates must stay as they were; what isn't reviewed is removed, candidate or not
    moved = m.where("path <> 'a'").withColumn("digest", F.when(F.col("path") == "c", "x").otherwise(F.col("digest"))).union(spark.createDataFrame([("n", "7")], m.schema))
    found = {r.path: (r.state, r.problem) for r in joins.review_partition(kept, moved, m.where("path = 'b'"), conflicts.limit(0)).collect()}
    assert found == {"a": ("removed", "candidate_missing"), "b": ("admitted", None), "c": ("removed", "candidate_modified"), "d": ("removed", None), "n": ("unknown", "unknown_candidate")}
    files = spark.createDataFrame([("x/a.png",), ("y/b.png",), ("z/b.png",), ("q/c.png",)], "path string")
    found = joins.rebase_paths(spark.createDataFrame([("x/a.png",), ("old/b.png",), ("old/c.png",), ("old/d.png",)], "path string"), files)
    assert {r.path: r.how for r in found.collect()} == {"x/a.png": "recorded", "old/b.png": "ambiguous", "old/c.png": "renamed", "old/d.png": "missing"}
    rows, bad = joins.apply_decisions(m, spark.createDataFrame([("a", "keep"), ("b", "keep"), ("b", "drop"), ("c", "maybe"), ("z", "keep")], "path string, decision string"), "path")
    assert {r.path: r.decision for r in rows.collect()} == {"a": "keep", "b": "hold", "c": "hold", "d": "hold"} and {(r.path, r.problem) for r in bad.collect()} == {("b", "repeated"), ("c", "unknown"), ("z", "no_row")}
    one = joins.fingerprint(m.repartition(3)).first().fingerprint
    assert one == joins.fingerprint(m.repartition(1)).first().fingerprint and joins.tree_fingerprint(m).first().n_files == 4
    assert joins.verify_digests(m, files.withColumn("digest", F.lit("1"))).count() == 4


DETECTIONS = "image string, rendered string, error string, detections array<struct<hand_flag_score:double,landmarks_roi_norm:array<array<double>>>>"


def detected(flag=0.9, dx=0.0, scale=1.0):
    return (flag, [[x, y] for _, x, y in pose(dx, scale)])


def test_paired_detections(spark):
    a = spark.createDataFrame([("i", None, None, [detected(), detected()]), ("j", None, None, None), ("k", None, None, [detected()]), ("gone", None, None, [])], DETECTIONS)
    b = spark.createDataFrame([("i", "i.png", "", [detected(0.2, 0.5, 0.1)]), ("j", None, "broken", []), ("k", None, None, [detected(dx=0.03)]), ("new", None, None, [])], DETECTIONS)
    got = {r.image: r for r in joins.paired_detections(a, b).collect()}
    # one detection less (3), no hand (2), one collapsed (1)
    assert {k: r.failure_score for k, r in got.items()} == {"i": 6.0, "j": 1.0, "k": 0.0}
    assert got["k"].mean_move == pytest.approx(0.03) and got["j"].mean_move is None and got["i"].rendered == "i.png"
    summary = detections.inference_summary(b).first()
    assert (summary.images, summary.failed, summary.detections, summary.hands, summary.collapsed) == (4, 1, 2, 1, 1)


def test_review_queues_share_one_limit(spark):
    paired = spark.createDataFrame([("a", 2.0, 1.0, 0.05), ("b", 1.0, -2.0, 0.5), ("c", 9.0, None, None), ("d", None, None, 0.01)], "roi_id string, candidate_px double, delta_px double, candidate_spread double")
    inferred = spark.createDataFrame([("x", 3.0), ("y", 0.0), ("z", 5.0)], "image string, failure_score double")
    cases = lambda n: [(r.category, r.position, r.key) for r in mining.review_queues(paired, inferred, n).collect()]
    assert sorted(cases(4)) == [("high_landmark_error", 1, "c"), ("improved_vs_baseline", 1, "b"), ("palm_or_roi_failure", 1, "z"), ("student_collapse", 1, "d")]
    assert sorted(cases(2)) == [("high_landmark_error", 1, "c"), ("student_collapse", 1, "d")]
    assert len(cases(40)) == 2 + 3 + 2 + 2


# contracts

def whole(i, **more):
    """A training row that keeps the contract."""
    row = label(i, **{k: v for k, v in more.items() if k in label(i)})
    pts = row["points"] or []
    px = [(k, 255 * x, 255 * y) for k, x, y in pts]
    rest = dict(crop_path="c.png", palm_score=0.9, rect=(0.5, 0.5, 0.2, 0.2, 0.0), corners=[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]], points_px=px, points_image=px, label_origin="mediapipe", hand_id=None, label_score=None)
    return row | rest | more


WHOLE = SCHEMA + f", crop_path string, palm_score double, rect {contracts.RECT}, corners array<array<double>>, points_px {POINTS}, points_image {POINTS}, label_origin string, hand_id string, label_score double"
WHOLE_NAMES = [f.split()[0] for f in WHOLE.replace(POINTS, "P").replace(contracts.RECT, "R").split(", ")]


def whole_table(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in WHOLE_NAMES) for r in rows], WHOLE)


def test_row_contract(spark):
    negative = dict(present=False, handedness="unknown", points=None, points_px=None, points_image=None)
    given_rows = [
        whole(0), whole(1, **negative), whole(2, points=pose()[:20]), whole(3, capture_source_id="x"), whole(4, crop_path=""), whole(5, handedness="nope"),
        whole(6, points_image=[(k, float("nan"), 0.0) for k in range(21)]), whole(7, points_px=[(k, 256 * x, y) for k, x, y in pose()]), whole(8, points=[(k // 2, x, y) for k, x, y in pose()]),
        whole(9, **negative | {"handedness": "Left", "hand_id": "h"}), whole(10, rect=(0.5, 0.5, 0.0, 0.2, float("inf"))), whole(11, corners=[[0.0, 0.0]]), whole(12, palm_score=None), whole(13, split="val", capture_source_id="white-near-bright-c1-train-s01-p1"),
        whole(14, label_score=float("nan")), whole(15, points=[(k, x + 0.9, y) for k, x, y in pose()], points_px=[(k, 255 * (x + 0.9), 255 * y) for k, x, y in pose()]),
    ]
    checked = contracts.row_errors(contracts.canonicalize(whole_table(spark, given_rows), "geometry"), "geometry")
    got = {int(r.roi_id[1:]): (r.errors, r.warnings) for r in checked.collect()}
    assert {k: e for k, (e, _) in got.items() if e} == {
        2: ["points_image_not_21", "points_not_21", "points_px_not_21"], 3: ["bad_capture_id"], 4: ["missing_crop_path"], 5: ["bad_handedness"], 6: ["points_image_not_finite"], 7: ["points_px_disagree"], 8: ["points_bad_ids", "points_image_bad_ids", "points_px_bad_ids"],
        9: ["negative_with_hand", "negative_with_hand_id"], 10: ["bad_rect", "rect_without_area"], 11: ["bad_corners"], 12: ["bad_palm_score"], 13: ["capture_split_differs"], 14: ["bad_handedness_score"],
    }
    assert [k for k, (_, w) in got.items() if w] == [15]
    good = contracts.canonicalize(whole_table(spark, [whole(0)]), "geometry")
    for column, value, want in (
        ("training_stage", "x", ["wrong_stage"]), ("selection_action", "hold", ["not_included"]), ("supervision_tier", "silver", ["bad_supervision_tier"]), ("annotation_provenance", "human_gold", ["provenance_conflicts"]),
        ("quality_tier", "LOW", ["bad_quality_tier"]), ("sampling_bucket", "", ["missing_sampling_bucket"]), ("sample_type", "POS", ["bad_sample_type"]), ("sample_type", "POS_LOW_PALM", ["wrong_sample_type"]),
        ("sampling_weight", -1.0, ["bad_sampling_weight"]), ("landmark_loss_weight", 0.5, ["landmark_loss_weight_not_a_mask"]), ("ignore_for_training", True, ["ignored_row"]), ("width", 255, ["wrong_size"]),
        ("schema_version", "old", ["wrong_schema_version"]), ("crop_id", "other", ["crop_id_differs"]), ("label_origin", "a_human_corrected", ["provenance_conflicts"]),
    ):
        assert contracts.row_errors(good.withColumn(column, F.lit(value)), "geometry").first().errors == want, column
    for column in ("quality_flags", "palm_valid", "present"):
        assert f"missing_{'presence' if column == 'present' else column}" in contracts.row_errors(good.withColumn(column, F.lit(None).cast(good.schema[column].dataType)), "geometry").first().errors
    held = contracts.canonicalize(whole_table(spark, [whole(0, split="val", capture_source_id="white-near-bright-c1-val-s01-p1")]), None)
    assert contracts.eval_row_errors(held, "val").first().errors == [] and contracts.eval_row_errors(held.withColumn("ground_truth_valid", F.lit(None).cast("boolean")), "test").first().errors == ["invalid_ground_truth", "wrong_split"]


def test_canonical_rows(spark):
    rows = whole_table(spark, [whole(0, handedness="left"), whole(1, present=None, label_origin="x_human_corrected")]).withColumns({"_path": F.lit("p"), "proposal_kind": F.when(F.col("roi_id") == "r0", "low_palm")})
    pseudo, gold = (contracts.canonicalize(rows, "multitask", role).orderBy("roi_id").collect() for role in ("base", "hard"))
    assert [r.sampling_bucket for r in pseudo] == ["pseudo:POS_LOW_PALM", "pseudo:NEG_RUNTIME_CANDIDATE"] and pseudo[0].handedness == "Left"
    assert [r.annotation_provenance for r in pseudo] == ["mediapipe_pseudo", "human_gold"] and {r.annotation_provenance for r in gold} == {"human_gold"}
    assert (pseudo[0].landmark_loss_weight, pseudo[1].landmark_loss_weight, pseudo[1].points) == (1.0, 0.0, None) and "_path" not in pseudo[0].asDict()


def test_reasons_weights_actions_and_filters(spark):
    rows = contracts.canonicalize(whole_table(spark, [whole(0), whole(1, points=[(0, 2.0, 0.0), (0, 0.0, 0.0)]), whole(2, present=False), whole(3, points=[(k, x + 1.0, y) for k, x, y in pose()])]), "geometry", "hard")
    reasoned = contracts.positive_reasons(rows, ("HIGH",))
    assert [r.reasons for r in reasoned.orderBy("roi_id").collect()] == [[], ["INVALID_LANDMARKS"], ["INVALID_LANDMARKS", "INVALID_POSITIVE_SAMPLE_TYPE"], ["LANDMARK_OUT_OF_ALLOWED_RANGE"]]
    heads = contracts.head_weights(rows.withColumn("landmark_quality_weight", F.lit(0.5)), {"gold": 2.0}).orderBy("roi_id").collect()
    assert [(r.presence_weight, r.landmark_weight, r.handedness_weight) for r in heads] == [(2.0, 1.0, 2.0), (2.0, 1.0, 2.0), (2.0, 0.0, 0.0), (2.0, 1.0, 2.0)]
    with pytest.raises(Exception, match="no weight for tier gold"):
        contracts.head_weights(rows, {"pseudo": 1.0}).collect()
    cases = reasoned.crossJoin(spark.createDataFrame([(0, "CONFIRMED_NEGATIVE", False), (4, "CONFIRMED_NEGATIVE", False), (0, None, True)], "overlap int, decision string, held_out boolean"))
    got = {(r.roi_id, r.overlap, r.held_out): (r.action, r.reasons) for r in contracts.decision_rows(cases).collect()}
    assert got["r0", 0, False] == ("INCLUDE_LANDMARKS", []) and got["r1", 0, False][0] == "QUARANTINE_POSITIVE" and got["r0", 0, True] == ("HOLDOUT_TEACHER_EVAL", ["AUTOMATIC_TEACHER_HOLDOUT"])
    assert got["r2", 0, False] == ("INCLUDE_CONFIRMED_NEGATIVE", ["HUMAN_CONFIRMED_NEGATIVE"]) and got["r2", 0, True][0] == "EXCLUDE_HOLDOUT_DATASET"
    assert got["r2", 4, False] == ("HOLD_NEGATIVE_CANDIDATE", ["NEGATIVE_OVERLAPS_CONFIRMED_HAND", "REVIEW_CONFLICTS_CONFIRMED_HAND_OVERLAP"])
    reviewed = rows.withColumns({"presence_decision": F.when(F.col("present"), "hand").otherwise("hand"), "handedness_decision": F.upper("handedness"), "source_sha256": F.lit("s"), "task_sha256": F.lit("")})
    sources = spark.createDataFrame([("ds-0", "s", "reviewed"), ("ds-1", "t", "external_gold")], "dataset_id string, sha256 string, source_kind string")
    assert [r.errors for r in contracts.gold_row_errors(reviewed, sources).orderBy("roi_id").collect()] == [["task_digest_missing"], ["source_digest_differs"], ["presence_not_decided", "task_digest_missing"], ["source_digest_differs"]]
    scores = spark.createDataFrame([(0.5,), (0.49,), (float("nan"),), (float("inf"),), (None,)], "score double")
    assert [r.score for r in contracts.score_filter(scores, 0.5).collect()] == [0.5]
    turned = contracts.augment_points(rows, 5).orderBy("roi_id").collect()
    assert turned == contracts.augment_points(rows.repartition(5), 5).orderBy("roi_id").collect()
    assert {r.category for r in contracts.smoke_category(rows).collect()} == {"gold_positive", "gold_negative"}
    evidence = spark.createDataFrame([(False, "INCLUDE_CONFIRMED_NEGATIVE", "CONFIRMED_NEGATIVE", "me"), (False, "INCLUDE_CONFIRMED_NEGATIVE", "CONFIRMED_NEGATIVE", " "), (True, "INCLUDE_CONFIRMED_NEGATIVE", "CONFIRMED_NEGATIVE", "me"), (False, None, "CONFIRMED_NEGATIVE", "me")], "p boolean, a string, d string, who string")
    assert [r[0] for r in evidence.select(contracts.confirmed_negative(F.col("p"), F.col("a"), F.col("d"), F.col("who"))).collect()] == [True, False, False, False]
    sent, lacking = contracts.review_request(rows, "check", ["dataset_id", "handedness"], ["hand_flag"])
    assert sent.count() == 4 and lacking.count() == 0 and sent.first().role == "check"
    assert contracts.drop_internal(rows.withColumn("_x", F.lit(1))).columns == rows.columns
    vectors = spark.createDataFrame([([0.1] * 42, 0.5, 0.5), ([0.1] * 41, 1.5, float("nan"))], "vector array<double>, hand_flag double, handedness_score double")
    assert [r.errors for r in contracts.decode_landmark_vectors(vectors).collect()] == [[], ["bad_flag", "bad_handedness", "bad_vector"]]


# detections

def test_suppression(spark):
    rows = spark.createDataFrame([("i", 1, 0.0, 0.0, 1.0, 1.0, 0.90, 0), ("i", 2, 0.05, 0.0, 1.05, 1.0, 0.80, 0), ("i", 3, 3.0, 3.0, 4.0, 4.0, 0.70, 1), ("j", 4, 0.0, 0.0, 1.0, 1.0, float("nan"), 1), ("j", 5, 0.0, 0.0, 1.0, 1.0, 0.5, 1)], "image string, box_id long, x1 double, y1 double, x2 double, y2 double, score double, head int")
    assert sorted((r.image, r.box_id, r["rank"]) for r in detections.nms(rows, 0.1, 2).collect()) == [("i", 1, 1), ("i", 3, 2), ("j", 5, 1)]
    assert sorted(r.box_id for r in detections.nms_two_stage(rows.where("box_id <> 4"), 0.1, 0.1, 5).collect()) == [1, 3, 5]


BOXES = "image string, box_id long, x1 double, y1 double, x2 double, y2 double, score double, head int"


def box(image, box_id, x, score, head, side=1.0):
    return (image, box_id, x, 0.0, x + side, side, score, head)


def test_two_stage_suppression_ranks_both_heads_by_score(spark):
    weak_head_0 = [box("a", 1, 0.0, 0.3, 0), box("a", 2, 5.0, 0.2, 0), box("a", 3, 10.0, 0.9, 1)]
    head_1_only = [box("b", 1, 0.0, 0.9, 1), box("b", 2, 0.7, 0.8, 1)]  # their overlap lies between the two limits
    one_more = [box("c", i, 5.0 * i, 0.1 * i, 0) for i in range(3)] + [box("c", 8, 50.0, 0.9, 1), box("c", 9, 60.0, 0.8, 1)]
    got = detections.nms_two_stage(spark.createDataFrame(weak_head_0 + head_1_only + one_more, BOXES), 0.3, 0.1, 2).orderBy("image", "rank").collect()
    assert [r.box_id for r in got if r.image == "a"] == [3, 1] and [r.box_id for r in got if r.image == "b"] == [1]
    assert [r.box_id for r in got if r.image == "c"] == [8, 2]  # head 1 stops at the box that makes k


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 8), st.integers(0, 8), st.integers(1, 6), st.integers(0, 5)), max_size=14))
def test_suppression_equals_a_plain_version(spark, cells):
    rows = [("i", k, x / 4, y / 4, (x + w) / 4, (y + 3) / 4, s / 10, h) for k, (h, x, y, w, s) in enumerate(cells)]
    covers = lambda a, b, t: (both := max(0, min(a[4], b[4]) - max(a[2], b[2])) * max(0, min(a[5], b[5]) - max(a[3], b[3]))) / ((a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - both + 1e-6) > t
    best = sorted(rows, key=lambda r: (-r[6], r[1]))
    first = []
    for r in best:
        if r[7] == 0 and not any(covers(q, r, 0.3) for q in first):
            first.append(r)
    both = list(first)
    for r in best:
        if r[7] == 1 and not any(covers(q, r, 0.1) for q in both):
            both.append(r)
            if len(both) >= 3:
                break
    got = detections.nms_two_stage(spark.createDataFrame(rows, BOXES), 0.3, 0.1, 3).orderBy("rank").collect() if rows else []
    assert [r.box_id for r in got] == [r[1] for r in sorted(both, key=lambda r: (-r[6], r[1]))[:3]]


def test_anchors_and_rotated_overlap(spark):
    table_ = detections.anchors(spark, [(14, 24, 2), (7, 12, 2)])
    first = table_.orderBy("anchor_id").first()
    assert table_.count() == 840 and (first.cx, first.cy) == (pytest.approx(1 / 48), pytest.approx(1 / 28))
    raw = spark.createDataFrame([("i", 0, 0.0, 0.0, math.log(0.2), -50.0, 0.0)], "image string, anchor_id long, dx double, dy double, w double, h double, logit double")
    box = detections.decode_boxes(raw, table_).first()
    assert box.x2 - box.x1 == pytest.approx(0.2) and box.y2 - box.y1 == pytest.approx(math.exp(-10)) and box.score == 0.5
    square, moved = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]], [[0.5, 0.0], [1.5, 0.0], [1.5, 1.0], [0.5, 1.0]]
    pairs = spark.createDataFrame([(square, square), (square, moved), (square, [[0.5, -0.2], [1.2, 0.5], [0.5, 1.2], [-0.2, 0.5]])], "quad_a array<array<double>>, quad_b array<array<double>>")
    iou = [r.iou for r in detections.rotated_iou(pairs).collect()]
    assert iou[0] == pytest.approx(1) and iou[1] == pytest.approx(1 / 3) and iou[2] == pytest.approx((0.98 - 0.16) / (1 + 0.16), abs=0.08)
    odd = [(square, [[5.0, 5.0], [6.0, 5.0], [6.0, 6.0], [5.0, 6.0]]), (square, moved[::-1]), (square, [[0.0, 0.0]] * 4), (square, [[0.25, 0.25], [0.75, 0.25], [0.75, 0.75], [0.25, 0.75]]), (square, [[1.0, 0.0], [2.0, 0.0], [2.0, 1.0], [1.0, 1.0]])]
    got = [r.iou for r in detections.rotated_iou(spark.createDataFrame(odd, "quad_a array<array<double>>, quad_b array<array<double>>")).collect()]
    assert got == pytest.approx([0.0, 1 / 3, 0.0, 0.25, 0.0])


def test_turned_overlaps_are_cut_in_batches(spark):
    def turned(angle, size, x=0.0, y=0.0):
        c, s = size * math.cos(angle) / 2, size * math.sin(angle) / 2
        return [[x + dx * c - dy * s, y + dx * s + dy * c] for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1))]

    octagon = 2 * (math.sqrt(2) - 1)  # what a unit square and itself turned by 45 degrees share
    cases = [(turned(0, 1), turned(math.pi / 4, 1), octagon / (2 - octagon)), (turned(0.3, 1), turned(0.3, 1), 1.0), (turned(0.3, 2)[::-1], turned(1.1, 1)[::-1], 0.25), (turned(0.3, 1), turned(1.1, 1, 3.0), 0.0), (None, turned(0, 1), 0.0)]
    pairs = spark.createDataFrame([(*c, k) for k in range(3) for c in cases], "quad_a array<array<double>>, quad_b array<array<double>>, want double, k int")
    found = detections.rotated_iou(pairs)
    assert [r.iou for r in found.collect()] == pytest.approx([c[2] for c in cases] * 3)
    plan = found._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan  # no loop over a row's corners


def test_predictor_must_cover_its_batch(spark):
    rows = table(spark, [label(i) for i in range(40)]).select("roi_id").repartition(3)
    schema, sizes = "roi_id string, s double", spark.sparkContext.accumulator(0)

    def good(model, batch):
        sizes.add(len(batch) == 7)
        assert len(batch) <= 7
        return batch.assign(s=model["s"])

    assert {r.s for r in scoring.score_rows(rows, good, schema, {"s": 2.5}, 7).collect()} == {2.5} and sizes.value >= 3
    with pytest.raises(Exception, match="for a batch of"):
        scoring.score_rows(rows, lambda m, b: b.assign(s=1.0).iloc[1:], schema)
    # right in number inside each batch, but one id twice and one missing
    with pytest.raises(ValueError, match="each id once"):
        scoring.score_rows(rows, lambda m, b: b.assign(s=1.0).replace("r1", "r2"), schema, None, 2)
    for bad in (rows.union(rows.limit(1)), rows.union(spark.createDataFrame([(None,)], "roi_id string"))):
        with pytest.raises(ValueError, match="unique ids"):
            scoring.score_rows(bad, lambda m, b: b.assign(s=1.0), schema)


def test_rounds_share_no_token(spark):
    teachers = spark.createDataFrame([(f"r{i}", f"d{i % 2}", "POS", f"s{i // 2}", [f"img:{i // 3}"], pose()) for i in range(60)], "roi_id string, dataset_id string, sample_type string, source_sequence_id string, tokens array<string>, points array<struct<id:int,x:double,y:double>>")
    predictions = spark.createDataFrame([(f"r{i}", pose(i / 100), 0.9) for i in range(60)], "roi_id string, predicted array<struct<id:int,x:double,y:double>>, hand_flag double")
    ledger = spark.createDataFrame([("img:0", "old")], "token string, round_id string")
    recorded, taken = spark.createDataFrame([("x",), ("y",)], "roi_id string"), []
    for k in range(3):
        chosen, ledger = selection.disagreement_round(teachers, predictions, ledger, recorded, 6, f"r{k}", {"POS": 1.0}, "z")
        taken.append({t for r in chosen.collect() for t in r.tokens})
        assert chosen.count() == 4
    assert not taken[0] & taken[1] and not taken[2] & (taken[0] | taken[1]) and "img:0" not in set.union(*taken)
    assert ledger.count() == 1 + sum(map(len, taken))
    with pytest.raises(ValueError, match="in the ledger"):
        selection.disagreement_round(teachers, predictions, ledger, recorded, 6, "r1", {"POS": 1.0}, "z")
    with pytest.raises(ValueError, match="exceed"):
        selection.disagreement_round(teachers, predictions, ledger, recorded, 1, "r9", {"POS": 1.0}, "z")


# mining

def test_rounds_never_repeat(spark):
    rows = spark.createDataFrame([("a", 0.9, 1.0), ("b", 0.8, 1.0), ("c", 0.7, 1.0)], "roi_id string, difficulty double, error_px double")
    none = spark.createDataFrame([], "roi_id string, round_id int")
    one = mining.mine_round(rows, none, 1, 1).select("roi_id", "round_id")
    two = mining.mine_round(rows, one, 2, 2).select("roi_id", "round_id")
    assert [r.roi_id for r in one.collect()] == ["a"] and sorted(r.roi_id for r in two.collect()) == ["b", "c"]
    with pytest.raises(ValueError):
        mining.mine_round(rows, one, 1, 1)


def test_scores_of_rows(spark):
    scored = mining.difficulty(mining.score_rows(table(spark, [label(0), label(1, hand="unknown"), label(2, present=False), label(3, split="val"), label(4, predicted=False)])))
    got = {r.roi_id: r for r in scored.collect()}
    assert set(got) == {"r0", "r1"} and got["r0"].handedness_error == pytest.approx(0.2) and got["r1"].handedness_error == 0 and got["r0"].error_rank == 0.5
    assert mining.source_report(scored).first().source_rank == 1
    ranked = mining.disagreement_score(table(spark, [label(i) for i in range(3)]))
    assert ranked.count() == 3 and ranked.first().disagreement == pytest.approx(0.5 * 2.5)


# telemetry

def frames(n, run=1):
    return [(run, i, 1.0, 0.0, 0.0, 1.0, 5.0 + (i % 7), 4.0) for i in range(n)]


FRAMES = "run_id long, frame_index long, get_image_ms double, palm_total_ms double, hand_total_ms double, draw_ms double, loop_ms double, process_ms double"


def test_windows_leave_out_the_last_incomplete_one(spark):
    got = telemetry.frame_windows(spark.createDataFrame(frames(250), FRAMES), 120).orderBy("window").collect()
    assert [(r.window, r.frames, r.frame_index) for r in got] == [(0, 120, 119), (1, 120, 239)]
    assert got[0].loop_ms_p95 == sorted(5.0 + i % 7 for i in range(120))[113]
    scores = telemetry.window_scores(telemetry.frame_windows(spark.createDataFrame(frames(250), FRAMES), 120)).orderBy("window").collect()
    assert scores[1].total_frames == 240 and scores[0].realtime_score == 10 and scores[0].latency_score == 10
    counted = telemetry.infer_counts(telemetry.frame_windows(spark.createDataFrame(frames(250), FRAMES), 120), 3).orderBy("window").collect()
    assert [r.n_infer for r in counted] == [40, 40]
    totals = telemetry.run_metrics(telemetry.frame_windows(spark.createDataFrame(frames(250), FRAMES), 120)).first()
    assert (totals.windows, totals.frames) == (2, 240)
    assert (totals.last_total_frames, totals.inferences, totals.hand_calls) == (240, 240, 240)
    parts = telemetry.p95_breakdown(telemetry.frame_windows(spark.createDataFrame(frames(250), FRAMES), 120))
    assert {r.segment: r.ms for r in parts.collect()} == {"get_image": 1.0, "draw": 1.0, "process_overhead": 3.0, "loop_overhead": 6.0}
    # early windows begin at frame 0
    early = spark.createDataFrame([(1, 5, 120)], "run_id long, frame_index long, frames long")
    assert telemetry.infer_counts(early, 3, "palm").select("n_infer", "n_hand_calls").first() == (2, 0)


def test_p95_segments(spark):
    names = {"get_image": 2.0, "palm_total": 10.0, "palm_preprocess_transform": 1.0, "palm_preprocess_manual_load": 0.1, "palm_input_load": 0.05, "palm_inference": 6.0, "palm_getoutput": 0.5, "palm_decode": 0.5, "hand_total": 4.0, "draw": 1.0, "process": 17.0, "loop": 20.0}
    windows = spark.createDataFrame([(1, *names.values()), (1, *(0.0 for _ in names))], "run_id int, " + ", ".join(f"{n}_ms_p95 double" for n in names))
    got = lambda mode: {r.segment: round(r.ms, 6) for r in telemetry.p95_breakdown(windows, mode).collect()}
    both = {"get_image": 2.0, "palm_transform": 1.0, "palm_inference": 6.0, "palm_postprocess": 1.0, "palm_other": 1.85, "hand_total": 4.0, "draw": 1.0, "process_overhead": 2.0, "loop_overhead": 1.0, "small_stages": 0.15}
    assert got("palm_hand") == both and got("palm") == {k: v for k, v in both.items() if k != "hand_total"} | {"process_overhead": 6.0}


def test_log_lines(spark):
    lines = ["[PERF][config] fps=60", "[PERF][stage_ms] a=1", "[PERF][summary] frame=1", "[PERF][config] fps=90", '[PERF][stage_ms] a=2 b="3.5" c=x', "noise", "[PERF][summary] frame=2", "[PERF][stage_ms] a=4"]
    parsed = telemetry.parse_lines(spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "run_id long, line_no int, line string"))
    assert telemetry.last_config(parsed).first().value == "90" and telemetry.orphans(parsed).count() == 1
    rolled = {r.metric: (r.windows, r["mean"], r.latest) for r in telemetry.window_rollup(telemetry.log_metrics(parsed)).collect()}
    assert rolled["stage_ms.a"] == (2, 3.0, 4.0) and rolled["stage_ms.b"] == (1, 3.5, 3.5) and "stage_ms.c" not in rolled
    # a prefix before the report, a key twice (the last holds) and a section twice (the last replaces it)
    odd = ["12:00 [PERF][summary] frame=1 frame=2", "x [PERF][stage_ms] a=1 b=7", "[PERF][stage_ms] a=2"]
    again = telemetry.log_metrics(telemetry.parse_lines(spark.createDataFrame([(1, i, x) for i, x in enumerate(odd)], "run_id long, line_no int, line string")))
    assert {r.metric: r.value for r in again.collect()} == {"summary.frame": 2.0, "stage_ms.a": 2.0}
    each = telemetry.per_inference(telemetry.window_rollup(telemetry.log_metrics(parsed)), 3).where("metric = 'stage_ms.a'").first()
    assert each.per_inference == 12.0


def test_set_operations(spark):
    a, b = spark.createDataFrame([(1, "x"), (1, "x")], "id int, v string"), spark.createDataFrame([(2,), (1,)], "id int")
    assert sets.union_all(a, b).columns == ["id", "v"] and sets.common(a.select("id"), b).count() == 1
    assert sets.only_left(a.select("id"), b).count() == 0 and sets.only_left(a.select("id"), b.where("id = 1"), keep_repeats=True).count() == 1
    assert [r.id for r in sets.ordered_output(b, "id").collect()] == [1, 2] and sets.all_tokens(b, b).count() == 2


def test_first_row_of_an_ordered_output(spark):
    from tessera.plans import catalog

    rows = spark.range(0, 400, 1, 8).select((399 - F.col("id")).alias("id"))
    assert [r.id for r in sets.first_ordered(sets.ordered_output(rows, "id", partitions=8)).collect()] == [0]
    assert sets.first_ordered(sets.ordered_output(rows.where("id < 0"), "id")).collect() == []
    # on a cluster a limit takes the row of whichever task is read first
    assert "Limit" not in catalog.queries()["set_operations"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()


# selection

POOL = "id int, dataset_id string, sample_type string, source_sequence_id string, score double, tokens array<string>"


def pool(spark, n=60):
    return spark.createDataFrame([(i, f"d{i % 3}", f"t{i % 2}", f"s{i // 2}", float(i), [f"k{i}"]) for i in range(n)], POOL)


def test_selection_keeps_quotas_caps_and_occupied_rows(spark):
    occupied = spark.createDataFrame([("k59",), ("k58",)], "token string")
    got = selection.select(pool(spark), occupied, {"t0": 0.5, "t1": 0.5}, 20, 8, "s", "score")
    sizes = dict(got.groupBy("dataset_id").count().collect())
    assert got.count() == 20 and max(sizes.values()) <= 8 and got.where("id >= 58").count() == 0
    assert dict(got.groupBy("sample_type").count().collect()) == {"t0": 10, "t1": 10}
    evidence = spark.createDataFrame([(1, "negative_removed"), (2, "quarantine"), (99, "negative_removed")], "id int, partition string")
    chosen, wrong = selection.select_removed(evidence, pool(spark), occupied, {"t0": 1.0, "t1": 1.0}, 5, None, "s")
    assert [r.id for r in chosen.collect()] == [1] and sorted((r.id, r.problem) for r in wrong.collect()) == [(2, "not_removed"), (99, "not_in_catalog")]


def test_disagreement_selection_wants_full_coverage(spark):
    teachers = table(spark, [label(i) for i in range(6)]).drop("predicted", "hand_flag", "handedness_score").withColumns({"sample_type": F.lit("POS_RUNTIME"), "source_sequence_id": F.col("roi_id"), "tokens": F.array("roi_id")})
    students = table(spark, [label(i) | {"predicted": pose(0.01 * i)} for i in range(6)]).select("roi_id", "predicted", "hand_flag")
    none = spark.createDataFrame([], "token string")
    got = selection.select_disagreement(teachers, students, none, {"POS_RUNTIME": 1.0}, 2, None, "s")
    assert sorted(r.roi_id for r in got.collect()) == ["r4", "r5"]
    with pytest.raises(ValueError):
        selection.select_disagreement(teachers, students.limit(3), none, {"POS_RUNTIME": 1.0}, 2, None, "s")


def test_stages(spark):
    base = spark.createDataFrame([(f"b{i}", True, 1.0) for i in range(4)], "roi_id string, present boolean, weight double")
    hard = spark.createDataFrame([("b0", True, 1.0), ("h", False, 1.0)], "roi_id string, present boolean, weight double")
    assert selection.stage_members("geometry", base).count() == 4
    assert selection.stage_members("multitask", base, negatives=hard.where("not present")).count() == 5
    mixed = selection.stage_members("multi_finetune", base, hard=hard, hard_fraction=0.6)
    sums = dict(mixed.groupBy("mix_role").agg(F.round(F.sum("mix_weight"), 9)).collect())
    assert mixed.count() == 5 and sums == {"hard": 0.6, "replay": 0.4}
    for stage, more in (("geometry", {"negatives": hard}), ("multitask", {}), ("multi_finetune", {}), ("other", {})):
        with pytest.raises(ValueError):
            selection.stage_members(stage, base, **more)
    with pytest.raises(ValueError):
        selection.stage_members("geometry", hard)


def test_smoke_set_has_both_hands(spark):
    rows = spark.createDataFrame([(i, "gold" if i % 2 else "pseudo", i % 5 != 0, True, "Right" if i == 7 else "Left", f"s{i}") for i in range(60)], "id int, supervision_tier string, present boolean, palm_valid boolean, handedness string, source_sequence_id string")
    rows = rows.withColumn("sample_type", contracts.sample_type(F.col("present"), F.col("palm_valid")))
    got = selection.smoke_set(contracts.smoke_category(rows), {"gold_positive": 5, "pseudo_positive": 5, "gold_negative": 2, "pseudo_neg_runtime": 2, "pseudo_neg_low": 3}, "s")
    assert {"Left", "Right"} <= {r.handedness for r in got.where("present").collect()}
    assert dict(got.groupBy("category").count().collect()) == {"gold_positive": 5, "pseudo_positive": 5, "gold_negative": 2, "pseudo_neg_runtime": 2}


def test_variants_of_another_release_are_no_violation(spark):
    rows = [("a", "1", "train", "v1", None), ("a", "2", "train", "v2", "neg"), ("b", "3", "train", "v1", ""), ("b", "4", "train", "v2", None)]
    rows = spark.createDataFrame(rows, "capture_source_id string, raw_image_id string, split string, proposal_variant string, negative_dataset_id string")
    assert [(r.check, r.key) for r in joins.membership_violations(rows).collect()] == [("capture_variants", "b")]


def test_run_summary_has_the_p90_error(spark):
    rows = spark.range(11).selectExpr("double(id) as error_px", "double(1) as nme", "double(1) as bone_error", "double(1) as predicted_spread", "true as present", "true as predicted_present", "'Left' as handedness", "'Left' as predicted_handedness", "array(double(1)) as errors_px")
    assert metrics.run_summary(rows).first().p90_px == 9.0
