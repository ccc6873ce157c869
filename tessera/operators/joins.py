"""Registry, coverage, leakage, supersede, diff and review joins. Violations come as tables; require_empty() raises on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import points as P
from .detections import collapsed, flagged


def require_empty(violations: DataFrame, what: str) -> None:
    """Raises with a few examples if there are violations."""
    if found := violations.limit(5).collect():
        raise ValueError(f"{what}: {[r.asDict() for r in found]}")


def _equal(columns: list[str], a: str, b: str) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return same


def registry_mismatch(rows: DataFrame, registry: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows that the registry lacks or holds with other values: key, problem."""
    r = registry.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_r_{c}") for c in columns))
    joined = rows.join(r, F.col(key) == F.col("_key"), "left")
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    problem = F.when(F.col("_key").isNull(), "unregistered").when(differs, "different")
    return joined.select(key, problem.alias("problem")).where("problem is not null")


def mapping_diff(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that only one side has or that have different values: key, left_value, right_value, problem."""
    left, right = a.select(F.col(key), F.col(value).alias("left_value"), F.lit(1).alias("_l")), b.select(F.col(key), F.col(value).alias("right_value"), F.lit(1).alias("_r"))
    joined = left.join(right, key, "full_outer")
    problem = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").when(~F.col("left_value").eqNullSafe(F.col("right_value")), "different")
    return joined.select(key, "left_value", "right_value", problem.alias("problem")).where("problem is not null")


def coverage_problems(labels: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Keys without a prediction, predictions without a label, and keys that either side repeats."""
    a, b = labels.groupBy(key).agg(F.count("*").alias("n_labels")), predictions.groupBy(key).agg(F.count("*").alias("n_predictions"))
    joined = a.join(b, key, "full_outer").fillna(0, ["n_labels", "n_predictions"])
    problem = F.when(F.col("n_predictions") == 0, "missing").when(F.col("n_labels") == 0, "extra").when((F.col("n_labels") > 1) | (F.col("n_predictions") > 1), "duplicate")
    return joined.withColumn("problem", problem).where("problem is not null")


def coverage_join(labels: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """The 1:1 join; coverage_problems() tells what doesn't take part."""
    return labels.join(predictions, key)


def catalog_lookup(evidence: DataFrame, catalog: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Evidence with its catalog rows, and the evidence without one."""
    return evidence.join(catalog, key), evidence.join(catalog, key, "left_anti")


def restore_provenance(rows: DataFrame, registry: DataFrame, key: str, columns: list[str], compare: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with the registry's columns attached, and the rows whose `compare` values differ from it or that it lacks."""
    joined = rows.alias("l").join(registry.alias("r"), key, "left")
    ok = F.col(f"r.{(columns + compare)[0]}").isNotNull() & _equal(compare, "l", "r")
    return joined.where(ok).select("l.*", *(F.col(f"r.{c}") for c in columns if c not in rows.columns)), joined.where(~F.coalesce(ok, F.lit(False))).select("l.*")


def exclude_replay(base: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    return base.join(selected, key, "left_anti")


def exclude_occupied(rows: DataFrame, occupied: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """Rows none of whose identity tokens is occupied; occupied holds a column `token`."""
    hit = rows.select(key, F.explode(tokens).alias("token")).join(occupied.select("token").distinct(), "token", "left_semi").select(key).distinct()
    return rows.join(hit, key, "left_anti")


def token_conflicts(rows: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """Tokens that belong to more than one identity."""
    pairs = rows.select(key, F.explode(tokens).alias("token")).distinct()
    return pairs.groupBy("token").agg(F.count("*").alias("n"), F.min(key).alias("first"), F.max(key).alias("last")).where("n > 1")


def supersede(gold: DataFrame, replay: DataFrame, key: str, tokens: str = "tokens") -> tuple[DataFrame, DataFrame]:
    """Replay rows that share no token with gold, and an audit of the others: key, n_tokens, winner (the smallest gold key)."""
    g = gold.select(F.col(key).alias("winner"), F.explode(tokens).alias("token")).groupBy("token").agg(F.min("winner").alias("winner"))
    audit = replay.select(key, F.explode(tokens).alias("token")).distinct().join(g, "token").groupBy(key).agg(F.count("*").alias("n_tokens"), F.min("winner").alias("winner"))
    return replay.join(audit, key, "left_anti"), audit


def check_leakage(train: DataFrame, evaluation: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """Training keys that share a token with an evaluation row."""
    eval_tokens = evaluation.select(F.explode(tokens).alias("token")).distinct()
    return train.select(key, F.explode(tokens).alias("token")).join(eval_tokens, "token", "left_semi").groupBy(key).agg(F.min("token").alias("token"))


def leakage_pairs(rows: DataFrame, set_col: str, token_col: str, kind: Column | None = None) -> DataFrame:
    """(kind, left_set, right_set, n_tokens, n_rows): tokens that two sets share, from one shuffle on the token.

    Rows of a token in a set are counted before sets meet, so a token's sets are few however many rows hold it.
    """
    kind = kind if kind is not None else F.lit("exact")
    held = rows.where(F.col(token_col).isNotNull()).groupBy(kind.alias("kind"), F.col(token_col).alias("token"), F.col(set_col).alias("set")).agg(F.count("*").alias("n"))
    grouped = held.groupBy("kind", "token").agg(F.array_sort(F.collect_set(F.struct("set", "n"))).alias("sets")).where(F.size("sets") > 1)
    pairs = F.flatten(F.transform("sets", lambda a: F.transform(F.filter("sets", lambda b: b["set"] > a["set"]), lambda b: F.struct(a["set"].alias("left_set"), b["set"].alias("right_set"), (a["n"] + b["n"]).alias("n")))))
    return grouped.select("kind", F.explode(pairs).alias("p")).groupBy("kind", "p.left_set", "p.right_set").agg(F.count("*").alias("n_tokens"), F.sum("p.n").alias("n_rows"))


def membership_violations(rows: DataFrame) -> DataFrame:
    """(check, key, detail): captures and raw images in several splits, several variants of a capture, performers in several splits (a warning).

    Variants are compared within a release: rows with a negative_dataset_id or a hard_dataset_id (where there are such columns) are
    copies that keep the variant they were made of.
    """

    def several(check: str, key: Column, value: str, *within: Column) -> DataFrame:
        found = rows.groupBy(key.alias("key"), *within).agg(F.array_sort(F.collect_set(value)).alias("v")).where(F.size("v") > 1)
        return found.select(F.lit(check).alias("check"), "key", F.array_join("v", ",").alias("detail"))

    performer = F.get(F.split("capture_source_id", "-"), 6)
    releases = [F.concat(F.lit(f"{kind}:"), F.nullif(F.col(c).cast("string"), F.lit(""))) for kind, c in (("negative", "negative_dataset_id"), ("hard", "hard_dataset_id")) if c in rows.columns]
    out = several("capture_splits", F.col("capture_source_id"), "split")
    out = out.union(several("raw_image_splits", F.col("raw_image_id"), "split")).union(several("capture_variants", F.col("capture_source_id"), "proposal_variant", F.coalesce(*releases, F.lit("source"))))
    return out.union(several("performer_splits_warning", performer, "split"))


def duplicate_ids(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_content(rows: DataFrame, digest: str, key: str) -> DataFrame:
    """Digests of several rows: how many, and the smallest and largest key."""
    return rows.groupBy(digest).agg(F.count("*").alias("n"), F.min(key).alias("first"), F.max(key).alias("last")).where("n > 1")


def included_ignored_overlap(included: DataFrame, ignored: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value): identities on both sides, a few examples of each column."""

    def ids(df: DataFrame) -> DataFrame:
        entries = F.array_compact(F.array(*(F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))) for c in columns)))
        return df.select(F.explode(entries).alias("e")).select("e.*").distinct()

    return ids(included).intersect(ids(ignored))


def decorate(predictions: DataFrame, labels: DataFrame, key: str = "roi_id") -> DataFrame:
    """Predictions with their labels' columns, spreads, their ratio and the bone-vector error; labels may be missing."""
    rows = predictions.join(labels, key, "left")
    gold, own = P.diagonal(F.col("points")), P.diagonal(F.col("predicted"))
    return rows.withColumns({"gold_spread": gold, "predicted_spread": own, "spread_ratio": own / F.nullif(gold, F.lit(0.0)), "bone_error": P.bone_vector_error(F.col("points"), F.col("predicted"))})


def paired_runs(baseline: DataFrame, candidate: DataFrame, key: str = "roi_id", value: str = "error_px") -> DataFrame:
    """Keys of both runs with both errors, their difference and whether the candidate improved."""
    a, b = baseline.select(key, F.col(value).alias("baseline_px")), candidate.select(key, F.col(value).alias("candidate_px"))
    delta = F.col("candidate_px") - F.col("baseline_px")
    return a.join(b, key).select(key, "baseline_px", "candidate_px", delta.alias("delta_px"), F.when(delta < 0, "improved").when(delta > 0, "regressed").when(delta == 0, "equal").alias("outcome"))


def paired_detections(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """(image, error, rendered, detections) of two runs -> a row per image of both, with counts, the mean move of the points and a failure score.

    Detections are matched by position as far as both runs have them; a pair moves by its points' mean distance where both have
    21. The score adds 3 for each detection more or less, 2 for each candidate detection that no hand flag confirms, 1 for
    each collapsed one and 1 for an error of the candidate.
    """

    def held(df: DataFrame, name: str) -> Column:
        return F.coalesce("detections", F.array().cast(df.schema["detections"].dataType)).alias(name)

    a = baseline.where("image <> ''").select("image", held(baseline, "_a"))
    b = candidate.where("image <> ''").select("image", held(candidate, "_b"), "error", "rendered")
    shared = F.least(F.size("_a"), F.size("_b"))

    def move(p: Column, q: Column) -> Column:
        old, new = p["landmarks_roi_norm"], q["landmarks_roi_norm"]
        far = F.aggregate(F.zip_with(old, new, lambda x, y: F.hypot(y[0] - x[0], y[1] - x[1])), F.lit(0.0), lambda s, v: s + v)
        return F.when((F.size(old) == P.N_POINTS) & (F.size(new) == P.N_POINTS), far / P.N_POINTS)

    moves = F.filter(F.zip_with(F.slice("_a", F.lit(1), shared), F.slice("_b", F.lit(1), shared), move), lambda v: v.isNotNull() & ~F.isnan(v))
    rows = a.join(b, "image").select("image", "rendered", "error", F.size("_a").alias("baseline_count"), F.size("_b").alias("candidate_count"), flagged(F.col("_b")).alias("hand_count"), collapsed(F.col("_b")).alias("collapse_count"), moves.alias("_m"))
    mean = F.when(F.size("_m") > 0, F.aggregate("_m", F.lit(0.0), lambda s, v: s + v) / F.size("_m"))
    failed = (F.coalesce("error", F.lit("")) != "").cast("int")
    score = 3 * F.abs(F.col("baseline_count") - F.col("candidate_count")) + 2 * F.greatest(F.lit(0), F.col("candidate_count") - F.col("hand_count")) + F.col("collapse_count") + failed
    return rows.withColumn("mean_move", mean).withColumn("failure_score", score.cast("double")).drop("_m", "error")


def negative_overlap(negatives: DataFrame, positives: DataFrame, core_ids: list[int], frame: tuple[str, ...] = ("dataset_id", "source_group_id"), id_col: str = "roi_id") -> DataFrame:
    """Negatives with the most core points that one positive of the same frame has inside their ROI; the border counts as inside.

    A grid join: a ROI's box falls on four cells at most of a grid as wide as the box (rounded up to a power of two), a core point on one cell of
    each grid that occurs; only points and ROIs of one cell meet, and the polygon decides. So a frame with very many ROIs
    makes rows by what lies close together, not by all pairs. Points or ROIs that aren't finite meet nothing.
    """
    quad = negatives.withColumn("_quad", P.corners(F.col("rect")))
    xs, ys = F.transform("_quad", lambda c: c[0]), F.transform("_quad", lambda c: c[1])
    slack = 1e-3
    quad = quad.select(id_col, *frame, "_quad", (F.array_min(xs) - slack).alias("_x0"), (F.array_max(xs) + slack).alias("_x1"), (F.array_min(ys) - slack).alias("_y0"), (F.array_max(ys) + slack).alias("_y1"))
    side = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))
    quad = quad.where((F.abs("_x0") < 1e9) & (F.abs("_y0") < 1e9) & (side < 1e9)).withColumn("_level", F.ceil(F.log2(side)).cast("int"))
    levels = [r["_level"] for r in quad.select("_level").distinct().collect()]  # from -9 (the slack) to 30
    cell = lambda c, level: F.floor(c / F.pow(F.lit(2.0), level)).cast("long")
    spans = {n: F.explode(F.sequence(cell(F.col(f"_{n}0"), F.col("_level")), cell(F.col(f"_{n}1"), F.col("_level")))) for n in "xy"}
    quad = quad.withColumn("_cx", spans["x"]).withColumn("_cy", spans["y"])
    core = positives.select(*frame, F.col(id_col).alias("_pos"), F.explode(F.filter("points", lambda p: p["id"].isin(core_ids))).alias("_p"))
    core = core.where((F.abs("_p.x") < 1e9) & (F.abs("_p.y") < 1e9)).withColumn("_level", F.explode(F.array(*(F.lit(n) for n in levels)).cast("array<int>")))
    core = core.withColumns({"_cx": cell(F.col("_p.x"), F.col("_level")), "_cy": cell(F.col("_p.y"), F.col("_level"))})
    met = quad.join(core, [*frame, "_level", "_cx", "_cy"]).where(P.in_polygon(F.col("_p.x"), F.col("_p.y"), F.col("_quad")))
    most = met.groupBy(id_col, "_pos").agg(F.count_distinct("_p.id").cast("int").alias("_n")).groupBy(id_col).agg(F.max("_n").alias("overlap"))
    return negatives.join(most, id_col, "left").withColumn("overlap", F.coalesce("overlap", F.lit(0)))


def partition_check(catalog: DataFrame, included: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """Keys in both parts or in none, keys that the catalog lacks, rows that differ from the catalog's in any column, keys that a table
    repeats, and rows without a key (null or empty): key, problem.

    Rows are compared value by value (maps by their sorted entries), so a null differs from a value and a value in another column is found.
    """
    names = sorted(set(catalog.columns) | set(included.columns) | set(excluded.columns) - {key})

    def side(df: DataFrame, name: str) -> DataFrame:
        kinds = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))
        held = [(F.array_sort(F.map_entries(c)) if isinstance(kinds.get(c), T.MapType) else F.col(c) if c in kinds else F.lit(None).cast("string")).alias(c) for c in names]
        return df.groupBy(F.col(key).cast("string").alias("_key"), F.col(key).alias("_own")).agg(F.count("*").alias(f"{name}_n"), F.max(F.struct(*held)).alias(name)).drop("_own")

    rows = side(catalog, "_c").join(side(included, "_i"), "_key", "full_outer").join(side(excluded, "_e"), "_key", "full_outer")
    has_c, has_i, has_e = (F.col(f"{n}_n").isNotNull() for n in ("_c", "_i", "_e"))
    differs = (has_i & ~F.col("_i").eqNullSafe(F.col("_c"))) | (has_e & ~F.col("_e").eqNullSafe(F.col("_c")))
    problem = F.when(F.coalesce("_key", F.lit("")) == "", "no_key").when(F.greatest("_c_n", "_i_n", "_e_n") > 1, "repeated")
    problem = problem.when(has_i & has_e, "in_both").when(has_c & ~has_i & ~has_e, "in_none").when(~has_c, "not_in_catalog").when(differs, "different")
    return rows.select(F.col("_key").cast(catalog.schema[key].dataType).alias(key), problem.alias("problem")).where("problem is not null")


def snapshot_drift(old: DataFrame, new: DataFrame, key: str, digest: str) -> DataFrame:
    """Keys that came, went or changed their digest."""
    return mapping_diff(old, new, key, digest).select(key, F.when(F.col("problem") == "left_only", "removed").when(F.col("problem") == "right_only", "added").otherwise("modified").alias("change"))


MISSING = "<missing>"


def _leaf_entries(value: Column, kind: T.DataType, path: Column) -> Column:
    """(column, value) of every leaf of a value: fields of structs and values of maps by their path, all else as JSON text."""
    own = F.to_json(F.array(value))
    leaf = F.array(F.struct(path.alias("column"), F.substring(own, F.lit(2), F.length(own) - 2).alias("value")))
    if isinstance(kind, T.StructType):
        inner = F.concat(*(_leaf_entries(value[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}"))) for f in kind.fields))
    elif isinstance(kind, T.MapType):
        inner = F.flatten(F.transform(F.map_entries(value), lambda e: _leaf_entries(e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"].cast("string")))))
    else:
        return leaf
    return F.when(value.isNull(), leaf).otherwise(inner)


def row_diff(full: DataFrame, derived: DataFrame, key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """(key, column, left_value, right_value) of every leaf that differs; values as JSON text, `<missing>` where a side lacks the leaf.

    Structs and maps are walked to their leaves, whose path is joined by dots; arrays are compared whole. A column, a map's key or
    a row that only one side has is missing on the other; a null is a value of its own. A null struct or map is one leaf.
    """
    out = {}
    for name, df in (("left_value", full), ("right_value", derived)):
        entries = [_leaf_entries(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)) for f in df.schema.fields if f.name != key and f.name not in ignore]
        out[name] = df.select(key, F.explode(F.concat(*entries)).alias("e")).select(key, "e.column", F.col("e.value").alias(name))
    joined = out["left_value"].join(out["right_value"], [key, "column"], "full_outer")
    return joined.where(~F.col("left_value").eqNullSafe(F.col("right_value"))).fillna(MISSING, list(out))


def apply_decisions(rows: DataFrame, decisions: DataFrame, key: str, allowed: tuple[str, ...] = ("keep", "drop", "hold"), default: str = "hold") -> tuple[DataFrame, DataFrame]:
    """Rows with their decision (a default where there is none), and the decisions that are repeated, unknown or for no row."""
    counts = decisions.groupBy(key).agg(F.count("*").alias("n"), F.min("decision").alias("decision"), F.max("decision").alias("_hi"))
    orphans = counts.join(rows.select(key), key, "left_anti").select(key, F.lit("no_row").alias("problem"))
    bad = counts.select(key, F.when(F.col("n") > 1, "repeated").when(~F.coalesce(F.col("decision").isin(*allowed), F.lit(False)), "unknown").alias("problem")).where("problem is not null")
    good = counts.where((F.col("n") == 1) & F.col("decision").isin(*allowed)).select(key, "decision")
    return rows.join(good, key, "left").withColumn("decision", F.coalesce("decision", F.lit(default))), bad.union(orphans)


def review_partition(manifest: DataFrame, candidates: DataFrame, reviewed: DataFrame, conflicts: DataFrame, key: str = "crop_id", path: str = "path", digest: str = "digest") -> DataFrame:
    """(path, state, problem) of every file of the three tables, after a review that deletes what isn't a negative.

    manifest: path, digest, key; candidates and reviewed: path, digest of the files that are there; conflicts: keys of rows that
    overlap known positives. A file of the manifest is removed if it isn't among the reviewed ones, modified if its reviewed copy has another
    digest, quarantined if its key is a conflict, else admitted; a file that the manifest lacks is unknown. The candidates must stay as
    the manifest has them: problem tells one that is missing, changed or new, and a reviewed file that is changed or unknown.
    """
    m, c, r = manifest.select(path, key, F.col(digest).alias("_m"), F.lit(True).alias("_in_m")), *(df.select(path, F.col(digest).alias(n), F.lit(True).alias(f"_in{n}")) for df, n in ((candidates, "_c"), (reviewed, "_r")))
    rows = m.join(c, path, "full_outer").join(r, path, "full_outer").join(conflicts.select(key, F.lit(True).alias("_conflict")).distinct(), key, "left")
    in_m, in_c, in_r = (F.col(f"_in{n}").isNotNull() for n in ("_m", "_c", "_r"))
    changed = lambda n: ~F.col(n).eqNullSafe(F.col("_m"))
    state = F.when(~in_m, "unknown").when(~in_r, "removed").when(changed("_r"), "modified").when(F.col("_conflict").isNotNull(), "quarantined").otherwise("admitted")
    problem = F.when(~in_m, F.when(in_r, "unknown_reviewed").otherwise("unknown_candidate")).when(~in_c, "candidate_missing").when(changed("_c"), "candidate_modified").when(in_r & changed("_r"), "reviewed_modified")
    return rows.select(path, state.alias("state"), problem.alias("problem"))


def conservation_check(states: DataFrame) -> DataFrame:
    """Files of the manifest against admitted + quarantined + removed ones, how many have a problem, and whether all is well."""
    n = {s: F.count_if(F.col("state") == s) for s in ("admitted", "quarantined", "removed", "modified", "unknown")}
    expected, problems = F.count_if(F.col("state") != "unknown"), F.count("problem")
    return states.agg(expected.alias("expected"), *(c.alias(s) for s, c in n.items()), problems.alias("problems"), ((expected == n["admitted"] + n["quarantined"] + n["removed"]) & (problems == 0)).alias("conserved"))


def rebase_paths(labels: DataFrame, inventory: DataFrame, path: str = "path") -> DataFrame:
    """Labels with found_path (the recorded path, else the only file of its name) and how: recorded, renamed, ambiguous or missing."""
    name = F.regexp_extract(path, r"([^/\\]*)$", 1)
    files = inventory.select(F.col(path).alias("_file")).distinct()
    by_name = files.groupBy(F.regexp_extract("_file", r"([^/\\]*)$", 1).alias("_name")).agg(F.count("*").alias("_n"), F.min("_file").alias("_only"))
    rows = labels.join(files, F.col(path) == F.col("_file"), "left").join(by_name, name == F.col("_name"), "left")
    how = F.when(F.col("_file").isNotNull(), "recorded").when(F.col("_n") == 1, "renamed").when(F.col("_n") > 1, "ambiguous").otherwise("missing")
    found = F.coalesce("_file", F.when(F.col("_n") == 1, F.col("_only")))
    return rows.withColumn("found_path", found).withColumn("how", how).drop("_file", "_name", "_n", "_only")


def verify_digests(manifest: DataFrame, files: DataFrame, counts: DataFrame | None = None, path: str = "path") -> DataFrame:
    """Declared files that are missing or differ in digest or number of rows: path, problem."""
    rows = manifest.join(files.select(path, F.col("digest").alias("_digest")), path, "left")
    if counts is not None:
        rows = rows.join(counts.select(path, F.col("n_rows").alias("_rows")), path, "left")
    problem = F.when(F.col("_digest").isNull(), "missing").when(F.col("_digest") != F.col("digest"), "digest")
    if counts is not None:
        problem = problem.when(~F.col("_rows").eqNullSafe(F.col("n_rows")), "rows")
    return rows.select(path, problem.alias("problem")).where("problem is not null")


def route_rows(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with action: included, ignored (a row that says so) or source_disabled; sources: dataset_id, active."""
    joined = rows.join(sources.select("dataset_id", F.col("active").alias("_active")), "dataset_id", "left")
    action = F.when(~F.coalesce("_active", F.lit(False)), "source_disabled").when(F.coalesce("ignore", F.lit(False)), "ignored").otherwise("included")
    return joined.withColumn("action", action).drop("_active")


def role_status(sources: DataFrame, roles: DataFrame) -> DataFrame:
    """Per role: sources discovered, enabled and disabled, and present, absent or required_missing."""
    counts = sources.groupBy("role").agg(F.count("*").alias("discovered"), F.count_if("active").alias("enabled"))
    rows = roles.join(counts, "role", "left").fillna(0, ["discovered", "enabled"]).withColumn("disabled", F.col("discovered") - F.col("enabled"))
    return rows.withColumn("status", F.when(F.col("enabled") > 0, "present").when(F.coalesce("required", F.lit(False)), "required_missing").otherwise("absent"))


def identity_occupancy(files: DataFrame, path: str, tokens: str = "tokens") -> DataFrame:
    """Rows and distinct tokens of each file."""
    rows = files.groupBy(path).agg(F.count("*").alias("n_rows"))
    held = files.select(path, F.explode(tokens).alias("t")).distinct().groupBy(path).agg(F.count("*").alias("n_tokens"))
    return rows.join(held, path, "left").fillna(0, ["n_tokens"])


def audit_counters(rows: DataFrame, dims: list[str]) -> DataFrame:
    """(dimension, value, n): rows by each value of each dimension, from one unpivot; missing values are "unknown"."""
    entries = F.array(*(F.struct(F.lit(d).alias("dimension"), F.coalesce(F.nullif(F.col(d).cast("string"), F.lit("")), F.lit("unknown")).alias("value")) for d in dims))
    return rows.select(F.explode(entries).alias("e")).groupBy("e.dimension", "e.value").agg(F.count("*").alias("n"))


def reason_counts(rows: DataFrame, reasons: str = "reasons") -> DataFrame:
    return rows.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def fingerprint(files: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """SHA-256 of the lines "path:digest" in order of path, per group; a group's lines must fit into a task."""
    lines = F.array_sort(F.collect_list(F.concat("path", F.lit(":"), "digest", F.lit("\n"))))
    return files.groupBy(*by).agg(F.count("*").alias("n_files"), F.sha2(F.array_join(lines, ""), 256).alias("fingerprint"))


#: Paths of a leaf of a tree fingerprint, about.
LEAF_FILES = 1 << 14


def tree_fingerprint(files: DataFrame, by: tuple[str, ...] = (), leaf_files: int = LEAF_FILES) -> DataFrame:
    """As fingerprint(), in two levels, for groups of any size: digests of hash ranges of paths, then of these (another value).

    A group has as many leaves as its counted files ask for, so neither a leaf nor the list of a group's leaves grows large.
    """
    sizes = files.groupBy(*by).agg(F.ceil(F.count("*") / leaf_files).cast("long").alias("_leaves"))
    names = {c: f"_k{i}" for i, c in enumerate(by)}
    same = F.lit(True)
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    held = files.join(sizes.withColumnsRenamed(names), same)
    lines = F.array_sort(F.collect_list(F.concat("path", F.lit(":"), "digest", F.lit("\n"))))
    leaf = F.conv(F.substring(F.sha2("path", 256), 1, 8), 16, 10).cast("long") % F.col("_leaves")
    leaves = held.groupBy(*by, leaf.alias("_p")).agg(F.count("*").alias("n"), F.sha2(F.array_join(lines, ""), 256).alias("d"))
    nodes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", "d"))), lambda x: x["d"]), "\n")
    return leaves.groupBy(*by).agg(F.sum("n").alias("n_files"), F.sha2(nodes, 256).alias("fingerprint"))


def multitask_problems(rows: DataFrame, fields: tuple[str, ...] = (), method: str | None = None) -> DataFrame:
    """rows with problem: why a row may not enter a multitask snapshot, null if it may.

    rows: present, action, negative_evidence, decision, review_method and the review's `fields`. A positive must be included with its
    landmarks; a negative must be a human-confirmed one whose review has all fields (not blank) and the method asked for.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    confirmed = (text("action") == "INCLUDE_CONFIRMED_NEGATIVE") & (text("negative_evidence") == "human_confirmed") & (text("decision") == "CONFIRMED_NEGATIVE")
    problem = F.when(F.coalesce("present", F.lit(False)), F.when(text("action") != "INCLUDE_LANDMARKS", "positive_not_included")).when(~confirmed, "unconfirmed_negative")
    for c in fields:
        problem = problem.when(F.trim(text(c)) == "", f"no_{c}")
    if method:
        problem = problem.when(text("review_method") != method, "other_review_method")
    return rows.withColumn("problem", problem)


def negative_gate(rows: DataFrame, minimum: int, minimums: dict[str, int], transaction: bool, fields: tuple[str, ...] = (), method: str | None = None) -> DataFrame:
    """The gate of a multitask snapshot, a row per check: check, n, minimum, passed.

    No row may have a problem (multitask_problems), a review transaction must stand behind the rows, there must be positives,
    `minimum` confirmed negatives, and as many of each sample type as `minimums` says. The gate passes if all checks do.
    """
    present, problem = F.coalesce("present", F.lit(False)), F.col("problem")
    confirmed = ~present & problem.isNull()
    wanted = [("has_positive_geometry", F.count_if(present), 1), ("minimum_confirmed_negatives", F.count_if(confirmed), minimum)]
    wanted += [(f"minimum_confirmed:{k}", F.count_if(confirmed & (F.col("sample_type") == k)), v) for k, v in sorted(minimums.items())]
    checks = [F.struct(F.lit(name).alias("check"), n.alias("n"), F.lit(least).cast("long").alias("minimum"), (n >= least).alias("passed")) for name, n, least in wanted]
    wrong, no_limit = F.count("problem"), F.lit(None).cast("long")
    checks.append(F.struct(F.lit("no_unreviewed_negative").alias("check"), wrong.alias("n"), no_limit.alias("minimum"), (wrong == 0).alias("passed")))
    checks.append(F.struct(F.lit("authenticated_negative_review_transaction").alias("check"), F.lit(int(transaction)).cast("long").alias("n"), F.lit(1).cast("long").alias("minimum"), F.lit(bool(transaction)).alias("passed")))
    return multitask_problems(rows, fields, method).agg(F.array(*checks).alias("c")).select(F.explode("c").alias("c")).select("c.*")
