"""Label, manifest, registry, inventory, image-header, detection and log sources; snapshot and ledger sinks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.telemetry import TIMINGS

POINTS = "array<struct<id:int,x:double,y:double>>"
LABEL_SCHEMA = f"""
roi_id string, global_crop_id string, crop_id string, dataset_id string, capture_source_id string, split string, raw_image_id string, source_group_id string,
proposal_variant string, crop_path string, palm_score double, palm_valid boolean, hand_presence struct<present:boolean>, handedness struct<label:string,score:double>,
landmarks_crop_norm {POINTS}, roi_rect struct<x_center:double,y_center:double,width:double,height:double,rotation_rad:double>, quality_flags array<string>
"""
MANIFEST_SCHEMA = "schema_version string, dataset_id string, scope string, capture_sources array<struct<capture_source_id:string,split:string,published_variants:array<struct<proposal_variant:string,published_labels:int,labels_relpath:string>>>>"
REGISTRY_SCHEMAS = {
    "rois": "roi_id string, raw_image_id string, capture_source_id string, proposal_variant string, proposal_slot int, crop_relpath string",
    "negative_datasets": "id string, status string",
    "published_negatives": "roi_id string, negative_dataset_id string, published_relpath string",
    "selections": "id string, status string",
    "hard_datasets": "id string, status string",
}
FRAME_SCHEMA = "run_id long, frame_index long, " + ", ".join(f"{t} double" for t in TIMINGS)
DETECTION_SCHEMA = "image string, rendered string, error string, detections array<struct<score:double,hand_flag_score:double,handedness_score:double,handedness:string,box:array<double>,landmarks_roi_norm:array<array<double>>>>"


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_labels(spark: SparkSession, paths: str | list[str], schema: str | T.StructType = LABEL_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """JSON lines with a fixed schema, and the lines that aren't objects of it: file, line text."""
    full = T.StructType([*_schema(schema).fields, T.StructField("_bad", T.StringType())])
    text = spark.read.text(paths).where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    rows = text.withColumn("_row", F.from_json("line", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("_row").isNull() | F.col("_row._bad").isNotNull() | ~F.ltrim("line").startswith("{")
    return rows.where(~bad).select("_row.*", "file").drop("_bad"), rows.where(bad).select("file", "line")


def read_text_with_line_no(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, line_no, line), from 1 in each file; files are read whole lines at a time and numbered without a global sort."""
    rows = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line"))
    firsts = rows.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(_running("file", "_block")), F.lit(0))
    firsts = firsts.select("file", "_block", "_first", before.alias("_before"))
    return rows.join(firsts, ["file", "_block"]).select("file", (F.col("_id") - F.col("_first") + F.col("_before") + 1).alias("line_no"), "line")


def _running(partition: str, order: str):
    return Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def read_manifests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A row per dataset, capture source and published variant of JSON manifests, a file each."""
    return _manifest_rows(spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(paths))


def read_manifests_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """As read_manifests(), of files with a manifest per line."""
    return _manifest_rows(spark.read.schema(MANIFEST_SCHEMA).json(paths))


def _manifest_rows(raw: DataFrame) -> DataFrame:
    rows = raw.select("dataset_id", "scope", F.explode_outer("capture_sources").alias("c")).select("dataset_id", "scope", "c.capture_source_id", "c.split", F.explode_outer("c.published_variants").alias("v"))
    return rows.select("dataset_id", "scope", "capture_source_id", "split", "v.proposal_variant", "v.published_labels", "v.labels_relpath")


def select_sources(catalog: DataFrame, scope: str | None = None, split: str | None = None, variant: str | None = None, captures: list[str] | None = None) -> DataFrame:
    """The catalog rows whose label files are wanted; filtered before any label file is opened."""
    for column, value in (("scope", scope), ("split", split), ("proposal_variant", variant)):
        if value is not None:
            catalog = catalog.where(F.col(column) == value)
    return catalog.where(F.col("capture_source_id").isin(captures)) if captures is not None else catalog


def read_source_rows(spark: SparkSession, catalog: DataFrame, root: str, schema: str = LABEL_SCHEMA, **wanted) -> DataFrame:
    """The label rows of the selected sources, from JSON files in folders by dataset_id, proposal_variant and split.

    Wanted splits and variants are filters on the folders' names; what else the catalog selects prunes folders when the query runs, by
    the join. No list of files or sources passes through the driver, and files of other sources aren't opened.
    """
    chosen = select_sources(catalog, **wanted).select("dataset_id", "capture_source_id", "proposal_variant", "split").distinct()
    rows = spark.read.schema(_schema(schema)).option("basePath", root).json(root)
    for name, column in (("split", "split"), ("variant", "proposal_variant")):
        if wanted.get(name) is not None:
            rows = rows.where(F.col(column) == wanted[name])
    return rows.join(chosen, chosen.columns, "left_semi")


def read_listed_rows(spark: SparkSession, catalog: DataFrame, root: str, schema: str = LABEL_SCHEMA, **wanted) -> DataFrame:
    """As read_source_rows(), from the files that the catalog names, wherever they are; the driver holds their names."""
    chosen = select_sources(catalog, **wanted)
    files = [f"{root.rstrip('/')}/{r['labels_relpath']}" for r in chosen.select("labels_relpath").distinct().collect() if r["labels_relpath"]]
    if not files:
        return spark.createDataFrame([], _schema(schema))
    rows, _ = read_labels(spark, files, schema)
    return rows.join(chosen.select("dataset_id", "capture_source_id", "proposal_variant").distinct(), ["dataset_id", "capture_source_id", "proposal_variant"], "left_semi").drop("file")


def read_releases(spark: SparkSession, manifests: DataFrame, rows: DataFrame, forced: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Release rows with forced fields, and releases whose row count differs from their manifest's: release_id, records, found."""
    counts = rows.groupBy("release_id").agg(F.count("*").alias("found"))
    wrong = manifests.join(counts, "release_id", "left").fillna(0, ["found"]).where("records <> found").select("release_id", "records", "found")
    out = rows.join(manifests.select("release_id"), "release_id", "left_semi")
    return out.withColumns({k: F.lit(v) for k, v in forced.items()}), wrong


def read_registry(spark: SparkSession, location: str, name: str, **jdbc: str) -> DataFrame:
    """One of the five registry tables, from Parquet in a folder or, with options, by JDBC."""
    if name not in REGISTRY_SCHEMAS:
        raise ValueError(f"unknown registry table {name}; there are {sorted(REGISTRY_SCHEMAS)}")
    if jdbc:
        return spark.read.format("jdbc").options(url=location, dbtable=name, **jdbc).load()
    return spark.read.schema(REGISTRY_SCHEMAS[name]).parquet(f"{location.rstrip('/')}/{name}.parquet")


def file_inventory(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, length, n_same_path): the files below a folder; n_same_path counts paths that are equal but for case. Contents aren't read; Spark lists no empty files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root).select("path", "length")
    same = files.groupBy(F.lower("path").alias("_p")).agg(F.count("*").alias("n_same_path"))
    return files.join(same, F.lower("path") == F.col("_p")).drop("_p")


def _opened(path: str):
    store, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return store.open_input_file(name)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each file, read piece by piece."""
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            with _opened(path) as f:
                while piece := f.read(1 << 20):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], ["path", "digest"])


def content_digest(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, digest): SHA-256 of each file's bytes, of files of any size; the tasks that get the names read the files."""
    return file_inventory(spark, root, glob).select("path").repartition("path").mapInArrow(_digests, "path string, digest string")


#: Bytes of a PNG file up to its colour type.
PNG_HEAD = 26


def _heads(n: int):
    """The first n bytes of each file; only these are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = []
            for path in batch.column("path").to_pylist():
                with _opened(path) as f:
                    heads.append(f.read(n))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(heads, pa.binary())], ["path", "head"])

    return run


def image_size_audit(spark: SparkSession, root: str) -> DataFrame:
    """(path, width, height, channels, problem): from the header of PNG files; other files are flagged.

    Only files named .png are opened, and only their first 26 bytes are read, in the tasks that get their names.
    """
    names = file_inventory(spark, root).select("path")
    png = F.lower("path").endswith(".png")
    records = names.where(png).repartition("path").mapInArrow(_heads(PNG_HEAD), "path string, head binary")
    number = lambda at, n: F.conv(F.substring("head", 2 * at + 1, 2 * n), 16, 10).cast("int")
    valid = F.coalesce((F.substring("head", 1, 32) == "89504E470D0A1A0A0000000D49484452") & (F.length("head") == 2 * PNG_HEAD), F.lit(False))
    channels = F.create_map(*(F.lit(x) for kv in {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.items() for x in kv))[number(25, 1)]
    heads = records.select("path", F.hex("head").alias("head")).unionByName(names.where(~png).withColumn("head", F.lit(None).cast("string")))
    return heads.select("path", F.when(valid, number(16, 4)).alias("width"), F.when(valid, number(20, 4)).alias("height"), F.when(valid, channels).alias("channels"), F.when(~valid, "not_png").alias("problem"))


def read_detection_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(image, rendered, error, detections): a row per image, for joins.paired_detections and detections.inference_summary."""
    return spark.read.schema(DETECTION_SCHEMA).json(paths)


def read_detections(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(image, rendered, error, position and a detection's fields): a row per detection, one with nulls for an image without any."""
    raw = read_detection_rows(spark, paths)
    return raw.select("image", "rendered", "error", F.posexplode_outer("detections").alias("position", "d")).select("image", "rendered", "error", "position", "d.*")


def collected_lines(lines: DataFrame) -> DataFrame:
    """(file, line_no, line) of files that hold many runs, in any mixture -> (file, run, line_no, line): each line begins with its run's
    name and a tab; the run of a line without a tab is empty. A name means a run within its file only."""
    tab = F.instr("line", "\t")
    return lines.select("file", F.when(tab > 0, F.substring_index("line", "\t", 1)).otherwise("").alias("run"), "line_no", F.when(tab > 0, F.substring("line", tab + 1, F.length("line"))).otherwise(F.col("line")).alias("line"))


def read_perf_log(spark: SparkSession, paths: str | list[str], collected: bool = False) -> DataFrame:
    """(run_id, line_no, line): devices' log files, for operators.telemetry.parse_lines.

    A file is a run, with its path as run_id; or, `collected`, a file holds many runs as collected_lines() takes them, run_id is
    <file>#<run>, and line_no counts the lines of the file.
    """
    lines = read_text_with_line_no(spark, paths)
    if not collected:
        return lines.withColumnRenamed("file", "run_id")
    return collected_lines(lines).select(F.concat_ws("#", "file", "run").alias("run_id"), "line_no", "line")


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Writes the rows by split, and a report of their counts beside them; an existing snapshot is an error. Returns the report."""
    df.write.partitionBy("split").mode("errorifexists").parquet(f"{path}/rows")
    report = df.sparkSession.read.parquet(f"{path}/rows").groupBy("split").agg(F.count("*").alias("n"))
    report.write.mode("errorifexists").json(f"{path}/report")
    return report


def append_round(df: DataFrame, ledger: str) -> None:
    """Adds a mining round's rows (with round_id) to the ledger."""
    df.write.mode("append").partitionBy("round_id").parquet(ledger)


def frame_stream(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    """Frame timings as they arrive in a folder."""
    return spark.readStream.schema(FRAME_SCHEMA).format(form).load(path)


def line_stream(spark: SparkSession, path: str, collected: bool = False) -> DataFrame:
    """(file, line_no, line) of log files as they arrive in a folder, (file, run, line_no, line) of `collected` ones; each file is read as
    one text and must fit into a row."""
    files = spark.readStream.text(path, wholetext=True)
    lines = files.select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    lines = lines.select("file", (F.col("line_no") + 1).cast("long").alias("line_no"), "line").where("line <> ''")
    return collected_lines(lines) if collected else lines
