"""Digests, deterministic uniforms, identity tokens and key=value text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "\x1f"


def salted_digest(salt: str, *parts: Column, separator: str = UNIT) -> Column:
    """SHA-256 (hex) of the salt and the parts, joined by a separator."""
    return F.sha2(F.concat_ws(separator, F.lit(salt), *(p.cast("string") for p in parts)), 256)


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only: 48 bits of their digest."""
    digest = F.sha2(F.concat_ws(UNIT, *(p.cast("string") for p in parts)), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def first_filled(*columns: Column) -> Column:
    """The first value that is not null or empty, else an empty string."""
    return F.coalesce(*(F.nullif(c.cast("string"), F.lit("")) for c in columns), F.lit(""))


def tokens(fields: dict[str, list[Column]], lower: bool = True, scopes: dict[str, Column] | None = None) -> Column:
    """Distinct "namespace:value" strings of the filled columns of each namespace; "namespace:scope:value" where a namespace has a scope."""
    plain = lambda c: F.lower(F.trim(c.cast("string"))) if lower else F.trim(c.cast("string"))
    found = []
    for namespace, columns in fields.items():
        scope = (scopes or {}).get(namespace)
        head = F.lit(namespace + ":") if scope is None else F.concat(F.lit(namespace + ":"), F.coalesce(plain(scope), F.lit("")), F.lit(":"))
        found += [F.when(plain(c) != "", F.concat(head, plain(c))) for c in columns]
    return F.array_distinct(F.array_compact(F.array(*found)))


#: Identity columns by namespace. The tokens of other tools' files must be the same.
IDENTITY_FIELDS = {
    "parent": ("parent_global_crop_id", "global_crop_id", "crop_id", "source_crop_id"),
    "source_image": ("source_image_identity", "source_image", "image"),
    "roi_sha256": ("image_sha256", "crop_image_sha256", "source_image_sha256"),
    "pixel_sha256": ("normalized_pixel_sha256",),
    "native": ("native_source_crop_id",),
}


def identity_tokens(columns: list[str]) -> Column:
    """tokens() of the identity columns among `columns`; source images are scoped by dataset, native crops by their root."""
    have = lambda names: [F.col(c) for c in names if c in columns]
    scope = lambda *names: first_filled(*have(names)) if have(names) else F.lit("")
    fields = {k: have(v) for k, v in IDENTITY_FIELDS.items() if have(v)}
    return tokens(fields, scopes={"source_image": scope("parent_dataset_id", "dataset_id"), "native": scope("native_source_root")})


def lineage_tokens(columns: list[str], groups: bool = False) -> Column:
    """Tokens of a row's origin, in its own case: crop lineage, source crop within its dataset, image digests; with groups, also the source
    group and sessions, which must not be split between training and evaluation."""
    have = lambda *names: [F.col(c) for c in names if c in columns]
    crop, dataset = (first_filled(*have(*n)) if have(*n) else F.lit("") for n in (("parent_source_crop_id", "source_crop_id"), ("parent_dataset_id", "dataset_id")))
    fields = {
        "global_crop_lineage": have("parent_global_crop_id", "global_crop_id"),
        "dataset_source_crop": [F.when((crop != "") & (dataset != ""), F.concat(dataset, F.lit(UNIT), crop))],
        "roi_image_sha256": have("roi_image_sha256", "image_sha256", "crop_image_sha256"),
        "normalized_pixel_sha256": have("normalized_pixel_sha256"),
    }
    if groups:
        fields |= {c: have(c) for c in ("source_group_id", "source_session_id", "session_id")}
    return tokens({k: v for k, v in fields.items() if v}, lower=False)


def unsafe_path(path: Column) -> Column:
    """Whether a relative path is empty, absolute, or leads out of its folder."""
    return F.coalesce(path, F.lit("")).rlike(r"^$|^[/\\]|^[A-Za-z]:|(^|[/\\])\.\.([/\\]|$)|\x00")


def is_timestamp(text: Column) -> Column:
    """Whether a text is an ISO-8601 date and time."""
    return text.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d") & F.try_to_timestamp(text).isNotNull()


def dotted(json: Column, path: str) -> Column:
    """A value in JSON text by a dotted path, objects and lists as canonical JSON; "<missing>" where there is none."""
    found = F.try_variant_get(F.try_parse_json(json), "$." + path, "variant")
    nested = F.schema_of_variant(found).rlike("^(OBJECT|ARRAY)")
    return F.coalesce(F.when(nested, F.to_json(found)), F.get_json_object(json, "$." + path), F.lit("<missing>"))


def key_values(line: Column) -> Column:
    """Map of the key=value pairs of a line as text; values may be quoted, and of a repeated key the last one holds."""
    pattern = r"""([A-Za-z0-9_]+)=("[^"]*"|\S+)"""
    names, values = F.regexp_extract_all(line, F.lit(pattern), F.lit(1)), F.regexp_extract_all(line, F.lit(pattern), F.lit(2))
    pairs = F.zip_with(names, values, lambda k, v: F.struct(k.alias("key"), F.regexp_replace(v, '^"|"$', "").alias("value")))
    later = lambda p, i: F.exists(F.slice(names, i + 2, F.size(names)), lambda n: n == p["key"])
    return F.map_from_entries(F.filter(pairs, lambda p, i: ~later(p, i)))


def typed(value: Column) -> Column:
    """struct(text, number) of a value of key_values(): number is null for text that isn't one."""
    return F.struct(value.alias("text"), F.when(value.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), value.cast("double")).alias("number"))


def canonical_json(json: Column) -> Column:
    """JSON text with the members of all objects sorted by name and no spaces, so that equal values have equal text; null for text that isn't JSON."""
    return F.to_json(F.try_parse_json(json))  # a variant keeps its members sorted


def cells_digest(cells: Column) -> Column:
    """Digest of a list of cells as JSON."""
    return F.sha2(F.to_json(cells), 256)


def capture_parts(capture_id: Column) -> Column:
    """struct of the seven parts of background-distance-lighting-condition-split-session-performer, and valid."""
    names = ("background", "distance", "lighting", "condition", "split", "session", "performer")
    parts = F.split(capture_id, "-")
    valid = (F.size(parts) == len(names)) & F.forall(parts, lambda p: p.rlike("^[a-z0-9_]+$")) & F.get(parts, 4).isin("train", "val", "test") & F.get(parts, 5).rlike("^s[0-9]+$")
    return F.struct(*(F.get(parts, k).alias(n) for k, n in enumerate(names)), F.coalesce(valid, F.lit(False)).alias("valid"))
