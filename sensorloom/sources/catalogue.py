"""Recording catalogue: entities, selection, settings and uniqueness rules, all on path columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import normalized

# Vendor aliases (matching form -> reference device, -> plot vendor).
REFERENCE_DEVICES = {
    "4d": "4D", "bti": "4D", "magnes": "4D", "ctf": "CTF", "elekta": "Elekta", "neuromag": "Elekta", "megin": "Elekta",
    "kit": "KIT", "yokogawa": "KIT", "quanmag": "QuanMag", "fieldline": "QuanMag", "qzfm": "QuanMag", "opm-quanmag": "QuanMag",
    "quspin": "QuSpin", "opm-quspin": "QuSpin", "opm": "ALL", "all": "ALL", "": "ALL", "auto": "auto",
}
PLOT_VENDORS = {
    "": "", "unknown": "", "all": "", "auto": "auto", "elekta": "elekta", "neuromag": "elekta", "megin": "elekta", "ctf": "ctf",
    "kit": "kit", "yokogawa": "kit", "4d": "4D", "bti": "4D", "magnes": "4D", "opm": "opm", "quanmag": "opm", "quspin": "opm",
    "opm-quanmag": "opm", "opm-quspin": "opm", "fieldline": "opm", "qzfm": "opm",
}
# Channel-name patterns of the device families, in matching order.
DEVICE_PATTERNS = [
    ("opm", r"(?:OPM|QZFM|QZFG|FIELDLINE)|^FL\d{2,}[A-Z0-9-]*$"), ("elekta", r"^MEG\d{4}$"),
    ("ctf", r"^M[LRZ][A-Z]{1,2}\d{2,3}(?:-\d{3,5})?$"), ("kit", r"^(?:MEG|AG)\d{3}$"), ("4d", r"^A\d{1,3}$"),
]
# Anatomical image name patterns; the first is the standard one, the rest the ordered fallback.
T1_STANDARD = r"_T1w\.nii\.gz$"
T1_FALLBACK = [r"T1w\.nii\.gz$", r"T1w\.nii$", r"T1_defaced\.nii\.gz$", r"T1_defaced\.nii$", r"T1.*\.nii\.gz$", r"T1.*\.nii$"]


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def output_id(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), r"\.[^.]+$", "")


def _in_name_or_path(path: Column, entity: str) -> Column:
    in_name = F.regexp_extract(file_name(path), rf"(?:^|_){entity}-([A-Za-z0-9]+)", 1)
    last = F.try_element_at(F.regexp_extract_all(path, F.lit(rf"(?:^|[\\/]){entity}-([A-Za-z0-9]+)"), F.lit(1)), F.lit(-1))
    return F.when(in_name != "", in_name).otherwise(F.coalesce(last, F.lit("")))


def recording_entities(path: Column) -> dict[str, Column]:
    """Subject and session from the file name, else the last match in the path; task, run, suffix from the name."""
    name = file_name(path)
    return {
        "subject": _in_name_or_path(path, "sub"), "session": _in_name_or_path(path, "ses"),
        "task": F.regexp_extract(name, r"task-([^_/.]+)", 1), "run": F.regexp_extract(name, r"run-([^_/.]+)", 1),
        "suffix": F.regexp_extract(name, r"_([A-Za-z0-9]+)(?:\.[^.]+|$)", 1), "filename": name, "output_id": output_id(path),
    }


def parse_recording_entities(paths: DataFrame, column: str = "path") -> DataFrame:
    return paths.select("*", *[c.alias(n) for n, c in recording_entities(F.col(column)).items()])


def filter_entities(recs: DataFrame, entity: str, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """Membership filter; `first:N` stands for the first N distinct values (per dataset) in sort order."""
    keys = keys or ["dataset"]
    plain = [v for v in values if not v.lower().startswith("first:")]
    counts = [int(v.split(":", 1)[1]) for v in values if v.lower().startswith("first:")]
    if not values:
        return recs
    if not counts:
        return recs.where(F.col(entity).isin(plain))
    w = Window.partitionBy(*keys).orderBy(entity)  # one row per distinct value
    ranked = recs.select(*keys, entity).distinct().withColumn("_r", F.row_number().over(w))
    keep = ranked.where((F.col("_r") <= max(counts)) | F.col(entity).isin(plain)).select(*keys, entity)
    return recs.join(keep, [*keys, entity], "left_semi")


def filter_paths(paths: DataFrame, suffix: str, include: list[str] | None = None, exclude: list[str] | None = None,
                 exclude_dirs: list[str] | None = None, column: str = "path") -> DataFrame:
    """Suffix, any-include and any-exclude on the lower-cased file name; excluded directory prefixes."""
    name = F.lower(file_name(F.col(column)))
    keep = F.endswith(name, F.lit(suffix.lower())) if suffix else F.lit(False)

    def any_of(words: list[str]) -> Column:
        return F.exists(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.contains(name, w))

    if include:
        keep = keep & any_of(include)
    if exclude:
        keep = keep & ~any_of(exclude)
    for folder in exclude_dirs or []:
        keep = keep & ~F.startswith(F.col(column), F.lit(folder.rstrip("/") + "/")) & (F.col(column) != folder)
    return paths.where(keep)


def collapse_split_recordings(recs: DataFrame, keys: list[str], split: str = "split") -> DataFrame:
    """Keep the first part of split recordings; exactly one first part is required."""
    parts = recs.where(F.col(split).isNotNull())
    audit = parts.groupBy(*keys).agg(F.count_if(F.col(split) == 1).alias("_first")).where(
        F.assert_true(F.col("_first") == 1, F.lit("expected exactly one first split")).isNull()).drop("_first")
    return recs.where(F.col(split).isNull()).unionByName(parts.where(F.col(split) == 1).join(audit, keys, "left_semi"))


def auto_dataset_format(paths: DataFrame, root: str = "root", path: str = "path") -> DataFrame:
    """`bids` when the dataset root holds a description file, else `raw`."""
    described = F.bool_or(F.col(path) == F.concat(F.col(root), F.lit("/dataset_description.json")))
    return paths.groupBy("dataset").agg(F.when(described, "bids").otherwise("raw").alias("format"))


def lookup_key(name: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(name), r"[^A-Za-z0-9._-]+", "_"))


def select_datasets(datasets: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None,
                    column: str = "dataset") -> DataFrame:
    """Include, then exclude, by name, matching form, or `*`."""

    def listed(patterns: list[str]) -> Column:
        hit = F.lit("*" in patterns)
        for p in patterns:
            hit = hit | (F.col(column) == p) | (lookup_key(F.col(column)) == lookup_key(F.lit(p)))
        return hit

    out = datasets.where(listed(include)) if include else datasets
    return out.where(~listed(exclude)) if exclude else out


def restrict_bads_to_recording(bads: DataFrame, channels: DataFrame) -> DataFrame:
    """Listed bad channels that the recording does not have are ignored."""
    return bads.join(channels.select("recording_id", "ch_name"), ["recording_id", "ch_name"], "left_semi")


def replace_annotations(existing: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored annotations replace the existing ones of their recording."""
    columns = existing.columns
    return existing.join(stored.select("recording_id").distinct(), "recording_id", "left_anti").select(*columns).unionByName(
        stored.select(*columns))


def study_get(paths: DataFrame, template: str, column: str = "path", **fields: str) -> DataFrame:
    """Paths that fit a `{field}` template; fields not given match anything within a path part."""
    regex = ""
    for literal, field in re.findall(r"([^{]*)(?:\{(\w+)\})?", template):
        regex += re.escape(literal)
        if field:
            regex += re.escape(fields[field]) if field in fields else "[^/]*"
    return paths.where(F.col(column).rlike("^" + regex + "$"))


# -------------------------------------------------------------------- settings

def _merge(base: Column, override: Column) -> Column:
    """Override by dotted key; a key replaces whatever is above or below it in the tree. NULL values count."""
    names = F.map_keys(override)
    kept = F.map_filter(base, lambda k, v: ~F.exists(names, lambda o: (o == k) | F.startswith(k, F.concat(o, F.lit("."))) |
                                                     F.startswith(o, F.concat(k, F.lit(".")))))
    return F.map_concat(kept, override)


def match_profiles(recs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Recording profiles whose match spec fits: fields are ANDed, values ORed, `*` and case ignored.

    `profiles(dataset, profile, match MAP<STRING,ARRAY<STRING>>, settings MAP<STRING,STRING>)`.
    """
    spec, text = F.col("match"), F.coalesce

    def one(field: str) -> Column:
        wanted = F.try_element_at(spec, F.lit(field))
        actual = F.lower(text(F.col(field), F.lit("")))
        return F.coalesce(F.size(wanted) <= 0, F.lit(True)) | F.exists(wanted, lambda v: (v == "*") | (F.lower(v) == actual))

    keep = F.coalesce(F.size(spec) > 0, F.lit(False))
    for field in ("subject", "session", "task", "run", "suffix"):
        keep = keep & (F.try_element_at(spec, F.lit(field)).isNull() | one(field))
    pieces = F.try_element_at(spec, F.lit("filename_contains"))
    name = F.lower(F.coalesce("filename", F.lit("")))
    keep = keep & (pieces.isNull() | F.exists(pieces, lambda p: F.contains(name, F.lower(p))))
    return recs.join(profiles, "dataset").where(F.coalesce(keep, F.lit(False))).select(*recs.columns, "profile", "settings")


def assert_single_profile(matches: DataFrame, keys: list[str]) -> DataFrame:
    """More than one matching profile is an error."""
    counted = matches.groupBy(*keys).agg(F.first("profile").alias("profile"), F.first("settings").alias("settings"),
                                         F.count("*").alias("_n"))
    return counted.where(F.assert_true(F.col("_n") == 1, F.concat(F.lit("several profiles match "), *[
        F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])).isNull()).drop("_n")


def effective_settings(recs: DataFrame, defaults: Column, datasets: DataFrame, profiles: DataFrame, keys: list[str]) -> DataFrame:
    """Defaults < dataset < recording profile. Settings are dotted-key maps, so nested maps merge by key."""
    empty = F.create_map().cast("map<string,string>")
    matched = assert_single_profile(match_profiles(recs, profiles), keys)
    j = recs.join(datasets.select("dataset", F.col("settings").alias("_ds")), "dataset", "left").join(
        matched.withColumnRenamed("settings", "_rec"), keys, "left")
    two = _merge(defaults, F.coalesce("_ds", empty))
    return j.withColumn("_two", two).withColumn("settings", _merge(F.col("_two"), F.coalesce("_rec", empty))).select(
        *recs.columns, F.coalesce("profile", F.lit("")).alias("profile"), "settings")


# --------------------------------------------------------------------- vendors

def resolve_sensor_vendor(name: Column, table: dict[str, str] | None = None, default: Column | None = None) -> Column:
    """Canonical name for an alias; unknown names pass through trimmed."""
    pairs = [F.lit(x) for kv in (table or REFERENCE_DEVICES).items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), normalized(F.coalesce(name, F.lit(""))))
    return F.coalesce(found, F.trim(name) if default is None else default)


def vendor_by_dataset(path: Column, vendors: dict[str, str]) -> Column:
    """Vendor of the longest dataset name found in the path, else the `default` / `*` entry."""
    def key(name: str) -> str:
        return name.strip().lower().replace("_", "-").replace(" ", "")

    named = [(k, v) for k, v in vendors.items() if key(k) not in ("default", "*", "")]
    fallback = next((v for k, v in vendors.items() if key(k) in ("default", "*")), None)
    out = F.lit(fallback)
    for name, vendor in reversed(sorted(named, key=lambda kv: -len(key(kv[0])))):
        out = F.when(F.contains(normalized(path), F.lit(key(name))), vendor).otherwise(out)
    return out


def infer_device_family(channels: DataFrame, min_hits: int = 3) -> DataFrame:
    """Device family with the most matching channel names; too few hits or a tie give none."""
    name = F.regexp_replace(F.upper("ch_name"), r"[\s_]+", "")
    family = F.lit(None).cast("string")
    for device, pattern in reversed(DEVICE_PATTERNS):
        family = F.when(name.rlike(pattern), device).otherwise(family)
    hits = channels.select("recording_id", family.alias("device")).where("device is not null").groupBy(
        "recording_id", "device").agg(F.count("*").alias("hits"))
    best = hits.groupBy("recording_id").agg(
        F.max("hits").alias("hits"), F.array_sort(F.collect_list(F.struct((-F.col("hits")).alias("h"), "device"))).alias("_all"))
    tie = F.coalesce(F.get(F.col("_all"), F.lit(1))["h"] == -F.col("hits"), F.lit(False))
    return best.select("recording_id", "hits", F.when((F.col("hits") >= min_hits) & ~tie, F.get("_all", F.lit(0))["device"]).alias("device"))


# ------------------------------------------------------------------- uniqueness

def assert_unique_ids(recs: DataFrame, keys: list[str]) -> DataFrame:
    """Recordings of a dataset must not share an output id."""
    audit = recs.groupBy(*keys).agg(F.count("*").alias("_n")).where(
        F.assert_true(F.col("_n") == 1, F.lit("output id used twice")).isNull())
    return recs.join(audit.select(*keys), keys, "left_semi")


def overlapping_trees(datasets: DataFrame, path: str = "output_dir") -> DataFrame:
    """Pairs of datasets whose output trees are equal or nested: each path meets its ancestors by equality."""
    clean = F.regexp_replace(F.col(path), r"/+$", "")
    parts = F.split(clean, "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    inner = datasets.select(F.col("dataset").alias("inner_dataset"), F.explode(above).alias("_dir"))
    outer = datasets.select(F.col("dataset").alias("outer_dataset"), clean.alias("_dir"))
    return inner.join(outer, "_dir").where("inner_dataset <> outer_dataset").select("outer_dataset", "inner_dataset", F.col("_dir").alias("shared"))


def select_t1_files(files: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Anatomical files per subject; datasets without a standard one use the name patterns of the fallback."""
    path = F.col("path")
    low = F.lower(path)
    keep = F.lit(True)
    if include:
        keep = keep & F.exists(F.array(*[F.lit(w.lower()) for w in include]), lambda w: F.contains(low, w))
    if exclude:
        keep = keep & ~F.exists(F.array(*[F.lit(w.lower()) for w in exclude]), lambda w: F.contains(low, w))
    f = files.where(keep).withColumn("subject", _in_name_or_path(path, "sub")).where("subject <> ''")
    standard = f.where(file_name(path).rlike(T1_STANDARD))
    loose = F.lit(False)
    for pattern in T1_FALLBACK:
        loose = loose | file_name(path).rlike(pattern)
    fallback = f.where(loose & ~F.array_contains(F.split(path, "/"), "derivatives")).join(
        standard.select("dataset").distinct(), "dataset", "left_anti").select(*f.columns)
    chosen = standard.select(*f.columns).unionByName(fallback).select("dataset", "subject", "path").distinct()
    # files of one subject: a handful
    return chosen.groupBy("dataset", F.concat(F.lit("sub-"), "subject").alias("subject")).agg(
        F.array_sort(F.collect_set("path")).alias("files"))
