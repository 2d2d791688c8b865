"""Queries over augmentation plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import PRESET_NAMES, AugmentConfig
from ..operators import augment as A
from ..operators.catalog import augmented_name
from ..sources.views import videos

N = 4
CONFIG = AugmentConfig(versions=N)


def clips(s, d):
    return videos(s, d).select("doc_id", "path", "stem")


def split(s, d):
    part = F.when(F.col("doc_id") % 10 < 7, "train").when(F.col("doc_id") % 10 == 7, "val").otherwise("test")
    return clips(s, d).select("path", part.alias("split"))


def available(s, d):
    """Files of which every seventh version is missing."""
    return A.versions(clips(s, d), N).where((F.col("doc_id") * N + F.col("version")) % 7 != 0).select(augmented_name(F.col("stem"), F.col("version")).alias("name"), "doc_id")


def trained(s, d):
    """All clips as train videos, and the files of those that have a label."""
    return clips(s, d).select(F.col("doc_id").alias("place"), "stem"), available(s, d).where("name not like '%???.mp4'")


def drawn(s, d):
    return A.params_native(A.versions(clips(s, d).select("doc_id", "stem"), N), CONFIG)


def assigned(s, d):
    """Every clip with a preset, in turn."""
    names = F.array(*map(F.lit, PRESET_NAMES))
    return clips(s, d).select("doc_id", "stem", F.element_at(names, (F.col("doc_id") % len(PRESET_NAMES)).cast("int") + 1).alias("preset"))


def rounded(df):
    return df.withColumns({p: F.round(p, 9) for p in A.PARAMS})


QUERIES = {
    "f4_expand_versions": lambda s, d: A.versions(clips(s, d), N).select("doc_id", "version", augmented_name(F.col("stem"), F.col("version")).alias("name")),
    "f4_augmented_json": lambda s, d: A.planned(split(s, d), N, "gs://bucket/made"),
    "f4_seed": lambda s, d: A.versions(clips(s, d), N).select("doc_id", "version", A.seed(F.col("stem"), F.col("version")).alias("seed")),
    "f4_params_native": lambda s, d: rounded(drawn(s, d)).drop("stem"),
    "f4_describe": lambda s, d: drawn(s, d).select("doc_id", "version", F.regexp_replace(A.described(), r"-?\d+\.\d+", "#").alias("kinds")),
    "f4_params_exact": lambda s, d: A.params_exact(A.versions(clips(s, d).select("doc_id", "stem"), N), CONFIG).drop("stem"),
    "f4_presets": lambda s, d: A.presets(s).select("place", "name", F.array_join("augmentations", ",").alias("augmentations"), "description"),
    "f4_preset_config": lambda s, d: A.preset_configs(s, 25),
    "f4_preset_params": lambda s, d: rounded(A.preset_params(assigned(s, d), CONFIG)).drop("stem"),
    "f4_suite": lambda s, d: A.suite(clips(s, d), N),
    "f4_map_versions": lambda s, d: A.mapped(clips(s, d), available(s, d), N).select("doc_id", "version", "name", "present"),
    "f4_coverage": lambda s, d: A.coverage(A.mapped(clips(s, d), available(s, d), N)).withColumn("percent", F.round("percent", 6)),
    "f4_first_missing": lambda s, d: A.first_missing(A.mapped(clips(s, d), available(s, d), N), 2).withColumn("first", F.array_join("first", ",")),
    "f4_augmented_split": lambda s, d: A.augmented_split(split(s, d), available(s, d), N, "gs://bucket/raw/", "gs://bucket/made/"),
    "f4_experiment_split": lambda s, d: A.experiment_split(*trained(s, d)),
    "f4_experiment_counts": lambda s, d: A.experiment_counts(*trained(s, d)),
    "f4_pending": lambda s, d: A.pending(clips(s, d).select("doc_id", "path"), clips(s, d).where("doc_id % 4 = 1")),
    "f4_checkpoint_merge": lambda s, d: A.checkpoint_merge(clips(s, d).where("stem not like '%???'").select("path"), clips(s, d).where("stem like '%???' or path like 'en/%'").select("path")),
    "f4_cutout_rect": lambda s, d: drawn(s, d).select("doc_id", "version", *(c.alias(k) for k, c in A.cutout_rectangle(224, 224, 0.15).items())),
    "f4_blur_kernel": lambda s, d: drawn(s, d).where("blur_sigma is not null").select("doc_id", "version", A.blur_kernel(F.col("blur_sigma")).alias("side")),
}

VID = r"""
vid AS (SELECT doc_id, lang, lang || '/clips/' || stem || '.mp4' AS path, stem, regexp_extract(stem, '^(.*)_([^_]*)$', 1) AS base, right(stem, 3) AS lab FROM (
    SELECT doc_id, lang, printf('%s_RUN%d_%s_lap_%03d_CUT_%03d_%s', source, doc_id % 3 + 1, upper(lang), doc_id % 100, doc_id, coalesce(printf('%03d', quality + 2 * toxic), '???')) AS stem FROM documents LEFT JOIN labels USING (doc_id))),
ver AS (SELECT *, printf('%s_v%03d_%s.mp4', base, version, lab) AS name FROM (SELECT *, unnest(range(1, 5))::INT AS version FROM vid)),
av AS (SELECT name, doc_id, stem, lab FROM ver WHERE (doc_id * 4 + version) % 7 <> 0),
spl AS (SELECT *, CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 = 7 THEN 'val' ELSE 'test' END AS split FROM vid)
"""


def u(slot: str) -> str:
    return f"(('0x' || substr(md5(stem || '|' || version || '|{slot}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def draw(name: str, kind: str, p: float, lo: float, hi: float) -> str:
    return f"CASE WHEN {u('on:' + kind)} < {p}::DOUBLE THEN {lo}::DOUBLE + ({hi}::DOUBLE - {lo}::DOUBLE) * {u(name)} END AS {name}"


DRAWN = f"""{VID}, dr AS (SELECT doc_id, version, {u('on:flip')} < 0.7::DOUBLE AS flip, {draw('brightness', 'brightness_contrast', 0.8, -0.25, 0.25)}, {draw('contrast', 'brightness_contrast', 0.8, -0.25, 0.25)}, {draw('blur_sigma', 'blur', 0.6, 0.1, 1.0)},
    {draw('rotation', 'rotation', 0.8, -5.0, 5.0)}, {draw('scale', 'scale', 0.6, 0.9, 1.1)}, {draw('cutout_top', 'cutout', 0.6, 0.0, 0.35)}, {draw('cutout_left', 'cutout', 0.6, 0.0, 0.85)} FROM ver)"""
PROB = {"flip": 0.7, "brightness_contrast": 0.8, "blur": 0.6, "rotation": 0.8, "scale": 0.6, "cutout": 0.6}
#: The kind that each parameter belongs to.
KIND = {"brightness": "brightness_contrast", "contrast": "brightness_contrast", "blur_sigma": "blur", "rotation": "rotation", "scale": "scale", "cutout_top": "cutout", "cutout_left": "cutout"}
SHORT = {"flip": "flip", "bc": "brightness_contrast", "blur": "blur", "rotation": "rotation", "scale": "scale", "cutout": "cutout"}
ORDERED = """
'baseline', 'flip_only', 'bc_only', 'blur_only', 'rotation_only', 'scale_only', 'cutout_only', 'flip_bc', 'flip_blur', 'flip_rotation', 'flip_scale', 'flip_cutout', 'bc_blur', 'bc_rotation', 'bc_scale', 'bc_cutout', 'blur_rotation',
'rotation_scale', 'rotation_cutout', 'flip_bc_blur', 'flip_bc_rotation', 'flip_bc_cutout', 'flip_rotation_scale', 'flip_blur_cutout', 'bc_blur_rotation', 'bc_blur_cutout', 'bc_rotation_scale', 'blur_rotation_scale', 'rotation_scale_cutout', 'all_augmentations'
"""
PRESETS = f"""
nm AS (SELECT unnest([{ORDERED}]) AS name, unnest(range(30))::INT AS place),
pr AS (SELECT place, name, CASE name WHEN 'baseline' THEN []::VARCHAR[] WHEN 'all_augmentations' THEN ['flip', 'brightness_contrast', 'blur', 'rotation', 'scale', 'cutout']
    ELSE list_transform(string_split(regexp_replace(name, '_only$', ''), '_'), lambda x: CASE x WHEN 'bc' THEN 'brightness_contrast' ELSE x END) END AS a FROM nm)
"""
SQL = {
    "f4_expand_versions": f"WITH {VID} SELECT doc_id, version, name FROM ver",
    "f4_augmented_json": f"WITH {VID} SELECT 'gs://bucket/made/' || name AS path, 'train' AS split FROM ver WHERE doc_id % 10 < 7 UNION ALL SELECT path, split FROM spl WHERE split <> 'train'",
    "f4_seed": f"WITH {VID} SELECT doc_id, version, ('0x' || substr(md5(stem || '_' || version), 1, 8))::BIGINT AS seed FROM ver",
    "f4_params_native": f"WITH {DRAWN} SELECT doc_id, version, flip, " + ", ".join(f"round({p}, 9) AS {p}" for p in A.PARAMS) + " FROM dr",
    "f4_describe": f"WITH {DRAWN} SELECT doc_id, version, concat_ws('+', 'gray', CASE WHEN flip THEN 'flip' END, CASE WHEN brightness IS NOT NULL THEN 'bc(#,#)' END, CASE WHEN blur_sigma IS NOT NULL THEN 'blur(#)' END, CASE WHEN rotation IS NOT NULL THEN 'rot(#)' END, CASE WHEN scale IS NOT NULL THEN 'scale(#)' END, CASE WHEN cutout_top IS NOT NULL THEN 'cutout' END) AS kinds FROM dr",
    "f4_presets": f"WITH {PRESETS} SELECT place, name, array_to_string(a, ',') AS augmentations, CASE WHEN len(a) = 0 THEN 'Baseline (grayscale only)' ELSE array_to_string(a, ' + ') END AS description FROM pr",
    "f4_preset_config": f"WITH {PRESETS} SELECT name, CASE WHEN len(a) = 0 THEN 1 ELSE 25 END AS versions, " + ", ".join(f"CASE WHEN list_contains(a, '{k}') THEN {p}::DOUBLE ELSE 0::DOUBLE END AS {k}" for k, p in PROB.items()) + " FROM pr",
    "f4_preset_params": f"WITH {DRAWN}, {PRESETS} SELECT doc_id, version, name AS preset, flip AND list_contains(a, 'flip') AS flip, "
    + ", ".join(f"CASE WHEN list_contains(a, '{k}') THEN round({p}, 9) END AS {p}" for p, k in KIND.items())
    + " FROM dr JOIN pr ON place = doc_id % 30 WHERE version = 1 OR len(a) > 0",
    "f4_suite": f"WITH {DRAWN}, {PRESETS}, x AS (SELECT place, name, CASE WHEN len(a) = 0 THEN 1 ELSE 4 END AS versions, list_contains(a, 'flip') AND flip AS flip, "
    + ", ".join(f"list_contains(a, '{k}') AND {p} IS NOT NULL AS {k}" for p, k in KIND.items() if p not in ("contrast", "cutout_left"))
    + " FROM dr JOIN pr ON version = 1 OR len(a) > 0) SELECT place, name, versions, count(*) AS made, count(*) FILTER (NOT ("
    + " OR ".join(PROB)
    + ")) AS plain, "
    + ", ".join(f"count(*) FILTER ({k}) AS {k}" for k in PROB)
    + " FROM x GROUP BY ALL",
    "f4_map_versions": f"WITH {VID} SELECT doc_id, version, name, name IN (SELECT name FROM av) AS present FROM ver",
    "f4_coverage": f"WITH {VID}, m AS (SELECT *, name IN (SELECT name FROM av) AS present FROM ver) SELECT count(*) AS expected, count(*) FILTER (NOT present) AS missing, round(count(*) FILTER (present) / count(*) * 100, 6) AS percent, count(DISTINCT stem) FILTER (NOT present) AS affected FROM m",
    "f4_first_missing": f"WITH {VID}, m AS (SELECT stem, count(*) AS missing, list_sort(list(name)) AS n FROM ver ANTI JOIN av USING (name) GROUP BY stem) SELECT stem, missing, array_to_string(n[1:2], ',') AS first FROM m",
    "f4_augmented_split": f"WITH {VID} SELECT 'gs://bucket/made/' || name AS path, 'train' AS split FROM av WHERE doc_id % 10 < 7 UNION ALL SELECT 'gs://bucket/raw/' || stem || '.mp4', split FROM spl WHERE split <> 'train'",
    # the versions of a train video in the order of their names; one without any is passed over and counted
    "f4_experiment_split": f"WITH {VID}, f AS (SELECT * FROM av WHERE lab <> '???') SELECT vid.doc_id AS place, (row_number() OVER (PARTITION BY vid.doc_id ORDER BY f.name))::INT AS k, vid.stem, f.name FROM vid JOIN f USING (stem)",
    "f4_experiment_counts": f"WITH {VID}, f AS (SELECT * FROM av WHERE lab <> '???'), n AS (SELECT stem, count(*) AS n FROM f GROUP BY stem) SELECT count(*) AS original_train_count, coalesce(sum(n), 0)::BIGINT AS augmented_train_count, count(*) FILTER (n IS NULL) AS missing_train_count FROM vid LEFT JOIN n USING (stem)",
    "f4_pending": f"WITH {VID} SELECT doc_id, path FROM vid WHERE doc_id % 4 <> 1",
    "f4_checkpoint_merge": f"WITH {VID} SELECT path FROM vid WHERE lab <> '???' UNION SELECT path FROM vid WHERE lab = '???' OR lang = 'en'",
    # int(left_frac * (w - cutout_w)), int(top_frac * (h - cutout_h)), where cutout_w = int(w * sqrt(ratio)): with 224 and 0.15 the side is 86, and left 0.5 gives 69
    "f4_cutout_rect": f"WITH {DRAWN} SELECT doc_id, version, trunc(cutout_left * (224 - trunc(224 * sqrt(0.15::DOUBLE))))::INT AS x, trunc(cutout_top * (224 - trunc(224 * sqrt(0.15::DOUBLE))))::INT AS y, CASE WHEN cutout_top IS NOT NULL THEN trunc(224 * sqrt(0.15::DOUBLE))::INT END AS w, CASE WHEN cutout_top IS NOT NULL THEN trunc(224 * sqrt(0.15::DOUBLE))::INT END AS h FROM dr",
    "f4_blur_kernel": f"WITH {DRAWN} SELECT doc_id, version, greatest((2 * round_even(3 * blur_sigma, 0) + 1)::INT, 3) AS side FROM dr WHERE blur_sigma IS NOT NULL",
}
