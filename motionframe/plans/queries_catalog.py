"""Queries over catalogues of clips and over splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import SplitConfig
from ..functions.scalars import file_name
from ..operators import catalog as K
from ..operators import split as S
from ..sources.views import runners, videos

REMAP = {2: 0}
SPLIT = SplitConfig()


def good(s, d):
    return K.parsed(videos(s, d)).where("parsed")


def info(s, d):
    v = K.labelled(videos(s, d).withColumn("path", F.concat(F.split_part("path", F.lit("/"), F.lit(1)), F.lit("/clips/"), F.regexp_extract("path", r"(lap_\d+)_CUT", 1), F.lit("_"), F.regexp_extract("path", r"_([\d?]{3})\.mp4$", 1), F.lit(".mp4"))))
    return v.select("doc_id", *(c.alias(k) for k, c in K.video_info(F.col("path")).items()))


def names(s, d):
    v = videos(s, d)
    version = (F.col("doc_id") % 1200).cast("int")
    augmented = K.augmented_name(F.col("stem"), version)
    return v.select(
        "doc_id", augmented.alias("augmented"), K.without_version(F.regexp_replace(augmented, r"\.mp4$", "")).alias("base"), K.below("gs://bucket/raw/", F.col("path")).alias("raw"),
        K.experiment_path("gs://bucket", "suite", F.col("stem"), "split.json").alias("split_path"),
    )


QUERIES = {
    "f2_find_labeled": lambda s, d: K.labelled(videos(s, d).withColumn("path", F.regexp_replace("path", r"_CUT_\d+", ""))).select("doc_id", "path"),
    "f2_parse_video_info": info,
    "f2_parse_filename": lambda s, d: good(s, d).select("doc_id", "runner_id", "run_number", "camera", "lap", "cut", "label"),
    "f2_parse_failures": lambda s, d: K.parsed(videos(s, d)).where("not parsed").select("doc_id", file_name(F.col("path")).alias("name")),
    "f2_label_from_name": lambda s, d: videos(s, d).select("doc_id", K.label_from_name(file_name(F.col("path")), REMAP).alias("label")),
    "f2_counts": lambda s, d: K.counts(good(s, d)),
    "f2_crosstab_label_runner": lambda s, d: K.cross(good(s, d), "label", "runner_id"),
    "f2_crosstab_label_camera": lambda s, d: K.cross(good(s, d), "label", "camera"),
    "f2_crosstab_runner_camera": lambda s, d: K.cross(good(s, d), "runner_id", "camera"),
    "f2_imbalance": lambda s, d: K.imbalance(good(s, d), "label").withColumn("of", F.lit("label")).unionByName(K.imbalance(good(s, d), "runner_id").withColumn("of", F.lit("runner"))).withColumn("ratio", F.round("ratio", 6)),
    "f2_distribution": lambda s, d: K.distribution(good(s, d), "label").withColumn("percent", F.round("percent", 6)),
    "f2_distinct_lists": lambda s, d: good(s, d).agg(F.array_join(F.array_sort(F.collect_set("runner_id")), ",").alias("runners"), F.array_join(F.array_sort(F.collect_set("camera")), ",").alias("cameras"), F.count_distinct("label").alias("labels")),
    "f2_name_builders": names,
    "f3_dominant_label": lambda s, d: S.dominant_labels(good(s, d), REMAP),
    "f3_split_stratified": lambda s, d: S.assigned(S.dominant_labels(runners(s, d)), SPLIT),
    "f3_split_simple": lambda s, d: S.assigned(S.dominant_labels(runners(s, d)), SPLIT, stratified=False),
    "f3_split_summary": lambda s, d: S.summary(S.split_videos(runners(s, d), SPLIT)),
    "f3_split_parts": lambda s, d: S.part_sizes(S.split_videos(runners(s, d), SPLIT)).withColumn("percent", F.round("percent", 6)),
    "f3_split_exact": lambda s, d: S.exact_split(S.dominant_labels(runners(s, d)), SPLIT),
    "f5_label_index": lambda s, d: K.label_index(good(s, d)),
}

VID = r"""
vid AS (SELECT doc_id, lang, printf('%s_RUN%d_%s_lap_%03d_CUT_%03d_%s', source, doc_id % 3 + 1, upper(lang), doc_id % 100, doc_id, coalesce(printf('%03d', quality + 2 * toxic), '???')) AS stem
    FROM documents LEFT JOIN labels USING (doc_id)),
pa AS (SELECT *, string_split(stem, '_') AS p FROM vid),
ok AS (SELECT doc_id, lang || '/clips/' || stem || '.mp4' AS path, stem, p[1] AS runner_id, CASE WHEN p[2] LIKE 'RUN%' THEN substr(p[2], 4)::INT ELSE 0 END AS run_number, p[3] AS camera, p[5]::INT AS lap, p[7]::INT AS cut, p[8]::INT AS label
    FROM pa WHERE len(p) >= 8 AND regexp_full_match(p[8], '[+-]?\d+'))
"""
RUN = """
rl AS (SELECT user_id::VARCHAR AS runner_id, event_type AS label, count(*) AS n, min(printf('%08d', event_id)) AS p FROM events GROUP BY ALL),
dom AS (SELECT runner_id, label FROM (SELECT *, row_number() OVER (PARTITION BY runner_id ORDER BY n DESC, p) AS r FROM rl) WHERE r = 1),
od AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || runner_id), runner_id) AS k, count(*) OVER (PARTITION BY label) AS n FROM dom),
nt AS (SELECT *, greatest(1, floor(n * 0.7::DOUBLE)) AS t, greatest(1, floor(n * 0.15::DOUBLE)) AS v FROM od),
sz AS (SELECT *, CASE WHEN n <= 2 THEN 1 WHEN n - t - v >= 1 THEN t ELSE n - v - 1 END AS nt, CASE WHEN n = 1 THEN 0 WHEN n = 2 THEN 1 ELSE v END AS nv FROM nt),
asg AS (SELECT runner_id, label, CASE WHEN k <= nt THEN 'train' WHEN k <= nt + nv THEN 'val' ELSE 'test' END AS split FROM sz),
sv AS (SELECT e.event_type AS label, a.split, a.runner_id FROM events e JOIN asg a ON a.runner_id = e.user_id::VARCHAR)
"""


def cross_sql(a: str, b: str) -> str:
    return f"WITH {VID} SELECT {a}, {b}, count(*) AS n FROM ok GROUP BY ALL"


SQL = {
    "f2_find_labeled": rf"WITH {VID} SELECT doc_id, regexp_replace(lang || '/clips/' || stem || '.mp4', '_CUT_\d+', '') AS path FROM vid",
    "f2_parse_video_info": rf"WITH {VID} SELECT doc_id, lang AS camera, printf('lap_%03d', doc_id % 100) AS lap, right(stem, 3) AS label FROM vid",
    "f2_parse_filename": f"WITH {VID} SELECT doc_id, runner_id, run_number, camera, lap, cut, label FROM ok",
    "f2_parse_failures": f"WITH {VID} SELECT doc_id, stem || '.mp4' AS name FROM vid WHERE doc_id NOT IN (SELECT doc_id FROM ok)",
    "f2_label_from_name": rf"WITH {VID} SELECT doc_id, CASE WHEN right(stem, 3) = '???' THEN 0 WHEN right(stem, 3)::INT = 2 THEN 0 ELSE right(stem, 3)::INT END AS label FROM vid",
    "f2_counts": f"WITH {VID} SELECT 'label' AS dimension, label::VARCHAR AS key, count(*) AS n FROM ok GROUP BY ALL UNION ALL SELECT 'runner', runner_id, count(*) FROM ok GROUP BY ALL UNION ALL SELECT 'camera', camera, count(*) FROM ok GROUP BY ALL",
    "f2_crosstab_label_runner": cross_sql("label", "runner_id"),
    "f2_crosstab_label_camera": cross_sql("label", "camera"),
    "f2_crosstab_runner_camera": cross_sql("runner_id", "camera"),
    "f2_imbalance": f"WITH {VID}, a AS (SELECT count(*) AS n FROM ok GROUP BY label), b AS (SELECT count(*) AS n FROM ok GROUP BY runner_id) SELECT round(max(n) / min(n), 6) AS ratio, 'label' AS of FROM a UNION ALL SELECT round(max(n) / min(n), 6), 'runner' FROM b",
    "f2_distribution": f"WITH {VID}, a AS (SELECT label, count(*) AS n FROM ok GROUP BY label) SELECT label, n, round(n / sum(n) OVER () * 100, 6) AS percent, max(n) OVER () / min(n) OVER () > 3 AS imbalanced FROM a",
    "f2_distinct_lists": f"WITH {VID} SELECT string_agg(DISTINCT runner_id, ',' ORDER BY runner_id) AS runners, string_agg(DISTINCT camera, ',' ORDER BY camera) AS cameras, count(DISTINCT label) AS labels FROM ok",
    "f2_name_builders": rf"""WITH {VID}, a AS (SELECT doc_id, lang, stem, printf('%s_v%03d_%s.mp4', regexp_extract(stem, '^(.*)_([^_]*)$', 1), doc_id % 1200, regexp_extract(stem, '^(.*)_([^_]*)$', 2)) AS augmented FROM vid)
        SELECT doc_id, augmented, regexp_replace(augmented[:-5], '_v\d{{3}}_', '_', 'g') AS base, 'gs://bucket/raw/' || stem || '.mp4' AS raw, 'gs://bucket/experiments/suite/' || stem || '/split.json' AS split_path FROM a""",
    "f3_dominant_label": f"WITH {VID}, c AS (SELECT runner_id, label, count(*) AS n, min(path) AS p FROM ok GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY runner_id ORDER BY n DESC, p) AS k FROM c) SELECT runner_id, CASE label WHEN 2 THEN 0 ELSE label END AS label FROM r WHERE k = 1",
    "f3_split_stratified": f"WITH {RUN} SELECT * FROM asg",
    "f3_split_simple": f"WITH {RUN}, o AS (SELECT runner_id, label, row_number() OVER (ORDER BY md5('42|' || runner_id), runner_id) AS k, count(*) OVER () AS n FROM dom) SELECT runner_id, label, CASE WHEN k <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN k <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM o",
    "f3_split_summary": f"WITH {RUN} SELECT label, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM sv GROUP BY label",
    "f3_split_parts": f"WITH {RUN}, g AS (SELECT split, count(*) AS clips, count(DISTINCT runner_id) AS runners FROM sv GROUP BY split) SELECT split, clips, runners, round(clips / sum(clips) OVER () * 100, 6) AS percent FROM g",
    "f5_label_index": f"WITH {VID} SELECT label, (row_number() OVER (ORDER BY label) - 1)::INT AS index FROM (SELECT DISTINCT label FROM ok)",
}
