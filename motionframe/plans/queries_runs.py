"""Queries over predictions and experiments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import uniform
from ..operators import experiments as X
from ..operators import predict as P
from ..sources.files import scratch
from ..sources.views import detections, results, table
from ..streaming import runlog


def names():
    return F.create_map(*(x for i in range(64) if i % 3 for x in (F.lit(i), F.lit(f"class_{i}"))))


def clips(s, d):
    logits = table(s, d, "embeddings").select(F.col("vec_id").alias("clip_id"), F.col("label").alias("track"), F.transform("embedding", lambda x: x.cast("double")).alias("logits"))
    return P.predicted(logits, names())


def some_failed(s, d):
    return clips(s, d).withColumn("probability_vector", F.when(F.col("clip_id") % 5 != 0, F.col("probability_vector")))


def full(s, d):
    return P.full_report(some_failed(s, d), "track", names(), "clip_id", "v.mp4", "models/m")


def lengths(s, d):
    return detections(s, d).groupBy("track_id").agg((F.count("*") % 40 + 1).cast("int").alias("n"))


def frames(s, d, how):
    return lengths(s, d).select("track_id", "n", F.array_join(F.transform(P.sampled_frames(F.col("n"), how, draw=uniform(F.col("track_id").cast("string"), F.lit("offset"))), lambda x: x.cast("string")), ",").alias("frames"))


def sides(s, d):
    r = results(s, d)
    return r.where("not remote").drop("remote"), r.where("remote").drop("remote")


def flags(s, d):
    local, remote = sides(s, d)
    return results(s, d), local.where("status <> 'pending'"), remote.where("status = 'completed'")


def phase(s, d):
    """The local rows, and an outcome for each id that has a remote one: an error where that isn't completed."""
    local, remote = sides(s, d)
    return local.drop("seq"), remote.select("experiment_id", F.when(F.col("status") != "completed", F.col("status")).alias("error_message"), (F.col("val_acc") + 1).alias("val_acc"))


def run_events(s, d):
    """Orders as events of their customer's experiment: every twentieth resets it, the parity of the order is the writer."""
    o = table(s, d, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed")
    return o.select(
        F.format_string("exp_%06d", "o_custkey").alias("experiment_id"), F.when(F.col("o_orderkey") % 20 == 0, "reset").otherwise("put").alias("op"), F.col("o_orderdate").cast("timestamp").alias("at"), F.col("o_orderkey").alias("seq"),
        status.alias("status"), F.round(F.col("o_totalprice") % 100, 2).alias("val_acc"), (F.col("o_orderkey") % 2).alias("w"),
    )


def logged(s, d):
    """What a log of two writers says, one of whom compacts it before the other is done."""
    log, rows = scratch(s), run_events(s, d)
    runlog.append(rows.where("w = 0 and seq % 3 = 0"), log, "w0")
    runlog.append(rows.where("w = 1"), log, "w1")
    runlog.compact(s, log)
    runlog.append(rows.where("w = 0 and seq % 3 <> 0"), log, "w0")
    return runlog.results(s, log).select("experiment_id", "status", "val_acc", "seq")


def filled(rows):
    """rows with the other columns of a result; each fifth has none of them."""
    seq, acc = F.col("seq"), F.col("val_acc")
    kinds = F.when(seq % 3 == 0, F.array().cast("array<string>")).when(seq % 3 == 1, F.array(F.lit("flip"))).otherwise(F.array(F.lit("flip"), F.lit("blur")))
    return rows.withColumns({
        "augmentations": kinds, "original_train_count": (seq % 50).cast("int"), "augmented_train_count": (seq % 50 * 25).cast("int"), "versions_per_video": F.lit(25), "train_acc": acc / 3, "test_acc": acc / 7,
        "best_val_acc": acc, "train_loss": acc / 11, "val_loss": acc / 13, "test_loss": acc / 17, "training_time_seconds": F.when(acc.isNotNull(), seq / 7),
    })


def batches(s, d):
    l = table(s, d, "lineitem")
    return l.select(F.col("l_orderkey").alias("batch"), (F.col("l_discount") * 10).alias("loss"), (F.col("l_returnflag") == "N").alias("hit"))


def epochs(s, d):
    l = table(s, d, "lineitem")
    return l.groupBy(F.col("l_suppkey").alias("run"), F.col("l_linenumber").alias("epoch")).agg(F.round(F.avg("l_quantity"), 4).alias("val_accuracy"))


R6 = lambda df, *cs: df.withColumns({c: F.round(c, 6) for c in cs})
QUERIES = {
    "f5_softmax": lambda s, d: clips(s, d).select("clip_id", F.posexplode("probability_vector").alias("i", "p")).withColumn("p", F.round("p", 9)),
    "f5_clip_prediction": lambda s, d: R6(clips(s, d).select("clip_id", "predicted_idx", "predicted_label", "confidence"), "confidence"),
    "f5_mean_probability": lambda s, d: R6(P.mean_probability(clips(s, d), "track").select("track", "predicted_idx", "confidence", "n_clips"), "confidence"),
    "f5_clips_per_track": lambda s, d: P.clips_per_track(clips(s, d), "track"),
    "f5_primary_track": lambda s, d: P.primary_track(clips(s, d), "track"),
    "f5_report": lambda s, d: R6(P.report(some_failed(s, d), "track", names()), "confidence"),
    "f5_temporal_uniform": lambda s, d: frames(s, d, "uniform"),
    "f5_temporal_center_loop": lambda s, d: frames(s, d, "centre"),
    "f5_temporal_offset": lambda s, d: frames(s, d, "offset"),
    "f5_accuracy_loss": lambda s, d: R6(P.accuracy(batches(s, d)), "accuracy", "loss"),
    "f5_best_epoch": lambda s, d: P.best_epochs(epochs(s, d)),
    "f5_clip_percents": lambda s, d: clips(s, d).select("clip_id", F.explode(P.percents(F.col("probability_vector"), names())).alias("label", "percent")).withColumn("percent", F.round("percent", 6)),
    "f5_report_clips": lambda s, d: full(s, d).select("video", "total_runners_detected", "primary_track_id", "primary_track_selection_reason", "num_clips", F.explode("per_clip").alias("c")).select("*", "c.clip", "c.predicted_label", F.round("c.confidence", 6).alias("confidence"), F.size("c.probabilities").alias("classes")).drop("c"),
    "f5_report_means": lambda s, d: full(s, d).select("primary_track_id", F.explode("mean_probabilities").alias("label", "percent")).withColumn("percent", F.round("percent", 6)),
    "f6_log_state": logged,
    "f6_upsert": lambda s, d: X.upserted(*sides(s, d)),
    "f6_merge_save": lambda s, d: X.saved(*sides(s, d)),
    "f6_merge_load": lambda s, d: X.loaded(*sides(s, d)),
    "f6_status_summary": lambda s, d: X.status_summary(X.saved(*sides(s, d))),
    "f6_ranked_summary": lambda s, d: X.ranked(X.saved(*sides(s, d))).select("experiment_id", "val_acc", "rank"),
    "f6_eligible": lambda s, d: X.eligible(*flags(s, d)[1:], wanted=flags(s, d)[0].where("val_acc is not null")),
    "f6_progress": lambda s, d: X.progress(*flags(s, d)),
    "f6_remaining": lambda s, d: X.remaining(*flags(s, d)[:2]),
    "f6_after_phase": lambda s, d: X.after_phase(*phase(s, d)),
    "f6_list": lambda s, d: X.listed(*flags(s, d)),
    "f6_results_csv": lambda s, d: X.csv_rows(filled(X.saved(*sides(s, d)))),
    "f6_short_names": lambda s, d: results(s, d).select("experiment_id", X.shortened(F.concat("status", F.lit("_"), "experiment_id"), 14).alias("shown")).distinct(),
    "f6_batch_tally": lambda s, d: X.batch_tally(table(s, d, "events").select((F.col("event_id") % 7).alias("clips_generated"), (F.col("event_type") != "error").alias("success"))),
}

CLIP = """
lg AS (SELECT vec_id AS clip_id, label AS track, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding)))::INT AS i FROM embeddings),
ex AS (SELECT *, exp(x - max(x) OVER (PARTITION BY clip_id)) AS e FROM lg),
pr AS (SELECT clip_id, track, i, e / sum(e) OVER (PARTITION BY clip_id) AS p, x FROM ex),
cp AS (SELECT clip_id, track, arg_max(i, (x, -i)) AS idx, max(p) AS conf FROM pr GROUP BY ALL)
"""
NAME = "CASE WHEN idx % 3 <> 0 THEN 'class_' || idx ELSE idx::VARCHAR END"
MEAN = "me AS (SELECT track, i, avg(p) AS p, count(*) AS n FROM {src} GROUP BY ALL), tr AS (SELECT track, arg_max(i, (p, -i)) AS idx, max(p) * 100 AS conf, max(n) AS n_clips FROM me GROUP BY track)"
RES = """
re AS (SELECT printf('exp_%06d', o_custkey) AS experiment_id, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status, CASE WHEN o_orderkey % 5 <> 0 THEN round(o_totalprice % 100, 2) END AS val_acc,
    o_orderkey % 2 = 0 AS remote, o_orderkey AS seq FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderkey % 2 ORDER BY o_orderkey DESC) = 1),
lo AS (SELECT experiment_id, status, val_acc, seq FROM re WHERE NOT remote), rm AS (SELECT experiment_id, status, val_acc, seq FROM re WHERE remote),
sv AS (SELECT lo.* FROM lo LEFT JOIN rm USING (experiment_id) WHERE lo.status = 'completed' OR rm.status IS NULL OR rm.status <> 'completed' UNION ALL SELECT rm.* FROM rm LEFT JOIN lo USING (experiment_id) WHERE rm.status = 'completed' AND (lo.status IS NULL OR lo.status <> 'completed')),
au AS (SELECT DISTINCT experiment_id FROM lo WHERE status <> 'pending'), td AS (SELECT DISTINCT experiment_id FROM rm WHERE status = 'completed'), al AS (SELECT DISTINCT experiment_id FROM re)
"""


def frames_sql(pick: str) -> str:
    return f"WITH c AS (SELECT user_id::INT AS track_id, (count(*) % 40 + 1)::INT AS n FROM events GROUP BY user_id) SELECT track_id, n, array_to_string(list_transform(range(16), lambda i: CASE WHEN n >= 16 THEN ({pick})::INT ELSE (i % n)::INT END), ',') AS frames FROM c"


SQL = {
    "f5_softmax": f"WITH {CLIP} SELECT clip_id, i, round(p, 9) AS p FROM pr",
    "f5_clip_prediction": f"WITH {CLIP} SELECT clip_id, idx AS predicted_idx, {NAME} AS predicted_label, round(conf * 100, 6) AS confidence FROM cp",
    "f5_mean_probability": f"WITH {CLIP}, {MEAN.format(src='pr')} SELECT track, idx AS predicted_idx, round(conf, 6) AS confidence, n_clips FROM tr",
    "f5_clips_per_track": "SELECT label AS track, count(*) AS n_clips FROM embeddings GROUP BY label",
    "f5_primary_track": "SELECT label AS track, count(*) AS n_clips FROM embeddings GROUP BY label ORDER BY n_clips DESC, track LIMIT 1",
    "f5_report": f"WITH {CLIP}, g AS (SELECT * FROM pr WHERE clip_id % 5 <> 0), {MEAN.format(src='g')}, m AS (SELECT label AS track FROM embeddings GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) SELECT (SELECT count(DISTINCT label) FROM embeddings) AS tracks, m.track AS primary_track, CASE WHEN tr.idx IS NULL THEN 'all clips failed' ELSE 'success' END AS outcome, {NAME} AS predicted_label, round(conf, 6) AS confidence, coalesce(n_clips, 0)::BIGINT AS num_clips FROM m LEFT JOIN tr USING (track)",
    "f5_temporal_uniform": frames_sql("floor(i * (n - 1) / 15.0::DOUBLE)"),
    "f5_temporal_center_loop": frames_sql("(n - 16) // 2 + i"),
    "f5_temporal_offset": frames_sql("floor(('0x' || substr(md5(track_id || '|offset'), 1, 8))::BIGINT / 4294967296.0::DOUBLE * (n - 15)) + i"),
    "f5_accuracy_loss": "WITH b AS (SELECT l_orderkey, avg(l_discount * 10) AS loss, count(*) FILTER (l_returnflag = 'N') AS hits, count(*) AS n FROM lineitem GROUP BY 1) SELECT round(sum(hits) / sum(n) * 100, 6) AS accuracy, round(avg(loss), 6) AS loss FROM b",
    "f5_best_epoch": "WITH e AS (SELECT l_suppkey AS run, l_linenumber AS epoch, round(avg(l_quantity), 4) AS val_accuracy FROM lineitem GROUP BY ALL) SELECT *, val_accuracy > coalesce(max(val_accuracy) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS is_best FROM e",
    "f5_clip_percents": f"WITH {CLIP} SELECT clip_id, {NAME.replace('idx', 'i')} AS label, round(p * 100, 6) AS percent FROM pr",
    "f5_report_clips": f"WITH {CLIP}, m AS (SELECT label AS track, (SELECT count(DISTINCT label) FROM embeddings) AS n FROM embeddings GROUP BY label ORDER BY count(*) DESC, label LIMIT 1), g AS (SELECT clip_id, idx, conf, m.* FROM cp JOIN m USING (track) WHERE clip_id % 5 <> 0) SELECT 'v.mp4' AS video, n AS total_runners_detected, track AS primary_track_id, 'most_clips' AS primary_track_selection_reason, count(*) OVER () AS num_clips, clip_id::VARCHAR AS clip, {NAME} AS predicted_label, round(conf * 100, 6) AS confidence, 64::INT AS classes FROM g",
    "f5_report_means": f"WITH {CLIP}, m AS (SELECT label AS track FROM embeddings GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) SELECT track AS primary_track_id, {NAME.replace('idx', 'i')} AS label, round(avg(p) * 100, 6) AS percent FROM pr JOIN m USING (track) WHERE clip_id % 5 <> 0 GROUP BY track, i",
    # the last reset takes what came before it; then completed before not, late before early
    "f6_log_state": """WITH e AS (SELECT printf('exp_%06d', o_custkey) AS experiment_id, o_orderkey % 20 = 0 AS is_reset, {'at': o_orderdate, 'w': o_orderkey % 2, 'seq': o_orderkey} AS pos, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status, round(o_totalprice % 100, 2) AS val_acc FROM orders),
        r AS (SELECT *, max(pos) FILTER (is_reset) OVER (PARTITION BY experiment_id) AS cut FROM e)
        SELECT experiment_id, status, val_acc, pos.seq AS seq FROM r WHERE NOT is_reset AND (cut IS NULL OR pos > cut) QUALIFY row_number() OVER (PARTITION BY experiment_id ORDER BY status = 'completed' DESC, pos DESC) = 1""",
    "f6_upsert": f"WITH {RES} SELECT * FROM rm UNION ALL SELECT * FROM lo ANTI JOIN rm USING (experiment_id)",
    "f6_merge_save": f"WITH {RES} SELECT * FROM sv",
    "f6_merge_load": f"WITH {RES} SELECT rm.*, CASE WHEN lo.experiment_id IS NULL THEN 'new' ELSE 'updated' END AS origin FROM rm LEFT JOIN lo USING (experiment_id) UNION ALL SELECT lo.*, 'current' FROM lo ANTI JOIN rm USING (experiment_id)",
    "f6_status_summary": f"WITH {RES} SELECT count(*) AS total_experiments, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'failed') AS failed FROM sv",
    # sorted(completed, key=lambda r: r.val_acc or 0, reverse=True), which keeps equal ones in their order: of (a, 50), (b, none), (c, 70, pending), (d, 50) come a, d, b
    "f6_ranked_summary": f"WITH {RES} SELECT experiment_id, val_acc, (row_number() OVER (ORDER BY coalesce(val_acc, 0) DESC, seq))::INT AS rank FROM sv WHERE status = 'completed'",
    "f6_eligible": f"WITH {RES} SELECT experiment_id FROM au WHERE experiment_id IN (SELECT experiment_id FROM re WHERE val_acc IS NOT NULL) AND experiment_id NOT IN (SELECT experiment_id FROM td)",
    "f6_progress": f"WITH {RES}, f AS (SELECT al.experiment_id, au.experiment_id AS a, td.experiment_id AS t FROM al LEFT JOIN au USING (experiment_id) LEFT JOIN td USING (experiment_id)) SELECT count(*) AS total, count(a) AS augmented, count(t) AS trained, count(*) FILTER (t IS NULL) AS remaining FROM f",
    "f6_remaining": f"WITH {RES} SELECT experiment_id FROM al WHERE experiment_id NOT IN (SELECT experiment_id FROM au)",
    # a result becomes completed with the metrics, or failed with the message; without an outcome it stays
    "f6_after_phase": f"WITH {RES} SELECT lo.experiment_id, CASE WHEN rm.status IS NULL THEN lo.status WHEN rm.status = 'completed' THEN 'completed' ELSE 'failed' END AS status, CASE WHEN rm.status = 'completed' THEN rm.val_acc + 1 ELSE lo.val_acc END AS val_acc FROM lo LEFT JOIN rm USING (experiment_id)",
    "f6_list": f"WITH {RES} SELECT experiment_id, experiment_id IN (SELECT experiment_id FROM au) AS augmented, experiment_id IN (SELECT experiment_id FROM td) AS trained FROM al",
    # "+".join(augmentations) or "none", counts as they are, accuracies with 2 digits, losses with 4, seconds with none, "" for what there isn't: (x, [flip, blur], 7, 175, 25, 66.666, none, ...) is x,flip+blur,7,175,25,66.67,,...
    "f6_results_csv": f"""WITH {RES}, n AS (SELECT *, ['none', 'flip', 'flip+blur'][seq % 3 + 1] AS augmentations FROM sv)
        SELECT experiment_id, augmentations, (seq % 50)::VARCHAR AS original_samples, (seq % 50 * 25)::VARCHAR AS augmented_samples, '25' AS versions_per_video, """ + ", ".join(
        f"CASE WHEN val_acc IS NULL THEN '' ELSE printf('%.{n}f', {e}) END AS {c}" for c, n, e in (
            ("train_acc", 2, "val_acc / 3"), ("val_acc", 2, "val_acc"), ("test_acc", 2, "val_acc / 7"), ("best_val_acc", 2, "val_acc"), ("train_loss", 4, "val_acc / 11"), ("val_loss", 4, "val_acc / 13"), ("test_loss", 4, "val_acc / 17"), ("training_time_s", 0, "seq / 7"))
    ) + ", status FROM n",
    "f6_short_names": f"WITH {RES} SELECT DISTINCT experiment_id, CASE WHEN len(status || '_' || experiment_id) > 14 THEN left(status || '_' || experiment_id, 13) || '~' ELSE status || '_' || experiment_id END AS shown FROM re",
    "f6_batch_tally": "SELECT sum(event_id % 7) FILTER (event_type <> 'error')::BIGINT AS clips, count(*) FILTER (event_type <> 'error') AS processed, count(*) FILTER (event_type = 'error') AS failed FROM events",
}
