"""Catalogues, splits, augmentation plans, predictions, experiments, files and kernels."""

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionframe import config
from motionframe.config import AugmentConfig, SplitConfig
from motionframe.functions import kernels as N
from motionframe.functions import scalars
from motionframe.operators import augment as A
from motionframe.operators import catalog as K
from motionframe.operators import experiments as X
from motionframe.operators import predict as P
from motionframe.operators import split as S
from motionframe.sources import files
from motionframe.streaming import resume


def test_name_parsing(spark):
    cases = {
        "04HN_RUN2_CAM1_lap_006_CUT_004_001": ("04HN", 2, "CAM1", 6, 4, 1), "04HN_RUN2_CAM1_lap_006_CUT_001_v015_001": None, "15VR_RUN2_CAM2_lap_017_CUT_001_???": None, "A_X9_C_lap_1_CUT_2_3": ("A", 0, "C", 1, 2, 3),
        "A_RUN_C_lap_1_CUT_2_3": None, "A_RUN1_C_lap_1_CUT_2": None, "A_RUN1_C_lap_1_CUT_2_3_extra": ("A", 1, "C", 1, 2, 3),
    }
    rows = K.parsed(spark.createDataFrame([(f"/x/{n}.mp4", n) for n in cases], "path string, n string")).collect()
    for r in rows:
        got = (r.runner_id, r.run_number, r.camera, r.lap, r.cut, r.label) if r.parsed else None
        assert got == cases[r.n]


def test_padding_and_versions(spark):
    row = spark.range(1).select(scalars.pad3(F.lit(1234)), scalars.pad3(F.lit(7)), K.without_version(F.lit("a_v001_b_v1000_c_v002_d")), K.augmented_name(F.lit("plain"), F.lit(3)), K.label_from_name(F.lit("x_2.mp4"), {2: 0}), K.label_from_name(F.lit("x.mp4"), {0: 5})).first()
    assert row[:] == ("1234", "007", "a_b_v1000_c_d", "plain_v003.mp4", 0, 0)


@pytest.mark.parametrize(("n", "wanted"), [(1, (1, 0, 0)), (2, (1, 1, 0)), (3, (1, 1, 1)), (4, (2, 1, 1)), (5, (3, 1, 1)), (6, (4, 1, 1)), (7, (4, 1, 2)), (10, (7, 1, 2)), (20, (14, 3, 3)), (90, (62, 13, 15))])
def test_split_sizes(spark, n, wanted):
    rows = S.assigned(spark.range(n).select(F.col("id").cast("string").alias("runner_id"), F.lit(1).alias("label")), SplitConfig()).groupBy("split").count().collect()
    got = {r["split"]: r["count"] for r in rows}
    assert tuple(got.get(p, 0) for p in ("train", "val", "test")) == wanted


def test_no_subject_in_two_parts_and_mode_before_remap(spark):
    rows = [(f"p{i:03d}", f"r{i % 17}", i % 3) for i in range(200)]
    videos = spark.createDataFrame(rows, "path string, runner_id string, label int")
    out = S.split_videos(videos, SplitConfig(remap={2: 0}))
    assert out.count() == 200 and out.groupBy("runner_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    tie = spark.createDataFrame([("a", "r", 0), ("b", "r", 0), ("c", "r", 2), ("d", "r", 2), ("e", "r", 1), ("f", "r", 1), ("g", "r", 1)], videos.schema)
    assert S.dominant_labels(tie, {2: 0}).first().label == 1
    assert S.dominant_labels(spark.createDataFrame([("b", "r", 1), ("a", "r", 2), ("c", "r", 2), ("d", "r", 1)], videos.schema)).first().label == 2
    # labels in the order in which the sorted runners first show them, one generator over all: b comes first here, though its label is the larger
    people = [("d", 1), ("a", 2), ("c", 1), ("b", 2), ("e", 2), ("f", 1), ("g", 2), ("h", 1)]
    rng = random.Random(42)
    two, one = ["a", "b", "e", "g"], ["c", "d", "f", "h"]
    rng.shuffle(two)
    rng.shuffle(one)
    frame = spark.createDataFrame(people, "runner_id string, label int")
    exact = {r.runner_id: r.split for r in S.exact_split(frame, SplitConfig(seed=42)).collect()}
    assert exact == {r: p for g in (two, one) for r, p in zip(g, ["train", "train", "val", "test"])}
    every = sorted(p for p, _ in people)
    random.Random(42).shuffle(every)
    simple = {r.runner_id: r.split for r in S.exact_split(frame, SplitConfig(seed=42), stratified=False).collect()}
    assert simple == dict(zip(every, ["train"] * 5 + ["val"] + ["test"] * 2))
    with pytest.raises(ValueError):
        S.require_some(videos.limit(0))
    with pytest.raises(ValueError):
        SplitConfig(train=0.9, val=0.2)


def test_exact_draws(spark):
    c = AugmentConfig(versions=5)
    got = A.params_exact(A.versions(spark.createDataFrame([("lap_1",), ("x",)], "stem string"), 5), c).collect()
    for r in got:
        rng = random.Random(int(hashlib.md5(f"{r.stem}_{r.version}".encode()).hexdigest()[:8], 16))
        assert r.flip == (rng.random() < 0.7)
        assert (r.brightness is None) == (rng.random() >= 0.8)
        if r.brightness is not None:
            assert (r.brightness, r.contrast) == (rng.uniform(-0.25, 0.25), rng.uniform(-0.25, 0.25))
        assert (r.blur_sigma is None) == (rng.random() >= 0.6)
    assert spark.range(1).select(A.seed(F.lit("lap_1"), F.lit(3))).first()[0] == 3025349199


def test_presets():
    assert len(config.PRESET_NAMES) == 30 and config.preset_config("baseline").versions == 1 and config.preset_config("bc_only").probability["brightness_contrast"] == 0.8
    assert config.preset_kinds("flip_bc_blur") == ["flip", "brightness_contrast", "blur"]
    with pytest.warns(UserWarning):
        assert config.selective(["FLIP", "unknown"]).probability == {k: 0.7 if k == "flip" else 0.0 for k in config.STANDARD}


def test_presets_of_videos(spark):
    c = AugmentConfig(versions=3)
    work = spark.createDataFrame([(v, p, 1.0) for v in ("a_1", "b_2", "c_3") for p in ("baseline", "bc_cutout", "all_augmentations", "unknown", None)], "stem string, preset string, flip_rate double")
    got = {(r.stem, r.preset, r.version): r for r in A.preset_params(work, c).collect()}
    assert {k[1:] for k in got} == {("baseline", 1), *((p, v) for p in ("bc_cutout", "all_augmentations") for v in (1, 2, 3))}
    plain = {(r.stem, r.version): r for r in A.params_native(A.versions(work.select("stem").distinct(), 3), c).collect()}
    kinds = {"brightness_contrast": ("brightness", "contrast"), "blur": ("blur_sigma",), "rotation": ("rotation",), "scale": ("scale",), "cutout": ("cutout_top", "cutout_left")}
    for (video, name, version), r in got.items():
        on, like = config.preset_kinds(name), plain[video, version]
        assert r.flip == (like.flip and "flip" in on)
        assert all(r[p] == (like[p] if k in on else None) for k, ps in kinds.items() for p in ps)
    names = ["baseline", "bc_cutout", "all_augmentations"]
    for r in A.suite(work.select("stem").distinct(), 3, names).collect():
        mine = [x for (_, name, _), x in got.items() if name == r.name]
        shown = [{k: any(x[p] is not None for p in ps) for k, ps in kinds.items()} | {"flip": x.flip} for x in mine]
        assert (r.place, r.versions, r.made, r.plain) == (names.index(r.name), 1 if r.name == "baseline" else 3, len(mine), sum(not any(s.values()) for s in shown))
        assert all(r[k] == sum(s[k] for s in shown) for k in config.STANDARD)
    assert A.suite(work.limit(0), 3).collect() == []


def test_missing_versions_raise_if_all_are_needed(spark):
    videos = spark.createDataFrame([("a_1",)], "stem string")
    mapped = A.mapped(videos, spark.createDataFrame([("a_v001_1.mp4",)], "name string"), 2)
    assert A.coverage(mapped).first()[:] == (2, 1, 50.0, 1)
    with pytest.raises(Exception, match="missing version"):
        A.require_whole(mapped).collect()
    assert A.coverage(mapped.limit(0)).first()[:] == (0, 0, 0.0, 0)


def test_predictions(spark):
    clips = spark.createDataFrame([(1, [0.1, 0.9]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "track int, probability_vector array<double>")
    a, b = P.mean_probability(clips, "track").orderBy("track").collect()
    assert a.predicted_idx == 1 and abs(a.confidence - 70) < 1e-9 and b.predicted_idx == 0
    counts = spark.createDataFrame([(t,) for t, n in ((1, 3), (2, 5), (7, 5)) for _ in range(n)], "track int")
    assert P.primary_track(counts, "track").first()[:] == (2, 5)
    names = F.create_map(F.lit(1), F.lit("one"))
    assert P.report(clips, "track", names).first().predicted_label == "one"
    assert P.report(clips.withColumn("probability_vector", F.lit(None).cast("array<double>")), "track", names).first().outcome == "all clips failed"
    assert P.report(clips.limit(0), "track", names).first().outcome == "no runners"
    loss = spark.createDataFrame([(1, 0.2, True), (1, 0.2, True), (2, 0.8, False)], "batch int, loss double, hit boolean")
    assert abs(P.accuracy(loss).first().loss - 0.5) < 1e-12 and P.accuracy(loss.limit(0)).first()[:] == (0.0, 0.0)


def test_sampling_of_frames(spark):
    at = lambda n, how: spark.range(1).select(P.sampled_frames(F.lit(n), how)).first()[0]
    assert at(20, "uniform") == [0, 1, 2, 3, 5, 6, 7, 8, 10, 11, 12, 13, 15, 16, 17, 19] and at(20, "centre") == list(range(2, 18)) and at(5, "uniform") == [i % 5 for i in range(16)] and at(16, "centre") == list(range(16))
    wide = spark.range(17, 400).select(F.col("id").cast("int").alias("n"), P.sampled_frames(F.col("id").cast("int")).alias("f")).collect()
    assert all(r.f == np.linspace(0, r.n - 1, 16, dtype=int).tolist() for r in wide)


def test_merging_of_results(spark):
    schema = "experiment_id string, status string, seq int"
    local = spark.createDataFrame([("c", "pending", 1), ("d", "completed", 1), ("e", "failed", 1), ("f", "pending", 1)], schema)
    remote = spark.createDataFrame([("a", "completed", 2), ("b", "failed", 2), ("c", "completed", 2), ("d", "completed", 2), ("e", "pending", 2)], schema)
    assert {(r.experiment_id, r.status, r.seq) for r in X.saved(local, remote).collect()} == {("a", "completed", 2), ("c", "completed", 2), ("d", "completed", 1), ("e", "failed", 1), ("f", "pending", 1)}
    assert {(r.experiment_id, r.seq, r.origin) for r in X.loaded(local, remote).collect()} == {("a", 2, "new"), ("b", 2, "new"), ("c", 2, "updated"), ("d", 2, "updated"), ("e", 2, "updated"), ("f", 1, "current")}
    ids = lambda df: {r.experiment_id for r in df.collect()}
    assert ids(X.eligible(local, remote.where("experiment_id = 'c'"))) == {"d", "e", "f"} and ids(X.eligible(local, remote, local.where("experiment_id = 'c'"), force=True)) == {"c"}


def test_result_documents_byte_for_byte(spark, tmp_path):
    """Rows worked by hand: what isn't known is null in JSON and empty in CSV."""
    kinds = "experiment_id string, augmentations array<string>, augmentation_description string, original_train_count int, augmented_train_count int, train_acc double, val_acc double, test_acc double, best_val_acc double, train_loss double, training_time_seconds double, status string, error_message string, seq int"
    rows = [("x", ["flip", "blur"], "Flip + Blur", 7, 175, 66.666, None, 0.125, 1.005, 0.00005, 12.5, "completed", None, 1), ("a,b", [], 'says "no"', 0, 0, *[None] * 6, "failed", "h\u00e9, out", 2)]
    df = spark.createDataFrame(rows, kinds).repartition(2)
    X.write_results(df, str(tmp_path / "r.json"), order="seq")
    result = """    {
      "experiment_id": "%s",
      "augmentations": %s,
      "augmentation_description": "%s",
      "original_train_count": %s,
      "augmented_train_count": %s,
      "versions_per_video": 25,
      "train_acc": %s,
      "val_acc": null,
      "test_acc": %s,
      "train_loss": %s,
      "val_loss": null,
      "test_loss": null,
      "best_val_acc": %s,
      "training_time_seconds": %s,
      "status": "%s",
      "error_message": %s,
      "model_path": null,
      "dataset_path": null
    }"""
    one = result % ("x", '[\n        "flip",\n        "blur"\n      ]', "Flip + Blur", 7, 175, 66.666, 0.125, "5e-05", 1.005, 12.5, "completed", "null")
    two = result % ("a,b", "[]", 'says \\"no\\"', 0, 0, *["null"] * 5, "failed", '"h\\u00e9, out"')
    tail = """{
    "total_experiments": 2,
    "completed": 1,
    "pending": 0,
    "failed": 1
  }"""
    assert (tmp_path / "r.json").read_text() == f'{{\n  "results": [\n{one},\n{two}\n  ],\n  "summary": {tail}\n}}'
    X.write_csv(df, str(tmp_path / "r.csv"), order="seq")
    head = "experiment_id,augmentations,original_samples,augmented_samples,versions_per_video,train_acc,val_acc,test_acc,best_val_acc,train_loss,val_loss,test_loss,training_time_s,status"
    # without the column of versions its field is empty; halves go to the even digit, 1.005 is a little less than it says
    assert (tmp_path / "r.csv").read_bytes().decode() == f'{head}\r\nx,flip+blur,7,175,,66.67,,0.12,1.00,0.0001,,,12,completed\r\n"a,b",none,0,0,,,,,,,,,,failed\r\n'
    back = X.read_results(df, str(tmp_path / "r.json"))
    assert back.columns == df.columns[:-1] and sorted(back.collect(), key=str) == sorted(df.drop("seq").collect(), key=str)
    # a document that another program wrote, with fields that this one doesn't know
    (tmp_path / "o.json").write_text(json.dumps({"results": [{"experiment_id": "r", "status": "completed", "val_acc": 70.0, "new": 1}, {"experiment_id": "x", "status": "completed", "val_acc": 1.0}], "summary": {}}, indent=2))
    few = df.select("experiment_id", "status", "val_acc")
    kept = {r.experiment_id: r.val_acc for r in X.saved(few, X.read_results(few, str(tmp_path / "o.json"))).collect()}
    assert kept == {"x": None, "a,b": None, "r": 70.0}
    assert X.status_summary(X.read_results(few, str(tmp_path / "o.json"))).first().completed == 2


def test_inference_reports(spark):
    """All fields, null where there is nothing to say, and a clip a clip of the primary track that could be read."""
    rows = [(1, "b_clip_002.mp4", [0.25, 0.75]), (1, "a_clip_001.mp4", [0.5, 0.5]), (1, "c.mp4", None), (2, "d.mp4", [1.0, 0.0])]
    clips = spark.createDataFrame(rows, "track int, name string, probability_vector array<double>")
    names = F.create_map(F.lit(0), F.lit("zero"), F.lit(1), F.lit("one"))
    done = clips.withColumn("predicted_label", P.label_of(F.array_position("probability_vector", F.array_max("probability_vector")).cast("int") - 1, names)).withColumn("confidence", F.array_max("probability_vector") * 100)
    report = P.full_report(done, "track", names, "name", "v.mp4", "m")
    assert json.loads(P.report_document(report).first().json) == {
        "video": "v.mp4", "model_dir": "m", "total_runners_detected": 2, "primary_track_id": 1, "primary_track_selection_reason": "most_clips", "num_clips": 2, "predicted_label": "one", "confidence": 62.5,
        "mean_probabilities": {"zero": 37.5, "one": 62.5},
        "per_clip": [{"clip": "a_clip_001.mp4", "predicted_label": "zero", "confidence": 50.0, "probabilities": {"zero": 50.0, "one": 50.0}}, {"clip": "b_clip_002.mp4", "predicted_label": "one", "confidence": 75.0, "probabilities": {"zero": 25.0, "one": 75.0}}],
    }
    none = dict.fromkeys(("primary_track_id", "primary_track_selection_reason", "predicted_label", "confidence", "mean_probabilities"))
    assert json.loads(P.report_document(P.full_report(done.limit(0), "track", names, "name", "v.mp4", "m")).first().json) == {"video": "v.mp4", "model_dir": "m", "total_runners_detected": 0, "num_clips": 0, "per_clip": []} | none
    failed = P.full_report(done.withColumn("probability_vector", F.lit(None).cast("array<double>")), "track", names, "name", "v.mp4", "m")
    assert json.loads(P.report_document(failed).first().json) == {"video": "v.mp4", "model_dir": "m", "total_runners_detected": 2, "num_clips": 0, "per_clip": []} | none | {"primary_track_id": 1, "primary_track_selection_reason": "most_clips"}


def test_a_log_of_runs_loses_nothing(spark, tmp_path):
    """Writers and compactions at once; the state is that of a plain loop over all events."""
    from concurrent.futures import ThreadPoolExecutor

    from motionframe.streaming import runlog

    log, rng = str(tmp_path / "log"), random.Random(3)
    kinds = "experiment_id string, op string, at timestamp, seq bigint, status string, val_acc double"
    import datetime

    day = lambda k: datetime.datetime(2025, 1, 1, tzinfo=datetime.UTC) + datetime.timedelta(days=k)
    every = {f"w{w}-{b}": [(f"e{rng.randrange(12)}", "reset" if rng.random() < 0.15 else "put", day(rng.randrange(5)), 100 * b + k, rng.choice(["completed", "failed", "augmented", None]), float(rng.randrange(99))) for k in range(15)] for w in range(3) for b in range(3)}
    assert runlog.results(spark, log).count() == 0 and runlog.compact(spark, log) is None

    def work(name):
        runlog.append(spark.createDataFrame(every[name], kinds), log, name[:2])
        if name.endswith("1"):
            runlog.compact(spark, log)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(work, every))
    state = {}
    flat = sorted(((e[2], w[:2], e[3], e) for w, rows in every.items() for e in rows), key=lambda x: x[:3])
    for x in flat:
        e = x[3]
        if e[1] == "reset":
            state.pop(e[0], None)
        elif e[0] not in state or state[e[0]][4] != "completed" or e[4] == "completed":
            state[e[0]] = e
    got = lambda: {r.experiment_id: (r.status, r.val_acc) for r in runlog.results(spark, log).collect()}
    want = {k: (e[4], e[5]) for k, e in state.items()}
    assert got() == want
    runlog.compact(spark, log)
    assert len(runlog.batches(spark, log)[0]) == 1 and got() == want
    assert runlog.vacuum(spark, log) >= 9 and got() == want and runlog.vacuum(spark, log) == 0
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "experiment_id string")
    runlog.append(ids("a", "b"), log, "w0", kind="trained")
    runlog.append(ids("b"), log, "w1", kind="trained", op="reset")
    runlog.append(ids("c"), log, "w1", kind="augmented")
    assert {r[0] for r in runlog.members(spark, log, "trained").collect()} == {"a"} and {r[0] for r in runlog.members(spark, log, "augmented").collect()} == {"c"} and got() == want
    # an append that dies before its folder is renamed is not there
    (tmp_path / "log" / "_events-dead").mkdir()
    assert got() == want


def test_files(spark, tmp_path):
    for n in ("deep/a_lap_1_001.mp4", "b_lap_2_???.mp4", "b_lap_2_01.mp4", "x_ID_3_clip_002.mp4", "m_label_4_.mp4", "c.MP4"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"x")
    root = str(tmp_path)
    assert {r.name for r in files.labelled_videos(spark, root).collect()} == {"a_lap_1_001.mp4", "b_lap_2_???.mp4"}
    assert files.listing(spark, root).count() == 4 and files.listing(spark, root + "/none").count() == 0
    assert files.clips_by_track(spark, root).first()[2:] == (3, 2) and files.memorised(spark, root).first().label == 4
    with pytest.raises(ValueError):
        files.memorised(spark, root + "/deep")
    rows = [(str(tmp_path / "m_label_4_.mp4"), 1, 0, None, (0.0, 5.0), 0.5, 9.0, 0)]
    got = files.without_unseen(files.decoded(spark, root, lambda path, content: iter([dict(zip([f.split()[0] for f in files.DETECTIONS.replace("struct<x:double,y:double>", "s").split(", ")], r)) | {"right_ankle": {"x": 0.0, "y": 5.0}} for r in rows])))
    assert got.count() == 5 and got.where("right_ankle is null").count() == 5


def test_split_documents(spark, tmp_path):
    rows = [("b", "r1", 0, "train"), ("a", "r1", 1, "train"), ("c", "r2", 0, "val")]
    split = spark.createDataFrame(rows, "path string, runner_id string, label int, split string")
    files.write_split(split, str(tmp_path / "s"))
    doc = json.loads((tmp_path / "s").read_text())
    assert doc["train"] == ["a", "b"] and doc["metadata"]["train_label_counts"] == {"0": 1, "1": 1} and doc["metadata"]["total_test"] == 0 and doc["metadata"]["test_label_counts"] == {}
    assert {(r.split, r.place, r.path) for r in files.read_split(spark, str(tmp_path / "s")).collect()} == {("train", 0, "a"), ("train", 1, "b"), ("val", 0, "c")}
    (tmp_path / "lacks.json").write_text('{"train": ["a"]}')
    assert files.read_split(spark, str(tmp_path / "lacks.json")).count() == 1
    with pytest.raises(KeyError):
        files.read_split(spark, str(tmp_path / "lacks.json"), strict=True)
    (tmp_path / "whole.json").write_text('{"train": ["x/a_007.mp4", "x/b_002.mp4", "x/c_009.mp4"], "val": ["x/d_009.mp4"], "test": []}')
    got = {r.path[2]: tuple(r)[3:] for r in S.load_split(spark, str(tmp_path / "whole.json"), {9: 2}).collect()}
    assert got == {"a": (7, 1, True), "b": (2, 0, True), "c": (2, 0, True), "d": (2, 0, False)}
    assert not S.load_split(spark, str(tmp_path / "whole.json"), augment=False).where("augmented").count()


def test_work_goes_on_where_it_stopped(spark, tmp_path):
    todo, done = str(tmp_path / "todo"), str(tmp_path / "done")
    spark.createDataFrame([("a",), ("bad",)], "path string").coalesce(1).write.parquet(todo)
    seen = []

    def work(items):
        seen.append(sorted(r.path for r in items.collect()))
        return items.where("path <> 'bad'")

    for n in range(2):
        files_ = spark.readStream.schema("path string").parquet(todo)
        resume.follow(files_, done, str(tmp_path / f"progress{n}"), work).awaitTermination()
    assert seen == [["a", "bad"], ["bad"]] and {r.path for r in resume.completed(spark, done).collect()} == {"a"}


def test_documents_of_augmented_and_experiment_splits(spark):
    split = spark.createDataFrame([("train", 0, "in/b_001.mp4"), ("train", 1, "in/a_001.mp4"), ("train", 2, "in/c_001.mp4"), ("val", 0, "in/z_001.mp4"), ("val", 1, "in/y_001.mp4")], "split string, place int, path string")
    names = ["b_v002_001.mp4", "b_v001_001.mp4", "a_v001_001.mp4", "other_v001_001.mp4"]
    made = spark.createDataFrame([(n,) for n in names], "name string")
    doc = json.loads(A.experiment_document(split, made, "x", "base.json").first().json)
    assert doc == {"train": ["b_v001_001.mp4", "b_v002_001.mp4", "a_v001_001.mp4"], "val": ["in/z_001.mp4", "in/y_001.mp4"], "test": [],
                   "metadata": {"experiment_id": "x", "original_train_count": 3, "augmented_train_count": 3, "missing_train_count": 1, "base_split": "base.json"}}
    about = spark.range(1).select(F.lit(7).alias("total_train"))
    doc = json.loads(A.augmented_document(split, made, 2, "gs://b/raw/", "gs://b/made/", "s.json", "b", about).first().json)
    assert doc["train"] == [f"gs://b/made/{n}" for n in sorted(names[:3])] and doc["val"] == ["gs://b/raw/y_001.mp4", "gs://b/raw/z_001.mp4"]
    assert doc["metadata"] == {"source_split": "s.json", "gcs_bucket": "b", "versions_per_video": 2, "original_train_count": 3, "augmented_train_count": 3, "val_count": 2, "test_count": 0, "original_metadata": {"total_train": 7}}


def test_videos_that_fail_are_rows(spark, tmp_path):
    for n in ("a.mp4", "b.mp4"):
        (tmp_path / n).write_bytes(n.encode())

    def work(path, content):
        if content == b"b.mp4":
            raise OSError("no frames")
        return 3

    got = {r.path.rsplit("/", 1)[-1]: tuple(r)[1:] for r in files.attempted(spark, str(tmp_path), work).collect()}
    assert got == {"a.mp4": (3, True, None), "b.mp4": (0, False, "no frames")}
    where = str(tmp_path / "text")
    assert files.get_text(spark, where) is None
    files.put_text(spark, where, "one\ntwo")
    assert files.get_text(spark, where) == "one\ntwo"


def test_ranks_and_phases(spark):
    rows = spark.createDataFrame([("a", "completed", 50.0, 1), ("b", "completed", None, 2), ("c", "pending", 70.0, 3), ("d", "completed", 50.0, 4), ("e", "completed", 99.5, 5)], "experiment_id string, status string, val_acc double, seq int")
    assert [r.experiment_id for r in X.ranked(rows).orderBy("rank").collect()] == ["e", "a", "d", "b"]
    outcomes = spark.createDataFrame([("a", None, 60.0), ("c", "out of memory", None), ("x", None, 1.0)], "experiment_id string, error_message string, val_acc double")
    got = {r.experiment_id: (r.status, r.val_acc) for r in X.after_phase(rows, outcomes).collect()}
    assert got == {"a": ("completed", 60.0), "b": ("completed", None), "c": ("failed", 70.0), "d": ("completed", 50.0), "e": ("completed", 99.5)}
    made = spark.createDataFrame([("c", None, "d/c"), ("d", "disk", None)], "experiment_id string, error_message string, dataset_path string")
    wide = rows.withColumn("dataset_path", F.lit(None).cast("string")).withColumn("error_message", F.lit(None).cast("string"))
    told = {r.experiment_id: (r.status, r.dataset_path, r.error_message) for r in X.after_phase(wide, made, X.AUGMENTING).collect()}
    assert told["c"] == ("augmented", "d/c", None) and told["d"] == ("failed", None, "disk") and told["a"] == ("completed", None, None)
    assert {r[0] for r in X.remaining(rows, rows.where("seq < 3")).collect()} == {"c", "d", "e"}
    report = spark.createDataFrame([(2, "x", 0.5)], "tracks int, predicted_label string, confidence double")
    assert json.loads(P.report_document(report, video="v.mp4").first().json) == {"video": "v.mp4", "tracks": 2, "predicted_label": "x", "confidence": 0.5}


def test_kernels(spark):
    x = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    assert (N.grayscale(np.full((2, 2, 3), 77, np.uint8)) == 77).all() and (N.flip(N.flip(x)) == x).all()
    # contrast 1 + c, brightness 1 + b: c * (x - 128) + 128 + (b - 1) * 255
    assert N.brightness_contrast(np.full((1, 1, 3), 100, np.uint8), 0.1, -0.5)[0, 0, 0] == int(0.5 * (100 - 128) + 128 + 0.1 * 255)
    assert (N.brightness_contrast(x, 0.0, 0.0) == x).all()
    assert (N.blur(np.full((6, 6, 3), 9, np.uint8), 0.8) == 9).all() and len(N.gaussian_weights(0.1)) == 3
    cut = N.cutout(np.zeros((20, 20, 3), np.uint8), 0.1, 0.2, 0.15)
    # the side is int(20 * sqrt(0.15)) = 7, the place int(0.1 * 13) = 1, int(0.2 * 13) = 2
    assert cut[1:8, 2:9].min() == 128 and cut.sum() == 128 * 7 * 7 * 3
    crop = N.padded_crop(x, -1, -1, 2, 3)
    assert crop.shape == (4, 3, 3) and crop[0].sum() == 0 and (crop[1:, 1:] == x[:3, :2]).all() and N.padded_crop(x, 9, 9, 12, 12).sum() == 0
    assert N.normalised(np.zeros((2, 4, 4, 3), np.uint8)).shape == (2, 3, 4, 4)
    row = dict(flip=True, brightness=0.1, contrast=-0.2, blur_sigma=0.5, rotation=None, scale=None, cutout_top=0.5, cutout_left=0.0)
    made = N.augmented(x, row, 0.15)
    assert (made == N.cutout(N.blur(N.brightness_contrast(N.flip(N.grayscale(x)), 0.1, -0.2), 0.5), 0.5, 0.0, 0.15)).all()
    none = dict.fromkeys(row) | {"flip": False}
    assert (N.augmented(x, none, 0.15) == N.grayscale(x)).all() and (N.augmented(x, none | {"scale": 0.9}, 0.15, rescale=lambda f, s: f // 2) == N.grayscale(x) // 2).all()
    with pytest.raises(ValueError):
        N.augmented(x, none | {"rotation": 3.0}, 0.15)
    assert (N.resized(x, 4, 4) == x).all() and (N.resized(np.full((3, 5, 3), 9, np.uint8), 8, 2) == 9).all()
    wide = N.resized(np.array([[[0], [100]]], np.uint8), 1, 4)[0, :, 0].tolist()
    assert wide == [0, 25, 75, 100]  # centres at -0.25, 0.25, 0.75 and 1.25, the edge repeated
    assert N.item([x, x], side=8).shape == (2, 3, 8, 8) and (N.item(None) == 0).all() and N.item([]).shape == (16, 3, 224, 224)
    assert N.blur(x[:1, :2], 1.0).shape == (1, 2, 3)
    frames = spark.createDataFrame([(1, 4, 4, 3, x.tobytes()), (2, 4, 4, 3, None), (3, 4, 4, 3, b"x")], "id int, height int, width int, channels int, pixels binary")
    got = {r.id: r.pixels for r in N.on_frames(frames, N.flip).collect()}
    assert bytes(got[1]) == np.ascontiguousarray(N.flip(x)).tobytes() and got[2] is None and got[3] is None


def test_entry_module_without_the_optional_parts(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "motionframe"), tmp_path / "motionframe", ignore=shutil.ignore_patterns("llm"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, timeout=100)
    assert said.returncode == 0, said.stderr
    assert int(said.stdout.split()[0]) >= 70
