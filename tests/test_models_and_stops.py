"""A toy model behind the prediction, batches of clips, and runs that are stopped and go on."""

import json
import os
import signal
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionframe.functions import kernels as N
from motionframe.operators import infer
from motionframe.operators import predict as P
from motionframe.streaming import resume

CLIPS = "clip string, place int, path string, label int, frames int, height int, width int, channels int, pixels binary"


def clips(n=23, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        frames = int(rng.integers(1, 40))
        x = rng.integers(0, 256, (frames, 6, 8, 3), np.uint8)
        rows.append((f"v_ID_{k % 3}_clip_{k:03d}.mp4", k, f"/in/{k}/v_{k:03d}.mp4", k % 4, frames, 6, 8, 3, x.tobytes()))
    return rows


def of(row, length=16, side=4):
    x = np.frombuffer(row[8], np.uint8).reshape(row[4], 6, 8, 3)
    at = np.linspace(0, len(x) - 1, length, dtype=int) if len(x) >= length else [i % len(x) for i in range(length)]
    return N.normalised(np.stack([N.resized(x[i], side, side) for i in at]))


def weights():
    return np.random.default_rng(9).normal(size=(16 * 3 * 4 * 4, 3))


def test_a_model_is_loaded_once_a_worker(spark, tmp_path):
    loads, calls = tmp_path / "loads", tmp_path / "calls"
    loads.mkdir()
    calls.mkdir()
    where, calls_ = str(loads), str(calls)

    def load():
        open(f"{where}/{os.getpid()}-{time.time_ns()}", "w").close()
        w = np.random.default_rng(9).normal(size=(16 * 3 * 4 * 4, 3))

        def model(x):
            open(f"{calls_}/{len(x)}-{os.getpid()}-{time.time_ns()}", "w").close()
            return x.reshape(len(x), -1).astype(np.float64) @ w

        return model

    rows = clips()
    bad = [("none", 100, "p", 0, 2, 6, 8, 3, None), ("short", 101, "p", 0, 2, 6, 8, 3, b"x"), ("shapeless", 102, "p", 0, None, 6, 8, 3, b"x")]
    df = spark.createDataFrame(rows + bad, CLIPS).repartition(6)
    names = F.create_map(F.lit(0), F.lit("zero"), F.lit(2), F.lit("two"))
    got = {r.clip: r for r in infer.predict_clips(df, load, names, side=4, batch=2).collect()}
    assert got.keys() == {r[0] for r in rows + bad} and "pixels" not in got[rows[0][0]].__fields__
    for row in rows:
        x = of(row).reshape(-1).astype(np.float64) @ weights()
        p = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
        r = got[row[0]]
        assert np.allclose(r.probability_vector, p) and r.predicted_idx == int(p.argmax()) and abs(r.confidence - 100 * p.max()) < 1e-6
        assert r.probabilities.keys() == {"zero", "1", "two"} and abs(r.probabilities["two"] - 100 * p[2]) < 1e-6 and r.predicted_label == ["zero", "1", "two"][r.predicted_idx]
    assert all(got[b[0]].probability_vector is None and got[b[0]].probabilities is None for b in bad)
    workers = {f.split("-")[0] for f in os.listdir(loads)}
    assert len(os.listdir(loads)) == len(workers) and len(os.listdir(calls)) >= 13 and all(f.startswith(("1-", "2-")) for f in os.listdir(calls))
    # on to the report, over tracks by name
    done = spark.createDataFrame([(k, *r[:1]) for k, r in enumerate(rows)], "k int, clip string").join(infer.predict_clips(df, load, names, side=4), "clip").withColumn("track", F.regexp_extract("clip", r"_ID_(\d+)_", 1).cast("int"))
    doc = json.loads(P.report_document(P.full_report(done, "track", names, "clip", "v.mp4", "m")).first().json)
    assert doc["primary_track_id"] == 0 and doc["num_clips"] == 8 == len(doc["per_clip"]) and set(doc["per_clip"][0]["probabilities"]) == {"zero", "1", "two"}


def test_batches_have_the_numbers_of_a_loader(spark):
    rows = clips()
    broken = (*rows[5][:8], b"no pixels")
    df = spark.createDataFrame([r for r in rows if r[1] != 5] + [broken], CLIPS).repartition(5)
    got = {r.batch: r for r in infer.training_batches(df, size=4, side=4).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 5] and [got[k].n for k in range(6)] == [4] * 5 + [3]
    for k, r in got.items():
        mine = rows[4 * k : 4 * k + 4]
        assert r.labels == [x[3] for x in mine] and r.filenames == [os.path.basename(x[2]) for x in mine]
        x = np.frombuffer(r.pixel_values, "<f4").reshape(r.n, 16, 3, 4, 4)
        for i, row in enumerate(mine):
            assert (x[i] == (0 if row[1] == 5 else of(row))).all()
    assert infer.training_batches(df.limit(0)).count() == 0
    # what the loss of a run is made from: the mean of the means of batches, the short one included
    loss = df.select(F.floor(F.col("place") / 4).alias("batch"), F.col("place").cast("double").alias("loss"), (F.col("label") == 0).alias("hit"))
    want = np.mean([np.mean(range(4 * k, min(4 * k + 4, 23))) for k in range(6)])
    assert abs(P.accuracy(loss).first().loss - want) < 1e-12


@pytest.fixture
def todo(spark):
    return spark.createDataFrame([(f"v{k:02d}",) for k in range(20)], "path string")


def test_a_stopped_run_goes_on(spark, tmp_path, todo):
    """Asked to stop amid its work, a run finishes what it has begun, and the next does the rest and nothing twice."""
    did, checkpoint, flag = str(tmp_path / "did"), str(tmp_path / "done"), str(tmp_path / "stop")
    os.mkdir(did)

    def work(path):
        open(f"{did}/{path}-{time.time_ns()}", "w").close()
        time.sleep(0.3)
        if path == "v07" and not os.path.exists(f"{did}/well"):
            raise OSError("unreadable")
        return 2

    begun = lambda: [f.split("-")[0] for f in os.listdir(did) if f.startswith("v")]

    def ask():
        while len(begun()) < 5:
            time.sleep(0.02)
        resume.stop(spark, flag)

    asker = threading.Thread(target=ask)
    asker.start()
    first = resume.process(todo, checkpoint, work, flag, tasks=4).first()
    asker.join()
    some = begun()
    assert 5 <= len(some) < 20 and first.processed + first.failed == len(some) == len(set(some))
    open(f"{did}/well", "w").close()
    second = resume.process(todo, checkpoint, work, flag, tasks=4).first()
    assert first.processed + second.processed == 20 and second.failed == 0 and first.clips + second.clips == 40
    assert sorted(begun()) == sorted([f"v{k:02d}" for k in range(20)] + (["v07"] if first.failed else []))
    third = resume.process(todo, checkpoint, work, flag).first()
    assert (third.clips, third.processed, third.failed) == (0, 0, 0) and resume.outcomes(spark, checkpoint).where("success").count() == 20


def test_signals_stop_gently_and_then_at_once(spark, tmp_path, todo):
    flag, checkpoint = str(tmp_path / "stop"), str(tmp_path / "done")
    before = signal.getsignal(signal.SIGINT)
    with resume.on_signals(spark, flag) as tag:
        assert tag in spark.getTags()
        os.kill(os.getpid(), signal.SIGINT)
        time.sleep(0.1)
        assert os.path.exists(flag)

        def twice():
            time.sleep(4)
            os.kill(os.getpid(), signal.SIGTERM)

        killer = threading.Thread(target=twice)
        killer.start()
        with pytest.raises(Exception):
            resume.process(todo, checkpoint, lambda p: time.sleep(60) or 1, flag, tasks=2)
        killer.join()
    assert signal.getsignal(signal.SIGINT) is before and tag not in spark.getTags()
    assert resume.process(todo, checkpoint, lambda p: 1, flag).first().processed == 20  # what was cut off is done now
