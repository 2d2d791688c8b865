"""Containers made here byte by byte: their properties, the format that reads detections, and the one that writes clips."""

import os
import struct

import pytest
from pyspark.sql import functions as F

from motionframe.operators import tracks
from motionframe.sources import containers, formats
from motionframe.sources.remote import Ranges, below


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


FLAT = (0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
ON_ITS_SIDE = (0, 0x10000, 0, -0x10000, 0, 0, 0, 0, 0x40000000)


def track(kind, number, scale, runs, width, height, matrix=FLAT, long=False):
    frames, length = sum(n for n, _ in runs), sum(n * d for n, d in runs)
    times = struct.pack(">QQ", 0, 0) if long else struct.pack(">II", 0, 0)
    one = struct.pack(">I", long << 24)
    tkhd = box(b"tkhd", one, times, struct.pack(">II", number, 0), struct.pack(">Q" if long else ">I", length), bytes(8), struct.pack(">HHHH", 0, 0, 0, 0), struct.pack(">9i", *matrix), struct.pack(">II", width << 16, height << 16))
    mdhd = box(b"mdhd", one, times, struct.pack(">I", scale), struct.pack(">Q" if long else ">I", length), struct.pack(">HH", 0, 0))
    hdlr = box(b"hdlr", bytes(8), kind, bytes(12), b"x\0")
    entry = box(b"avc1", bytes(24), struct.pack(">HH", width, height), bytes(50))
    stsd = box(b"stsd", struct.pack(">II", 0, 1), entry)
    stts = box(b"stts", struct.pack(">II", 0, len(runs)), *(struct.pack(">II", n, d) for n, d in runs))
    stsz = box(b"stsz", struct.pack(">III", 0, 10, frames))
    return box(b"trak", tkhd, box(b"mdia", mdhd, hdlr, box(b"minf", box(b"stbl", stsd, stts, stsz))))


def movie(*tracks_, data=b"", late=False, more=b""):
    head, media = box(b"moov", box(b"mvhd", bytes(100)), *tracks_, more), box(b"mdat", data)
    return box(b"ftyp", b"isom", bytes(4)) + (media + head if late else head + media)


def read(data):
    return containers.properties(lambda at, n: data[at : at + n], len(data))


def test_properties_of_generated_files():
    sound = track(b"soun", 1, 48000, [(1000, 1024)], 0, 0)
    assert read(movie(sound, track(b"vide", 2, 600, [(300, 10)], 1920, 1080))) == (60.0, 300, 1920, 1080)
    assert read(movie(track(b"vide", 1, 30000, [(10, 1001)], 640, 360, long=True), late=True)) == (30000 / 1001, 10, 640, 360)
    # of uneven frames the rate is that of all: 4 in 1 + 3 seconds
    assert read(movie(track(b"vide", 1, 10, [(1, 10), (3, 10)], 64, 32))).fps == 1.0
    assert read(movie(track(b"vide", 1, 600, [(5, 20)], 1920, 1080, ON_ITS_SIDE))) == (30.0, 5, 1080, 1920)
    assert read(movie(track(b"vide", 1, 600, [], 8, 8))) == (0.0, 0, 8, 8)
    # more runs than one piece holds
    assert read(movie(track(b"vide", 1, 20_000, [(1, 1000), (1, 3000)] * 10_000, 8, 8))) == (10.0, 20_000, 8, 8)
    # a box of 64 bits, and one up to the end of the file
    whole = movie(track(b"vide", 1, 600, [(6, 20)], 16, 8))
    wide = struct.pack(">I4sQ", 1, b"free", 16 + 5) + b"hello"
    assert read(wide + whole) == read(whole) == read(whole + struct.pack(">I4s", 0, b"free") + b"rest") == (30.0, 6, 16, 8)


def test_fragments():
    trex = box(b"mvex", box(b"trex", struct.pack(">IIIIII", 0, 1, 1, 20, 0, 0)))
    head = movie(track(b"vide", 1, 600, [], 32, 16), more=trex)
    whose = lambda n, flags=0, rest=b"": box(b"tfhd", struct.pack(">II", flags, n), rest)
    usual = box(b"moof", box(b"traf", whose(1), box(b"trun", struct.pack(">II", 0, 7))))
    own = box(b"moof", box(b"traf", whose(1, 8, struct.pack(">I", 40)), box(b"trun", struct.pack(">II", 0, 2))), box(b"traf", whose(9), box(b"trun", struct.pack(">II", 0, 99))))
    each = box(b"moof", box(b"traf", whose(1), box(b"trun", struct.pack(">IIi", 0x301, 2, 0), struct.pack(">IIII", 10, 5, 30, 5))))
    assert read(head + usual + own + each) == (11 * 600 / (7 * 20 + 2 * 40 + 40), 11, 32, 16)


@pytest.mark.parametrize("broken", [b"", b"\0\0\0\x08free", b"not a container at all", movie(track(b"soun", 1, 9, [(1, 1)], 0, 0)), movie(track(b"vide", 1, 600, [(6, 20)], 16, 8))[:-60], box(b"moov", box(b"trak", box(b"mdia", box(b"hdlr", bytes(8), b"vide", bytes(12)))))])
def test_what_is_no_video_is_an_error(broken):
    with pytest.raises((ValueError, struct.error)):
        read(broken)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep").mkdir()
    made = {"a_ü 1.mp4": (600, [(30, 10)]), "deep/b.mp4": (600, [(25, 20)]), "c.mp4": (600, [])}
    for name, (scale, runs) in made.items():
        (tmp_path / name).write_bytes(movie(track(b"vide", 1, scale, runs, 1280, 720), data=bytes(3_000_000)))
    (tmp_path / "d.txt").write_bytes(b"x")
    return tmp_path


def test_properties_as_a_table(spark, folder):
    with Ranges(str(folder / "a_ü 1.mp4")) as file:
        assert containers.properties(file, file.size).frames == 30 and file.taken < 2000  # of three million bytes
    paths = spark.createDataFrame([(p,) for p, _ in below(str(folder), ".mp4")] + [("file:" + str(folder / "deep/b.mp4"),)], "path string")
    got = {os.path.basename(r.path): tuple(r)[1:] for r in containers.video_properties(paths).collect()}
    assert got == {"a_ü 1.mp4": (60.0, 30, 1280, 720, None), "b.mp4": (30.0, 25, 1280, 720, None), "c.mp4": (0.0, 0, 1280, 720, None)}
    rates = containers.video_properties(paths.limit(3)).select(containers.usual_fps(F.col("fps")).alias("f"), containers.whole_fps(F.col("fps")).alias("w")).collect()
    assert sorted((r.f, r.w) for r in rates) == [(30.0, 0), (30.0, 30), (60.0, 60)]
    odd = spark.createDataFrame([(str(folder / "d.txt"),), (str(folder / "none.mp4"),), (None,)], "path string")
    assert all(r.error and r.frames is None for r in containers.video_properties(odd, strict=False).collect())
    with pytest.raises(Exception, match="can't be read"):
        containers.video_properties(odd).collect()
    assert containers.video_properties(odd.limit(0)).count() == 0


def test_detections_as_a_format(spark, folder, capsys):
    formats.register(spark)
    read_ = lambda **o: spark.read.format("detections").options(decoder="tests.toy_decoder:decode", **o).load(str(folder))
    df = read_()
    assert df.schema == formats.detections_schema() and df.rdd.getNumPartitions() == 3
    assert {(r.video_id, r.n) for r in df.groupBy("video_id").agg(F.count("*").alias("n")).collect()} == {("a_ü 1.mp4", 30), ("b.mp4", 25)}
    # what the library makes of them
    assert {(r.video_id, r.avg_speed) for r in tracks.motion_stats(df).collect()} == {("a_ü 1.mp4", 1.0), ("b.mp4", 1.0)}
    cut = read_(frames="10")
    assert cut.rdd.getNumPartitions() == 3 + 3 and sorted(r.frame_idx for r in cut.where("video_id = 'b.mp4'").collect()) == list(range(25))
    # a filter on the path leaves files unopened: c.mp4 would fail here
    (folder / "c.mp4").write_bytes(b"broken")
    only = read_().where(F.col("path").endswith("b.mp4"))
    assert only.rdd.getNumPartitions() == 1 and only.count() == 25
    only.explain("formatted")
    assert "EndsWith" in capsys.readouterr().out
    both = read_().where(F.col("path").isin([str(folder / "deep/b.mp4"), str(folder / "x")]) & (F.col("frame_idx") < 3) & F.col("path").contains("deep") & F.col("path").startswith(str(folder)))
    assert both.rdd.getNumPartitions() == 1 and both.count() == 3
    assert read_().where(F.col("path") == "nowhere").count() == 0
    with pytest.raises(Exception, match="reaches beyond|no movie header"):
        read_().count()
    with pytest.raises(Exception, match="decoder"):
        spark.read.format("detections").load(str(folder)).count()


def test_clips_as_a_format(spark, folder, tmp_path):
    formats.register(spark)
    to = tmp_path / "out"
    to.mkdir()
    names = lambda: {p.name: p.stat().st_size for p in to.iterdir()}
    rows = [(str(folder / "a_ü 1.mp4"), "A_lap_1_CUT_001_0.mp4"), ("file:" + str(folder / "deep/b.mp4"), "A_lap_1_CUT_002_0.mp4"), (str(folder / "d.txt"), "é.mp4")]
    write = lambda rows, kinds="source string, name string": spark.createDataFrame(rows, kinds).repartition(3).write.format("clips").mode("append").save(str(to))
    with pytest.raises(Exception, match="none.mp4"):
        write([*rows, (str(folder / "none.mp4"), "x.mp4")])
    assert names() == {}  # a task failed, and nothing is left
    write(rows)
    first = names()
    assert first.keys() == {r[1] for r in rows} and first["é.mp4"] == 1
    assert (to / rows[1][1]).read_bytes() == (folder / "deep/b.mp4").read_bytes()
    write(rows)
    assert names() == first  # a rerun ends the same
    with pytest.raises(Exception, match="more than one clip"):
        write([(rows[0][0], "same.mp4"), (rows[1][0], "same.mp4")])
    for bad in ("../x.mp4", "", None, "_x"):
        with pytest.raises(Exception, match="no name"):
            write([(rows[0][0], bad)])
    assert names() == first
    write([(b"abc", "made.mp4"), (b"", "empty.mp4")], "content binary, name string")
    assert names() == first | {"made.mp4": 3, "empty.mp4": 0}
    write([], "content binary, name string")
    with pytest.raises(Exception, match="either a source or a content"):
        write([(1,)], "name int")
    with pytest.raises(Exception, match="isn't emptied"):
        spark.createDataFrame(rows, "source string, name string").write.format("clips").mode("overwrite").save(str(to))


def test_a_task_that_fails_once_leaves_no_trace(spark, folder, tmp_path):
    """Clips named by the library's own numbering, written by tasks of which one comes twice."""
    formats.register(spark)
    to = tmp_path / "named"
    to.mkdir()
    clips = spark.createDataFrame([("v", f"v_ID_{t}_clip_{k:03d}", str(folder / "deep/b.mp4")) for t in (1, 10, 2) for k in (1, 2)], "video_id string, clip_name string, source string")
    named = tracks.renumbered(clips).select("source", F.format_string("CAM_lap_004_CUT_%03d_001.mp4", "cut").alias("name"))
    named.write.format("clips").mode("append").save(str(to))
    assert sorted(p.name for p in to.iterdir()) == [f"CAM_lap_004_CUT_{k:03d}_001.mp4" for k in range(1, 7)]
