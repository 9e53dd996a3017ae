"""Recordings as files, end to end: discovery, quirks of each format, documents."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.plans import batch, document, registry
from loomspan.plans.config import PIConfig
from loomspan.sources import files

CFG = PIConfig(window_s=2, stride_s=1)


def put(root, path, content):
    p = os.path.join(root, path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("recordings") / "data")
    t0 = 1700000000000
    gaze = "timestamp,x,y\n" + "".join(f"{t0 + 20 * i},{100 + i},{200 + (i // 25) * 150}\n" for i in range(200))
    put(root, "20240101/ann/read/eye-tracking/a1/eye-tracking.csv", gaze)
    put(root, "20240101/bob/read/eye-tracking/a1/eye-tracking.csv", "y,x,timestamp\n5,1,2023-11-14T22:13:20.000Z\n6,2,2023-11-14T22:13:20.660999+00:00\n7,3,2023-11-14T22:13:21Z\n")
    put(root, "20240101/cid/read/eye-tracking/a1/eye-tracking.csv", "timestamp,x\n1,2\n")
    put(root, "20240101/dot/read/eye-tracking/a1/eye-tracking.csv", "timestamp,x,y\n2023-11-14T22:13:20Z,1,1\nsoon,2,2\n")
    put(root, "20240101/eve/read/eye-tracking/a1/eye-tracking.csv", "timestamp,x,y\n1700000000000,1,1\n")
    put(root, "short/eye-tracking/eye-tracking.csv", gaze)
    at = lambda ms: f"2024-01-01T09:00:{ms / 1000:06.3f}+09:00"
    rows = "".join(f"{k},{at(300 * i)},{at(300 * i + 80)},\n" for i, k in enumerate(["a", "SPACE", "ß", "NA", " ", "Control", "z", '","', "7", "가"]))
    put(root, "20240101/ann/type/keyboard/a1/Keyboard.CSV", "letter,downTime,upTime,holdTime\n" + rows)
    events = [("KEY_DOWN", "a", 0), ("KEY_DOWN", "a", 100), ("KEY_UP", "a", 150), ("KEY_UP", "b", 160), ("KEY_UP", "a", 900), ("KEY_DOWN", "c", 950)]
    put(root, "20240101/bob/type/keyboard/a1/keyboard.csv", "letter,key_action,timeStamp\n" + "".join(f"{k},{a},{at(t)}\n" for a, k, t in events))
    put(root, "20240101/cid/type/keyboard/a1/keyboard.csv", "key\nx\n")
    touch = "px,it,py,et\n" + "".join(f"{10 * i},{at(20 * i)},{5 * i},{1 if i == 0 else 3 if i == 29 else 2}\n" for i in range(30))
    put(root, "20240101/ann/draw/stylus/a1/stylus.csv", touch)
    put(root, "20240102/ann/draw/stylus/a0/stylus.csv", touch)
    put(root, "stylus/stylus.csv", touch.replace(",it,", ",timeStamp,"))
    put(root, "20240101/bob/draw/stylus/a1/stylus.csv", "px,py\n1,2\n")
    y = np.sin(2 * np.pi * 200 * np.arange(16000) / 8000) * 0.5
    y[6000:10000] = 0
    put(root, "20240101/ann/talk/voice/a1/voice.wav", files.write_wav(y, 8000))
    put(root, "20240101/bob/talk/voice/a1/voice.wav", b"RIFFnothing")
    return root


def test_paths_and_errors(spark, base):
    r = batch.run(spark, base, "eye-tracking", CFG)
    assert {x.error for x in r.errors.collect()} == {"missing required column", "unreadable timestamp"}
    rows = r.wide.select("client_id", "task", "date", "archive_id", "win").collect()
    assert {(x.client_id, x.task, x.date, x.archive_id) for x in rows} == {("ann", "read", "20240101", "a1"), ("bob", "read", "20240101", "a1"), ("eve", "read", "20240101", "a1")}
    assert [x.win for x in rows if x.client_id == "eve"] == [None]
    only = batch.run(spark, base, "eye-tracking", CFG, clients=["bob"])
    assert {x.client_id for x in only.wide.select("client_id").collect()} == {"bob"}


def test_gaze_times(spark, base):
    samples, _ = files.gaze(files.sessions(spark, base, "eye-tracking", ["bob"]))
    assert [(r.t, r.x, r.y) for r in samples.orderBy("ord").collect()] == [(1700000000000, 1.0, 5.0), (1700000000660, 2.0, 6.0), (1700000001000, 3.0, 7.0)]


def test_keyboard_modes(spark, base):
    presses, errors = files.presses(files.sessions(spark, base, "keyboard"))
    assert [r.error for r in errors.collect()] == ["missing letter"]
    by = {}
    for r in presses.orderBy("down").collect():
        by.setdefault("ann" if "/ann/" in r.sess else "bob", []).append(r)
    assert [r.token for r in by["ann"]] == ["A", "SPACE", "SS" if by["ann"][2].token == "SS" else "ß".upper(), "", "", "CONTROL", "Z", ",", "7", "가"]
    assert all(r.hold == 80.0 and r.offset == 540 for r in by["ann"])
    assert sorted((r.hold, r.token) for r in by["bob"]) == [(50.0, "A"), (900.0, "A")]
    with pytest.raises(ValueError):
        files.presses(files.sessions(spark, base, "keyboard"), "guess")


def test_touch_defaults(spark, base):
    events, errors = files.touches(files.sessions(spark, base, "touch"))
    assert [r.error for r in errors.collect()] == ["missing time column"]
    rows = [r for r in events.collect() if "20240101" in r.sess]
    assert len(rows) == 30 and all(r.p is None and r.pi == 0 and r.ws == 0 for r in rows) and max(r.t for r in rows) == 580_000
    keys = files.path_keys(files.discover(spark, base, "touch"), base, "touch").select("date", "client_id", "task", "archive_id").collect()
    assert ("unknown_date", "unknown_client", "unknown_task", "stylus.csv") in {tuple(k) for k in keys}


def test_documents(spark, base, tmp_path):
    n = batch.run_and_write(spark, base, "touch", CFG, root=str(tmp_path))
    assert n == 2
    doc = json.loads((tmp_path / "ann/draw/touch_pi.json").read_text())
    assert list(doc) == ["client_id", "context", "sensor_modality", "screen", "windows"] and doc["screen"] == {"width": 1440.0, "height": 900.0}
    w = doc["windows"][0]
    assert (w["window_number"], w["start_timestamp"], w["end_timestamp"]) == (1, "2024-01-01T09:00:00.000000+09", "2024-01-01T09:00:02.000000+09")
    assert list(w["pi"]) == registry.columns("touch") and w["pi"]["total_touch_count_mean"] == 30 and w["pi"]["touch_pressure_mean"] is None
    assert batch.output_root("/x/data/") == "/x/primitive_indicator"
    docs = batch.run(spark, base, "eye-tracking", CFG).documents
    none = next(json.loads(r.document) for r in docs.collect() if r.client_id == "eve")
    assert none["windows"] == []


def test_voice(spark, base):
    r = batch.run(spark, base, "voice", PIConfig(window_s=1, stride_s=0.5))
    assert [e.error for e in r.errors.collect()] == ["no format chunk"] or r.errors.count() == 1
    rows = r.wide.orderBy("win").collect()
    assert [x.win for x in rows] == [1, 2, 3, 4]
    assert rows[0].pitch_level_f0_mean == pytest.approx(200, rel=0.05)
    assert 0 < rows[1].nonspeech_ratio_mean < 1 and rows[0].pause_rate_mean is not None
    doc = json.loads(r.documents.first().document)
    assert list(doc["windows"][0]["pi"]) == registry.columns("voice")


def test_single_file_and_command_line(spark, base, tmp_path):
    path = f"{base}/20240101/ann/draw/stylus/a1/stylus.csv"
    one = batch.run_file(spark, path, "touch", CFG, "zoe", "sketch").documents.collect()
    assert [(r.client_id, r.task) for r in one] == [("zoe", "sketch")]
    from loomspan.__main__ import main

    assert main(["touch", base, "--output_root", str(tmp_path / "a"), "--clients", "ann", "--window_size_sec", "2", "--stride_sec", "1"]) == 0
    assert main(["touch", path, "--single", "--client_id", "zoe", "--context", "sketch", "--output_root", str(tmp_path / "b")]) == 0
    assert (tmp_path / "a/ann/draw/touch_pi.json").exists() and json.loads((tmp_path / "b/zoe/sketch/touch_pi.json").read_text())["client_id"] == "zoe"


def test_wav_formats():
    y = np.array([0.0, 0.5, -0.5, 0.25], np.float32)
    assert np.allclose(files.decode_wav(files.write_wav(y, 8000))[0], y, atol=1e-3)
    import struct

    def riff(code, channels, bits, data):
        fmt = struct.pack("<HHIIHH", code, channels, 8000, 0, 0, bits)
        return b"RIFF\0\0\0\0WAVEfmt " + struct.pack("<I", 16) + fmt + b"data" + struct.pack("<I", len(data)) + data

    assert np.allclose(files.decode_wav(riff(3, 1, 32, y.astype("<f4").tobytes()))[0], y)
    assert np.allclose(files.decode_wav(riff(1, 1, 8, bytes([128, 192, 64, 160])))[0], y)
    assert np.allclose(files.decode_wav(riff(1, 1, 32, (y * 2**31).astype("<i4").tobytes()))[0], y)
    assert np.allclose(files.decode_wav(riff(1, 1, 24, b"".join(int(v * 2**23).to_bytes(3, "little", signed=True) for v in y)))[0], y)
    assert np.allclose(files.decode_wav(riff(3, 2, 32, np.repeat(y, 2).astype("<f4").tobytes()))[0], y)
    with pytest.raises(ValueError):
        files.decode_wav(b"no")


def test_registry():
    assert {m: len(n) for m, n in registry.INDICATORS.items()} == {"eye-tracking": 93, "keyboard": 62, "touch": 84, "voice": 31}
    assert registry.slug("Pitch Level (F0)") == "pitch_level_f0" and registry.slug("Range-based Gaze Dispersion") == "range_based_gaze_dispersion"
    assert len(document.FILES) == 4


def test_zone_offsets_are_those_of_the_instant(spark):
    from loomspan.plans import document

    rows = [(1705320000_000000,), (1721044800_000000,), (1711846799_000000,), (1711846800_000000,)]  # January, July, before and after the clocks change
    df = spark.createDataFrame(rows, "us long")
    got = [[r.b, r.k] for r in df.select(document.zone_minutes(F.col("us"), "Europe/Berlin").alias("b"), document.zone_minutes(F.col("us"), "Asia/Kolkata").alias("k")).collect()]
    assert got == [[60, 330], [120, 330], [60, 330], [120, 330]]
    times = df.select(document.iso(F.col("us"), document.zone_minutes(F.col("us"), "Europe/Berlin")).alias("t")).collect()
    assert [r.t for r in times[2:]] == ["2024-03-31T01:59:59.000000+01", "2024-03-31T03:00:00.000000+02"]


def test_other_clients_files_are_not_read(spark, tmp_path):
    """With contents limited below the size of another client's file, reading that file would fail."""
    root = str(tmp_path / "da+ta %41")
    for modality, folder, name in (("eye-tracking", "eye-tracking", "eye-tracking.csv"), ("touch", "Stylus", "stylus.csv")):
        put(root, f"20240101/c 1+é/task/{folder}/a/{name}", "timestamp,x,y\n1,2,3\n")
        put(root, f"20240101/c2/task/{folder}/a/{name}", "x" * 5000)
        before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
        try:
            kept = files.sessions(spark, root, modality, ["c 1+é"]).collect()
            assert [(r.client_id, len(r.content)) for r in kept] == [("c 1+é", 20)]
            with pytest.raises(Exception, match="(?i)exceeds|max"):
                files.sessions(spark, root, modality, ["c2"]).collect()
        finally:
            spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)


def test_files_are_parsed_once(spark, base):
    """The plan of a run's rows, documents and errors holds no parsing: cells and frames are made before."""
    for modality in ("eye-tracking", "touch", "voice"):
        r = batch.run(spark, base, modality, CFG)
        for df in (r.wide, r.documents, r.errors):
            assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()


def test_documents_appear_together(spark, tmp_path):
    """A task that fails leaves no new document, none half written and those that were there; a run that succeeds replaces them."""
    root = str(tmp_path / "out")
    schema = "sess string, client_id string, task string, date string, archive_id string, document string"
    docs = lambda *texts: spark.createDataFrame([(str(i), f"c{i}", "t", "d", "a", x) for i, x in enumerate(texts)], schema).repartition(len(texts), "sess")
    assert document.write_documents(docs('{"v": 1}', '{"v": 2}'), root, "touch") == 2
    with pytest.raises(Exception, match="(?s)JSON|Expecting"):
        document.write_documents(docs('{"v": 3}', '{"v": 4}', '{"v": 5}', "no document"), root, "touch")
    held = {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names}
    assert held == {"c0/t/touch_pi.json", "c1/t/touch_pi.json"}
    assert [json.load(open(f"{root}/c{i}/t/touch_pi.json")) for i in (0, 1)] == [{"v": 1}, {"v": 2}]
    assert document.write_documents(docs('{"v": 6}'), root, "touch") == 1 and json.load(open(f"{root}/c0/t/touch_pi.json")) == {"v": 6}


def test_root_of_documents():
    assert batch.output_root("/x/pdss/hospital_data/") == "/x/pdss/primitive_indicator"
    assert batch.output_root("/x/hospital_data/20240101/c/t/stylus/a/stylus.csv", single=True) == "/x/primitive_indicator"
    assert batch.output_root("/x/elsewhere/stylus.csv", single=True) == "/x/elsewhere" and batch.output_root("/x/a.csv", "/out", True) == "/out"


def test_older_option_names(spark, base, tmp_path):
    from loomspan.__main__ import main

    assert main(["keyboard", "--root_dir", base, "--output_base_path", str(tmp_path), "--window_size_sec", "2", "--stride_sec", "1"]) == 0
    assert (tmp_path / "ann/type/keyboard_pi.json").exists()
    with pytest.raises(SystemExit):
        main(["keyboard"])
