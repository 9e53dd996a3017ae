"""Operators of the sensor engine: against SQL, brute force and hand-made rows."""

import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspan.functions import spectral, stats, tokens
from loomspan.operators import geometry, sequence
from loomspan.operators import windows as W
from loomspan.plans import catalogue, document, eye, keyboard, registry, touch, voice
from loomspan.plans.config import PIConfig
from loomspan.sources import adapters

SF = "/root/testdata/sf0.001"
TABLES = ("events", "orders", "embeddings", "customer")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, duck, name):
    a, b = catalogue.QUERIES[name](spark, SF).toPandas(), duck.sql(catalogue.SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns) and len(a) == len(b) > 0
    keys = [c for c in ("sess", "win", "i", "token", "down", "up") if c in a.columns]
    a, b = (x[sorted(x.columns)].sort_values(keys).reset_index(drop=True) for x in (a, b))
    for c in a.columns:
        x, y = a[c], b[c]
        same = (x.isna() & y.isna()) | (x == y)
        assert same.all(), (c, x[~same].head(), y[~same].head())


@pytest.mark.parametrize(("modality", "name"), [("eye-tracking", "eye_indicators"), ("keyboard", "keyboard_indicators"), ("touch", "touch_indicators"), ("voice", "voice_indicators")])
def test_every_indicator(spark, modality, name):
    df = catalogue.QUERIES[name](spark, SF)
    assert set(registry.columns(modality)) <= set(df.columns) and len(df.columns) == len(set(df.columns))
    rows = df.limit(20).collect()
    for r in rows:
        d = r.asDict()
        for n in registry.INDICATORS[modality]:
            lo, mean, hi = d[f"{n}_min"], d[f"{n}_mean"], d[f"{n}_max"]
            if n not in ("saccade_direction",) and None not in (lo, mean, hi):
                assert lo - 1e-3 - 1e-6 * abs(lo) <= mean <= hi + 1e-3 + 1e-6 * abs(hi), n
        assert all(v is None or not isinstance(v, float) or math.isfinite(v) for v in d.values())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=25), st.integers(1, 20), st.integers(1, 25), st.sampled_from([W.CLIPPED, W.FULL, W.NONEMPTY]))
def test_windows_equal_range_join(spark, times, size, stride, policy):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(times)], "sess int, ord int, t long")
    got = sorted((r.win, r.w_start, r.w_end, r.ord) for r in W.assign(df, "t", policy, size, stride).collect())
    lo, hi, want, k, n = min(times), max(times), [], 0, 0
    while (s := lo + k * stride) < hi or (policy == W.NONEMPTY and s <= hi):
        e = min(s + size, hi) if policy == W.CLIPPED else s + size
        inside = [i for i, t in enumerate(times) if s <= t < e]
        n += bool(inside)
        want += [(n if policy == W.NONEMPTY else k + 1, s, e, i) for i in inside]
        k += 1
    assert got == sorted(want)
    spine = W.spine(W.bounds(df, "t"), policy, size, stride).collect()
    assert sorted(r.win for r in spine) == list(range(1, k + 1))


def test_events_are_dealt_by_their_number(spark, monkeypatch):
    rows = spark.read.parquet(f"{SF}/events.parquet").count()
    monkeypatch.setattr(adapters, "dealt", lambda df, n, *keys: W.dealt(df, n, *keys, share=rows // 20))
    assert adapters.events(spark, SF).rdd.getNumPartitions() >= 20


def test_windows_reject_bad_sizes(spark):
    df = spark.createDataFrame([(1, 1)], "sess int, t long")
    for size, stride in ((0, 1), (1, 0), (1, -1)):
        with pytest.raises(ValueError):
            W.assign(df, "t", W.FULL, size, stride)
    with pytest.raises(ValueError):
        PIConfig(stride_s=0)


def test_lifo_equals_stack(spark):
    rng = random.Random(1)
    rows = [(s, i, rng.choice("ab"), rng.random() < 0.5) for s in range(60) for i in range(rng.randint(0, 25))]
    df = spark.createDataFrame(rows, "sess int, t int, token string, down boolean")
    got = sorted((r.sess, r.token, r.opened, r.closed) for r in sequence.lifo_pairs(df, ["sess", "token"], ["t"], F.col("down"), ~F.col("down"), "t").collect())
    stacks, want = {}, []
    for s, t, k, down in rows:
        stack = stacks.setdefault((s, k), [])
        if down:
            stack.append(t)
        elif stack:
            want.append((s, k, stack.pop(), t))
    assert got == sorted(want)


def test_strokes_equal_state_machine(spark):
    rng = random.Random(2)
    rows = [(s, 1, i, i, rng.randint(0, 1), rng.choice([0, 1, 2, 2, 2, 3, 4])) for s in range(80) for i in range(rng.randint(1, 20))]
    df = spark.createDataFrame(rows, "sess int, win int, ord int, t int, pi int, et int")
    got = {(r.sess, r.ord): r.stroke for r in sequence.stroke_ids(df, ["sess", "win"]).collect()}
    for s in range(80):
        n, cur = 0, {}
        for r in sorted((r for r in rows if r[0] == s), key=lambda r: (r[4], r[3])):
            if r[5] == 1:
                cur[r[4]], n = n, n + 1
            assert got[s, r[2]] == cur.get(r[4])
            if r[5] == 3:
                cur[r[4]] = None


def test_recurrence_equals_matrix(spark):
    rng = random.Random(3)
    rows = [(s, i, rng.randint(0, 3)) for s in range(40) for i in range(rng.randint(1, 30))]
    got = {r.sess: r for r in geometry.recurrence(spark.createDataFrame(rows, "sess int, t int, v int"), ["sess"], ["t"], F.col("v")).collect()}
    for s in range(40):
        v = [r[2] for r in rows if r[0] == s]
        m = np.array([[a == b for b in v] for a in v])
        line = sum(m[i, j] and ((i and j and m[i - 1, j - 1]) or (i + 1 < len(v) and j + 1 < len(v) and m[i + 1, j + 1])) for i in range(len(v)) for j in range(len(v)))
        assert got[s].rate == pytest.approx(m.mean()) and got[s].determinism == pytest.approx(line / m.sum())


def test_recurrence_thins_long_sequences(spark):
    v = [(i * i) % 7 for i in range(4500)]
    got = geometry.recurrence(spark.createDataFrame([(1, i, x) for i, x in enumerate(v)], "sess int, t int, v int"), ["sess"], ["t"], F.col("v")).first()
    kept = np.array(v)[np.linspace(0, len(v) - 1, 2000).astype(int)]
    assert got.rate == pytest.approx((kept[:, None] == kept[None, :]).mean(), abs=2e-3)


def test_stats(spark):
    rows = [(1, 1.0), (1, 3.0), (1, float("nan")), (1, float("inf")), (1, None), (2, 5.0), (3, float("nan"))]
    df = spark.createDataFrame(rows, "g int, v double")
    for ddof, std1, lone in ((1, math.sqrt(2), None), (0, 1.0, 0.0)):
        got = {r.g: tuple(r)[1:] for r in df.groupBy("g").agg(*stats.stats4("x", "v", ddof)).collect()}
        assert got[1] == (2.0, pytest.approx(std1), 1.0, 3.0) and got[2] == (5.0, lone, 5.0, 5.0) and got[3] == (None,) * 4
    one = spark.range(1).select(*stats.scalar4("a", F.lit(-0.0), 1), *stats.scalar4("b", F.lit(2.0), 0), *stats.scalar4("c", F.lit(None), 0)).first()
    assert tuple(one) == (0.0, None, 0.0, 0.0, 2.0, 0.0, 2.0, 2.0, None, None, None, None) and math.copysign(1, one.a_mean) == 1


def test_circular(spark):
    a = [math.pi - 0.1, -math.pi + 0.1, math.pi]
    r = spark.createDataFrame([(x,) for x in a], "a double").agg(*stats.circular4("d", "a")).first()
    c, s = np.mean(np.cos(a)), np.mean(np.sin(a))
    assert abs(r.d_mean) == pytest.approx(math.pi) and r.d_std == pytest.approx(math.sqrt(-2 * math.log(math.hypot(c, s)))) and r.d_min == pytest.approx(-math.pi)
    same = spark.createDataFrame([(0.7,)] * 3, "a double").agg(*stats.circular4("d", "a")).first()
    assert same.d_std == pytest.approx(0, abs=1e-7)
    assert spark.createDataFrame([(0.7,)], "a double").agg(*stats.circular4("d", "a")).first().d_std is None


def test_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (1.0, 3.0, 1.0)], "a double, b double, t double")
    r = df.agg(stats.correlation("a", "b").alias("r"), stats.slope("b", "t").alias("s"), stats.ratio(F.sum("a"), F.lit(0)).alias("q")).first()
    assert tuple(r) == (None, None, None)


def gaze(spark, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "sess int, ord int, t long, x double, y double")


def test_eye_edges(spark):
    cfg = PIConfig(10, 10)
    off = eye.indicators(gaze(spark, [(0, -5.0, 1.0), (100, float("nan"), 1.0), (400, None, None), (500, 1.0, 1.0)]), cfg).first()
    assert off.off_screen_duration_mean == 100 and off.gaze_position_x_mean is None and off.n_samples == 3
    assert eye.indicators(gaze(spark, [(0, 1.0, 1.0)]), cfg).count() == 0
    # 201 ms are a gap, 200 are none; a window's last sample is in no window
    r = eye.indicators(gaze(spark, [(0, 0.0, 0.0), (200, 10.0, 0.0), (401, 20.0, 0.0), (420, 20.0, 0.0), (900, 0.0, 0.0)]), cfg).first()
    assert r.gaze_path_length_mean == 10.0 and r.gaze_velocity_mean == pytest.approx(25.0) and r.fixation_rate_mean == pytest.approx(1 / 0.9)
    assert r.fixation_duration_mean == 200 and r.fixation_convex_hull_area_mean == 0 and r.saccade_rate_mean == 0 and r.horizontal_saccade_rate_mean is None


def test_eye_segments(spark):
    """A jump between two rests: fixation, saccade, fixation, sharing samples."""
    rows = [(20 * i, 100.0, 100.0) for i in range(8)] + [(20 * 8, 400.0, 100.0)] + [(20 * (9 + i), 400.0, 100.0) for i in range(8)] + [(1000, 0.0, 0.0)]
    r = eye.indicators(gaze(spark, rows), PIConfig(0.9, 10)).first()
    assert (r.saccade_duration_mean, r.saccade_displacement_mean, r.saccade_direction_mean) == (20, 300, 0)
    assert (r.fixation_duration_min, r.fixation_duration_max, r.inter_fixation_interval_mean) == (140, 160, 20)
    assert r.first_saccade_latency_mean == 140 and r.fixation_saccade_ratio_mean == 2


def press(spark, rows):
    return spark.createDataFrame([(1, i, t, d * 1000, u * 1000, float(u - d)) for i, (t, d, u) in enumerate(rows)], "sess int, ord int, token string, down long, up long, hold double")


def test_keyboard_edges(spark):
    cfg = PIConfig(100, 100)
    one = keyboard.indicators(press(spark, [("A", 0, 50)]), cfg).first()
    assert one.total_keystroke_count_mean == 1 and one.pause_ratio_mean is None and one.burst_length_mean is None and one.down_down_interval_mean is None
    r = keyboard.indicators(press(spark, [("A", 0, 50), ("B", 2050, 2100), ("SPACE", 2080, 2200), ("C", 4199, 4210)]), cfg).first()
    assert (r.pause_duration_mean, r.burst_length_min, r.burst_length_max, r.key_overlap_ratio_mean) == (2000, 1, 3, pytest.approx(1 / 3))
    assert r.burst_velocity_mean == pytest.approx(3 / 2.149) and r.inter_word_interval_mean == 4199 and r.key_overlap_duration_max == 20
    empty = keyboard.indicators(press(spark, [("A", 0, 50), ("B", 250_000, 250_010)]), PIConfig(100, 100)).orderBy("win").collect()
    assert [x.n_samples for x in empty] == [1, 0, 1] and empty[1].total_keystroke_count_mean is None
    chord = keyboard.indicators(press(spark, [("CONTROL", 0, 100), ("V", 50, 150)]), cfg).first()
    assert (chord.paste_duration_mean, chord.paste_ratio_mean, chord.undo_ratio_mean) == (150, 0.5, 0)


def test_tokens(spark):
    raw = ["a", " ", None, "NA", "ß", "가", "shift", "Space", "5", "!", "²", "caps_lock", "F1"]
    got = [(r.t, r.c) for r in spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, x string").orderBy("i").select(tokens.normalise(F.col("x")).alias("t")).select("t", tokens.category(F.col("t")).alias("c")).collect()]
    assert got[0] == ("A", "alphabetic") and got[1] == got[2] == got[3] == ("", "other") and got[5] == ("가", "alphabetic")
    assert [c for _, c in got[6:]] == ["shift", "space", "digit", "punctuation", "digit", "capslock", "other"]


def touched(spark, rows):
    return spark.createDataFrame([(1, i, int(t * 1e6), pi, et, x, y, p, 2.0, 3.0) for i, (t, pi, et, x, y, p) in enumerate(rows)], "sess int, ord int, t long, pi int, et int, px double, py double, p double, h double, w double")


def test_touch_edges(spark):
    cfg = PIConfig(10, 10)
    rows = [(0.0, 0, 2, 5.0, 5.0, 0.5), (0.1, 0, 1, 10.0, 10.0, 0.5), (0.6, 0, 3, 30.0, 10.0, 0.5), (1.0, 0, 1, 0.0, 0.0, 0.5), (1.2, 0, 3, 50.0, 0.0, 0.5), (2.0, 0, 1, 1.0, 1.0, 0.5)]
    r = touch.indicators(touched(spark, rows), cfg).first()
    assert (r.total_touch_stroke_count_mean, r.long_press_ratio_mean, r.swipe_ratio_mean, r.tap_ratio_mean) == (3, pytest.approx(1 / 3), pytest.approx(1 / 3), pytest.approx(1 / 3))
    assert r.touch_pressure_area_correlation_mean is None and r.swipe_path_fractal_dimension_mean is None and r.first_touch_latency_mean == pytest.approx(0.1)
    assert r.inter_touch_interval_min == pytest.approx(0.4) and r.swipe_direction_mean == 0 and r.horizontal_swipe_rate_mean == pytest.approx(0.1)
    twice = [(0.0, 0, 1, 0.0, 0.0, None), (0.1, 0, 2, 60.0, 0.0, None), (0.1, 0, 2, 60.0, 60.0, None), (0.2, 0, 3, 0.0, 60.0, None)]
    t = touch.indicators(touched(spark, twice), cfg).first()
    assert t.swipe_angular_velocity_mean is None and t.swipe_angular_velocity_min is not None and t.touch_pressure_mean is None


def frames(spark, values):
    return spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(values)], "sess int, ord long, rms double").withColumn("rms", F.col("rms").cast("float"))


def test_voice_edges(spark):
    cfg = PIConfig(1, 1)
    quiet = voice.indicators(frames(spark, [1e-6] * 100), cfg).first()
    assert quiet.speech_ratio_mean == 1.0  # digital silence meets the floor
    r = voice.indicators(frames(spark, [0.1] * 40 + [1e-6] * 20 + [0.1] * 40), cfg).first()
    assert r.pause_duration_mean == pytest.approx(0.2) and r.utterance_rate_mean == 2 and r.speech_ratio_mean == pytest.approx(0.8)
    short = voice.indicators(frames(spark, [0.1] * 41 + [1e-6] * 19 + [0.1] * 40), cfg).first()
    assert short.pause_rate_mean == 0 and short.utterance_duration_mean == pytest.approx(1.0) and short.utterance_pause_ratio_mean is None
    assert r.pitch_level_f0_mean is None and r.rouge_l_similarity_mean is None
    padded = voice.indicators(frames(spark, [0.1] * 10), cfg).first()
    assert padded.total_speech_time_mean == pytest.approx(1.0)  # three quarters of padding: all frames count


def test_hull():
    square = np.array([[0, 0], [2, 0], [2, 2], [0, 2], [1, 1], [1, 0]], float)
    assert geometry.hull_measures(square) == (4.0, 8.0)
    assert geometry.hull_measures(square[:2]) == geometry.hull_measures(np.array([[0, 0], [1, 1], [2, 2]], float)) == (0.0, 0.0)


def test_spectra():
    t = np.arange(100) / 100
    rate, entropy, peak = spectral.power_spectrum_features(np.sin(2 * np.pi * 5 * t), 100)
    assert rate == 5 and entropy == pytest.approx(0, abs=1e-6) and peak > 40
    assert spectral.power_spectrum_features(np.ones(50), 10) == (None, None, None) == spectral.power_spectrum_features(np.ones(3), 10)
    assert spectral.band_features(np.sin(2 * np.pi * 5 * t), 100, 3, 12)[0] == 5
    y = np.array([0, 1, 0, 2, 2, 0, 1, 0, 0, 0, 0, 3, 0], float)
    assert spectral.peaks(y, 1, None).tolist() == [1, 3, 6, 11] and spectral.peaks(y, 4, 1).tolist() == [3, 11]
    f0 = spectral.yin(np.sin(2 * np.pi * 220 * np.arange(8000) / 16000), 16000)
    assert np.median(f0) == pytest.approx(220, rel=0.02)


def test_peaks_equal_all_against_all():
    rng = random.Random(4)
    for _ in range(300):
        y = np.array([rng.randint(0, 4) for _ in range(rng.randint(0, 40))], float)
        distance, height = rng.randint(1, 9), rng.choice([None, 2.0])
        top = [(i, j) for i in range(1, len(y)) for j in range(i, len(y) - 1) if (y[i : j + 1] == y[i]).all() and y[i - 1] < y[i] > y[j + 1]]
        at = [(i + j) // 2 for i, j in top if height is None or y[i] >= height]
        kept: list = []
        for i in sorted(at, key=lambda i: (y[i], i), reverse=True):
            if all(abs(i - k) >= distance for k in kept):
                kept.append(i)
        assert spectral.peaks(y, distance, height).tolist() == sorted(kept)


def test_differences_equal_sums():
    rng = np.random.default_rng(6)
    rows, width, lags = np.concatenate([rng.normal(size=(50, 100)), np.zeros((2, 100)), np.ones((2, 100))]), 50, 51
    want = np.array([[((r[:width] - r[k : k + width]) ** 2).sum() for k in range(lags)] for r in rows])
    assert np.allclose(spectral.differences(rows, width, lags), want, atol=1e-9) and (spectral.differences(rows, width, lags)[50:] == 0).all()


def test_one_session_is_spread_over_tasks(spark):
    """A long session's windows are dealt by session and window: no exchange or window of the plan is by the session alone, and rows equal arithmetic."""
    n = 200_000
    df = spark.range(n).select(F.lit(1).alias("sess"), F.col("id").alias("ord"), (F.col("id") * 10).alias("t"))
    dealt = W.assign(df, "t", W.CLIPPED, 2000, 1000)
    sizes = dealt.repartition(16, "sess", "win").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 12 and max(r["count"] for r in sizes) < 0.15 * sum(r["count"] for r in sizes)
    assert "Window [" not in dealt._jdf.queryExecution().executedPlan().toString()
    got = dealt.groupBy("win").agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).collect()
    last = (n - 1) * 10
    assert len(got) == -(-last // 1000)
    for r in got:
        lo, hi = (r.win - 1) * 1000, min((r.win - 1) * 1000 + 2000, last)
        assert (r.lo, r.hi, r.n) == (lo, (hi - 1) // 10 * 10, -(-hi // 10) - lo // 10)


def test_gaze_indicators_are_one_pass(spark):
    plan = catalogue.QUERIES["eye_indicators"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2 and plan.count("Exchange hashpartitioning") <= 4


def test_gaze_indicators_sort_few_times(spark):
    """What is done with a session's windows is a handful of sorts and passes, not one of each for every count."""
    plan = catalogue.QUERIES["eye_indicators"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    dealt = plan[: plan.index("Exchange hashpartitioning(sess")]
    assert dealt.count("Sort [") <= 5 and dealt.count("Window [") <= 12


def test_paths_equal_sql_operators(spark):
    """Measures of paths as arrays: those of rows, with a path that is thinned, one of two points, of one and of none."""
    rng, size = random.Random(5), eye.CELL
    paths = {w: [(rng.randrange(-90, 900) / 2, rng.randrange(300) / 2) for _ in range(n)] for w, n in ((1, 5000), (2, 2001), (3, 2000), (4, 40), (5, 2), (6, 1), (7, 0))}
    df = spark.createDataFrame([(1, w, i, i, x, y) for w, p in paths.items() for i, (x, y) in enumerate(p)], "sess int, win int, t int, ord int, x double, y double")
    want = {r.win: r for r in eye.scanpath(df).collect()}
    arrays = spark.createDataFrame([(w, [x for x, _ in p], [y for _, y in p]) for w, p in paths.items()], "win int, xs array<double>, ys array<double>")
    got = {r.win: r.s for r in arrays.select("win", geometry.scanpath("xs", "ys", F.lit(size)).alias("s")).collect()}
    assert tuple(got[7]) == (None,) * 4 and set(got) == {*want, 7}
    for w, r in want.items():
        for mine, name in zip(got[w], ("gaze_entropy", "scanpath_fractal_dimension", "scanpath_revisit_ratio", "scanpath_determinism_ratio"), strict=True):
            assert mine == (r[f"{name}_mean"] if r[f"{name}_mean"] is None else pytest.approx(r[f"{name}_mean"], rel=1e-12, abs=1e-12)), (w, name)


def test_turns_of_45_degrees_equal_sql(spark, duck):
    """Three points a stroke, whose second step is the first turned by 45 degrees: whether the turn is over 45 goes by the last bit of atan2."""
    steps = [(x, y) for x in range(1, 41) for y in range(-40, 41)]
    rows = [(1, i, i * 9 + j, j * 10, float(px), float(py), 0.0) for i, (x, y) in enumerate(steps) for j, (px, py) in enumerate(((0, 0), (x, y), (2 * x - y, 2 * y + x)))]
    sw = spark.createDataFrame(rows, "sess int, stroke int, ord int, t int, px double, py double, a double").selectExpr("*", "1 AS win", "a AS ax", "a AS ay")
    got = {(r.stroke, r.ord % 9): r.turn for r in touch.with_motion(sw, touch.by_stroke()).collect()}
    want = duck.sql(f"SELECT i, atan2(x + y, x - y) - atan2(y, x) FROM (SELECT unnest({list(range(len(steps)))}) AS i, unnest({[float(x) for x, _ in steps]}) AS x, unnest({[float(y) for _, y in steps]}) AS y)").fetchall()
    assert [got[i, 2] for i, _ in want] == [w for _, w in want] and len({w > math.radians(45) for _, w in want}) == 2


def test_tied_powers_are_summed_in_order():
    """A single spike has a flat spectrum, so that only rounding tells its bins apart."""
    for n in range(4, 40):
        y = np.zeros(n)
        y[n // 3] = 1000 / 7
        z, best = y - sum(y.tolist()) / n, []
        for k in range(1, n // 2 + 1):
            c = s = 0.0
            for i in range(n):
                c, s = c + z[i] * np.cos(2 * np.pi * (k * i % n) / n), s + z[i] * np.sin(2 * np.pi * (k * i % n) / n)
            best.append(np.sqrt(c**2 + s**2) ** 2)
        assert spectral.power_spectrum_features(y, n)[0] == pytest.approx(1 + int(np.argmax(best)))


def test_tied_powers_are_those_of_the_c_library(monkeypatch):
    """NumPy's own sines may differ from the C library's, which SQL calls, in the last bit."""
    spikes = [np.where(np.arange(n) == n // 3, 1000 / 7, 0.0) for n in range(4, 60)]
    want = [spectral.power_spectrum_features(y, 1.0)[0] for y in spikes]
    cos, sin = np.cos, np.sin
    monkeypatch.setattr(np, "cos", lambda x: np.nextafter(cos(x), 2.0))
    monkeypatch.setattr(np, "sin", lambda x: np.nextafter(sin(x), 2.0))
    assert [spectral.power_spectrum_features(y, 1.0)[0] for y in spikes] == want


@pytest.mark.parametrize("size", [100, 1000])
def test_a_tasks_share_of_windows_does_not_grow(spark, monkeypatch, size):
    """Tasks by session and window grow with the rows: the largest holds about the share, of whatever input."""
    monkeypatch.setattr(W, "dealt", lambda df, rows, *keys, deal=W.dealt: deal(df, rows, *keys, share=50))
    df = spark.range(size * 10).select((F.col("id") % 97).alias("sess"), F.col("id").alias("ord"), (F.col("id") * 10).alias("t"))
    held = [len(p) for p in W.assign(df, "t", W.FULL, 2000, 2000).select("sess").rdd.glom().collect()]
    assert len(held) == max(4, size * 10 // 50) and max(held) < 50 * 6


def test_documents_are_dealt_by_samples(spark, monkeypatch):
    """The tasks that collect a session's windows are as many as its samples call for, with no exchange after."""
    monkeypatch.setattr(document, "dealt", lambda df, rows, *keys, share: W.dealt(df, rows, *keys, share=100))
    docs, n = catalogue.QUERIES["pi_document_json"](spark, SF), adapters.events(spark, SF).count()
    assert docs.rdd.getNumPartitions() == -(-n // 100) > 4


def test_signals_are_spread_and_tracked_together(spark):
    """Signals of a small file are tasks of their own share, and frames of signals taken together are those of each alone."""
    y = adapters.signals(spark, SF)
    assert y.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    rows = np.array([r.y for r in y.limit(7).collect()])
    for together, alone in zip(spectral.tracked_rows(rows, adapters.RATE), rows, strict=True):
        rms, f0 = spectral.tracked(alone, adapters.RATE)
        assert [f["rms"] for f in together] == rms.tolist() and [f["f0"] for f in together] == pytest.approx(f0)
