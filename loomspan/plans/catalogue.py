"""Registered queries of the sensor engine over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions import stats
from loomspan.operators import windows as W
from loomspan.sources import adapters

from . import document, eye, keyboard, oracle, touch, voice
from .config import PIConfig

EYE, KEY, TOUCH, VOICE = PIConfig(2, 1), PIConfig(20, 10), PIConfig(2, 1), PIConfig(3, 1.5)
G = ["sess", "win"]


def rounded(c: str) -> str:
    """A double for comparison with SQL: in single precision (7 significant digits, whatever its magnitude), after the ninth decimal is rounded."""
    return f"CAST(CAST(round(`{c}`, 9) AS FLOAT) AS DOUBLE) + 0.0D AS `{c}`"


def tidy(df: DataFrame) -> DataFrame:
    return df.selectExpr(*(rounded(c) if t == "double" else f"`{c}`" for c, t in df.dtypes))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Keys and the four statistics of the named indicators."""
    return df.select(*G, *(f"{n}_{s}" for n in names for s in ("mean", "std", "min", "max")))


def fam(prefix: str, *stems: str) -> list[str]:
    return [f"{prefix}_{s}{k}" for s in stems for k in ("", "_x", "_y")]


def counted(spine: DataFrame, held: DataFrame) -> DataFrame:
    return spine.join(held.groupBy(*G).agg(F.count("*").alias("n")), G, "left").fillna(0, ["n"])


def gaze(s, d):
    return eye.windows(adapters.gaze(s, d), EYE)


def eye_events(s, d):
    lab = eye.labelled(eye.intervals(gaze(s, d)))
    return lab, eye.events(lab)


def win_clipped(s, d):
    g = adapters.gaze(s, d)
    return counted(W.spine(W.bounds(g, "t"), W.CLIPPED, 2000, 1000), gaze(s, d))


def win_full(s, d):
    p = adapters.key_paired(s, d)
    return counted(keyboard.all_windows(p, KEY), keyboard.windows(p, KEY))


def win_full_nonempty(s, d):
    return W.assign(adapters.touch(s, d), "t", W.NONEMPTY, 2_000_000, 1_000_000).groupBy(*G).agg(F.min("w_start").alias("w_start"), F.min("w_end").alias("w_end"), F.count("*").alias("n"))


def win_padded(s, d):
    f = adapters.voice_frames(s, d).withColumn("en", F.col("ord") + 1)
    return counted(W.spine(W.bounds(f, "ord", "en"), W.PADDED, 300, 150), W.assign(f, "ord", W.PADDED, 300, 150, end="en"))


def eye_position_velocity(s, d):
    wd = gaze(s, d)
    kin = eye.kinematics(eye.intervals(wd), wd.where("on"))
    return tidy(pick(eye.positions(wd, EYE), "gaze_position_x", "gaze_position_y").join(pick(kin, *fam("gaze", "velocity", "acceleration")), G, "left"))


def eye_jerk(s, d):
    wd = gaze(s, d)
    iv = eye.derived(eye.intervals(wd), eye.in_order())
    return tidy(iv.groupBy(*G).agg(*(x for k in ("", "x", "y") for x in eye.stats4(f"gaze_jerk{'_' + k if k else ''}", f"j{k}", 1))))


def eye_path_bbox_dispersion(s, d):
    wd = gaze(s, d)
    kin, pos = eye.kinematics(eye.intervals(wd), wd.where("on")), eye.positions(wd, EYE)
    curve = kin.join(pos, G).select(*G, *eye.scalar4("gaze_path_curvature", eye.ratio("path", "gaze_path_displacement_mean"), 1))
    names = ["gaze_path_displacement", "gaze_bbox_width", "gaze_bbox_height", "gaze_bbox_aspect_ratio", "range_based_gaze_dispersion", "rms_based_gaze_dispersion", "bbox_area_based_gaze_dispersion", "gaze_covariance"]
    return tidy(pick(pos, *names).join(pick(kin, "gaze_path_length"), G).join(curve, G))


def eye_entropy(s, d):
    return tidy(pick(eye.scanpath(gaze(s, d).where("on")), "gaze_entropy"))


def eye_fractal(s, d):
    return tidy(pick(eye.scanpath(gaze(s, d).where("on")), "scanpath_fractal_dimension"))


def eye_rqa(s, d):
    return tidy(pick(eye.scanpath(gaze(s, d).where("on")), "scanpath_revisit_ratio", "scanpath_determinism_ratio"))


def eye_dwell_regions(s, d):
    return tidy(eye.dwell(gaze(s, d), EYE))


def eye_center_bias(s, d):
    return tidy(pick(eye.positions(gaze(s, d), EYE), "gaze_offset_to_screen_center", "central_bias"))


def eye_threshold(s, d):
    return tidy(eye.threshold(eye.intervals(gaze(s, d))).groupBy(*G).agg(F.max("thr").alias("thr")))


def eye_fixations(s, d):
    f = eye_events(s, d)[1].where("kind = 'fixation'").groupBy(*G).agg(*eye.shape("fixation"))
    return tidy(f.select(*(c for c in f.columns if not c.startswith("inter_"))))


def eye_saccades(s, d):
    lab, ev = eye_events(s, d)
    sac = eye.saccades(ev)
    skip = ("inter_", "saccade_endpoint", "backtrack", "n_sac")
    return tidy(sac.select(*[c for c in sac.columns if not any(x in c for x in skip)]).join(eye.saccade_motion(lab), G))


def eye_event_geometry(s, d):
    ev = eye_events(s, d)[1]
    f = ev.where("kind = 'fixation'").groupBy(*G).agg(*eye.points("fixation_centroid", "mx", "my"))
    return tidy(f.join(ev.where("kind = 'saccade'").groupBy(*G).agg(*eye.points("saccade_endpoint", "ex", "ey")), G, "full"))


def eye_intervals_backtrack(s, d):
    wd = gaze(s, d)
    ev = eye.events(eye.labelled(eye.intervals(wd)))
    fix, sac = eye.fixations(ev), eye.saccades(ev)
    parts = pick(fix, "inter_fixation_interval"), pick(sac, "inter_saccade_interval", "backtrack_saccade_rate", "backtrack_saccade_ratio")
    return tidy(eye.rates(wd.where("on"), fix, sac).join(parts[0], G, "left").join(parts[1], G, "left"))


def eye_drift(s, d):
    return tidy(eye.drift(eye_events(s, d)[0]))


def eye_hull(s, d):
    return tidy(pick(eye.fixations(eye_events(s, d)[1]), "fixation_convex_hull_area", "fixation_convex_hull_perimeter"))


def keys(s, d):
    return keyboard.windows(adapters.key_paired(s, d), KEY)


def key_counts_ratios(s, d):
    return tidy(keyboard.counts(keys(s, d)))


def key_holds(s, d):
    return tidy(keyboard.holds(keys(s, d)))


def key_intervals_overlap(s, d):
    st = keyboard.step_stats(keyboard.steps(keys(s, d), 2), KEY)
    return tidy(pick(st, "down_down_interval", "up_down_interval", "up_up_interval", "key_overlap_duration", "key_overlap_ratio", "ngram_typing_duration"))


def key_pause_burst(s, d):
    st = keyboard.steps(keys(s, d), 2)
    return tidy(pick(keyboard.step_stats(st, KEY), "pause_duration", "pause_ratio").join(keyboard.bursts(st, KEY), G, "left"))


def key_words_ngrams(s, d):
    return tidy(keyboard.words(keyboard.steps(keys(s, d), 2)))


def key_chords(s, d):
    return tidy(keyboard.chords(keyboard.steps(keys(s, d), 2)))


def key_entropy(s, d):
    return tidy(keyboard.entropies(keyboard.steps(keys(s, d), 2)))


def key_lifo_pairing(s, d):
    return keyboard.pair_events(adapters.key_events(s, d)).drop("ord")


def touches(s, d):
    wd = touch.windows(adapters.touch(s, d), TOUCH)
    st = touch.strokes(wd)
    return wd, st, touch.gestures(wd, st)


STROKE = ("first_touch_latency", "first_touch_duration", "touch_hold_duration", "inter_touch_interval", "active_touch_time", "touch_stroke_pressure_slope", "total_touch_stroke_count", "touch_stroke_rate", "touch_event_touch_stroke_ratio")


def touch_strokes(s, d):
    wd, st, _ = touches(s, d)
    return tidy(pick(touch.stroke_stats(wd, st, TOUCH), *STROKE))


def touch_gestures(s, d):
    wd, st, ge = touches(s, d)
    names = [x for k in touch.KINDS.values() for x in (f"{k}_ratio", f"{k}_duration", f"inter_{k}_interval")]
    return tidy(pick(touch.stroke_stats(wd, st, TOUCH), *names).join(touch.pressures(ge), G))


def touch_kinematics(s, d):
    return tidy(pick(touch.event_stats(touch.windows(adapters.touch(s, d), TOUCH), TOUCH), "high_velocity_touch_count", "touch_pressure_change_rate", "touch_area_change_rate"))


def touch_swipe_kinematics(s, d):
    return tidy(pick(touch.swipe_motion(touches(s, d)[2]), *fam("swipe", "velocity", "acceleration", "jerk")))


def touch_direction(s, d):
    return tidy(pick(touch.swipe_motion(touches(s, d)[2]), "swipe_direction", "swipe_angular_velocity", "swipe_direction_change_count"))


def touch_swipe_geometry(s, d):
    _, st, ge = touches(s, d)
    return tidy(touch.swipe_shape(ge, st, TOUCH))


REGIONS = ("edge_touch_ratio", "left_half_touch_ratio", "right_half_touch_ratio", "top_half_touch_ratio", "bottom_half_touch_ratio", "central_touch_ratio", "touch_offset_to_screen_center", "central_bias", "range_based_touch_dispersion", "rms_based_touch_dispersion", "bbox_area_based_touch_dispersion", "touch_covariance")
PRESSURE = ("touch_position_x", "touch_position_y", "touch_pressure", "total_touch_count", "touch_event_rate", "high_pressure_touch_count", "touch_area", "touch_major_axis", "touch_minor_axis", "touch_pressure_area_correlation", "touch_area_slope")


def touch_regions(s, d):
    return tidy(pick(touch.event_stats(touch.windows(adapters.touch(s, d), TOUCH), TOUCH), *REGIONS))


def touch_pressure_area(s, d):
    return tidy(pick(touch.event_stats(touch.windows(adapters.touch(s, d), TOUCH), TOUCH), *PRESSURE))


def touch_entropy(s, d):
    return tidy(touch.grid_entropy(touch.windows(adapters.touch(s, d), TOUCH)))


def touch_fractal(s, d):
    return tidy(touch.fractal(touches(s, d)[2]))


def touch_hull(s, d):
    return tidy(touch.hulls(touch.windows(adapters.touch(s, d), TOUCH)))


def touch_rhythm(s, d):
    return tidy(touch.rhythm(touch.windows(adapters.touch(s, d), TOUCH)))


def frames(s, d):
    return voice.speech(voice.windows(adapters.voice_frames(s, d), VOICE))


def voice_vad_pause(s, d):
    return tidy(voice.pause_stats(voice.pauses(frames(s, d)), VOICE))


def voice_loudness(s, d):
    return tidy(voice.loudness(frames(s, d)))


def voice_envelope_ma(s, d):
    return tidy(voice.tremor_extent(voice.envelope(frames(s, d))))


def voice_syllables(s, d):
    return tidy(voice.syllables(voice.envelope(frames(s, d))))


def voice_rhythm(s, d):
    return tidy(voice.rhythm(voice.envelope(frames(s, d))))


def voice_pitch(s, d):
    """Pitch statistics with each frame's pitch made from its loudness, as the tables hold no audio."""
    f = adapters.voice_frames(s, d).withColumn("f0", F.when(F.col("ord") % 7 != 0, 80 + F.col("rms").cast("double") * 300 % 200))
    return tidy(voice.pitch(voice.speech(voice.windows(f, VOICE))))


def voice_signal_frames(s, d):
    """Loudness and pitch of the frames of signals made of table values."""
    f = voice.frames(adapters.signals(s, d), adapters.RATE)
    return tidy(f.select("sess", "i", F.col("rms").cast("double").alias("rms"), "f0"))


def voice_signal_pitch(s, d):
    """Pitch statistics of the speech in these signals."""
    f = voice.frames(adapters.signals(s, d), adapters.RATE)
    return tidy(pick(voice.pitch(voice.speech(f)), "pitch_level_f0", "voiced_ratio", "voicing_breaks_rate"))


def audio_spectrum(s, d):
    """Spectra of the embedding vectors taken as signals."""
    v = adapters.audio_vectors(s, d).withColumn("r", voice.spectral.band_rhythm(F.col("y"), F.lit(100.0), F.lit(0.5), F.lit(12.0)))
    return tidy(v.select("sess", F.col("r.rate").alias("rate"), F.col("r.entropy").alias("entropy"), F.col("r.regularity").alias("regularity")))


def null_indicators(s, d):
    spine = keyboard.all_windows(adapters.key_paired(s, d), KEY).select(*G)
    held = spine.select(*G, *keyboard.undefined())
    return held.withColumns({f"{n}_{k}": F.lit(None).cast("double") for n in voice.UNDEFINED for k in stats.STATS})


def eye_indicators(s, d):
    return tidy(eye.indicators(adapters.gaze(s, d), EYE))


def keyboard_indicators(s, d):
    return tidy(keyboard.indicators(adapters.key_paired(s, d), KEY))


def touch_indicators(s, d):
    return tidy(touch.indicators(adapters.touch(s, d), TOUCH))


def voice_indicators(s, d):
    return tidy(voice.indicators(adapters.voice_frames(s, d), VOICE))


def pi_document_json(s, d):
    events = adapters.touch(s, d)
    wide = touch.indicators(events, TOUCH)
    return document.documents(document.keyed(wide, F.lit("touch")), "touch", TOUCH, samples=events.count())


FLAGSHIP = "eye_path_bbox_dispersion"
QUERIES = {
    f.__name__: f
    for f in (
        win_clipped, win_full, win_full_nonempty, win_padded, eye_position_velocity, eye_jerk, eye_path_bbox_dispersion, eye_entropy, eye_fractal, eye_rqa, eye_dwell_regions, eye_center_bias, eye_threshold,
        eye_fixations, eye_saccades, eye_event_geometry, eye_intervals_backtrack, eye_drift, eye_hull, key_counts_ratios, key_holds, key_intervals_overlap, key_pause_burst, key_words_ngrams, key_chords, key_entropy,
        key_lifo_pairing, touch_strokes, touch_gestures, touch_kinematics, touch_swipe_kinematics, touch_direction, touch_swipe_geometry, touch_regions, touch_pressure_area, touch_entropy, touch_fractal, touch_hull, touch_rhythm,
        voice_vad_pause, voice_loudness, voice_envelope_ma, voice_syllables, voice_rhythm, voice_pitch, voice_signal_frames, voice_signal_pitch, audio_spectrum, null_indicators, eye_indicators, keyboard_indicators, touch_indicators, voice_indicators, pi_document_json,
    )
}
SQL = oracle.SQL
