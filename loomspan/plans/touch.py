"""Touch indicators (84): touch events to one row for each session and window that holds an event.

As for gaze, all grains stand on the rows of one table: an event has its stroke's measures, a stroke's last event stands for
it, and one aggregation makes the row. The functions of single families are for queries of these alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import spectral
from loomspan.functions.stats import STATS, both_ways, correlation, extent, finite, guarded, only, quotient, ratio, rms, scalar4, slope, spread, stats4
from loomspan.operators import geometry
from loomspan.operators.sequence import stroke_ids
from loomspan.operators.windows import NONEMPTY, assign, dealt

from .config import PIConfig

G = ["sess", "win"]
LONG_PRESS_S, MAX_TAP, MIN_SWIPE, HARD, FAST, TURN = 0.5, 20.0, 50.0, 0.8, 1000.0, math.radians(45)
GRIDS = (4, 8, 16)
KINDS = {"tap": "tap", "swipe": "swipe", "longpress": "long_press"}


def in_order():
    return Window.partitionBy(*G).orderBy("t", "ord")


def in_window():
    return Window.partitionBy(*G)


def by_stroke():
    return Window.partitionBy(*G).orderBy("stroke", "t", "ord")


def windows(samples: DataFrame, cfg: PIConfig) -> DataFrame:
    """Events dealt to windows, with stroke (found inside the window), step kinematics and area. s is the event's time in seconds."""
    for c in ("px", "py", "p", "h", "w"):
        samples = samples.withColumn(c, finite(c))
    wd = stroke_ids(assign(samples, "t", NONEMPTY, cfg.us(cfg.window_s), cfg.us(cfg.stride_s)), G)
    wd = wd.withColumns({"s": F.col("t") / 1e6, "area": F.col("h") * F.col("w"), "major": F.when(F.col("h").isNotNull() & F.col("w").isNotNull(), F.greatest("h", "w")), "minor": F.when(F.col("h").isNotNull() & F.col("w").isNotNull(), F.least("h", "w"))})
    dt = (F.col("t") - F.lag("t").over(in_order())) / 1e6
    step = lambda c: F.try_divide(F.col(c) - F.lag(c).over(in_order()), F.col("dt"))
    wd = wd.withColumn("dt", dt).withColumns({"vx": step("px"), "vy": step("py"), "dp": F.abs(step("p")), "da": F.abs(step("area"))})
    wd = wd.withColumn("v", F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy")))
    return wd.withColumns({"ax": step("vx"), "ay": step("vy"), "a": step("v")})


def strokes(wd: DataFrame) -> DataFrame:
    """One row for each stroke with its gesture: a long press first (0.5 s within 20 px), then a swipe (50 px of way or distance), else a tap."""
    of = Window.partitionBy(*G, "stroke").orderBy("t", "ord")
    d = wd.where("stroke IS NOT NULL").withColumns({"_x": F.col("px") - F.lag("px").over(of), "_y": F.col("py") - F.lag("py").over(of)})
    first, last = (f(F.struct("px", "py"), F.struct("t", "ord")) for f in (F.min_by, F.max_by))
    st = d.groupBy(*G, "stroke").agg(
        F.min("t").alias("t0"), F.max("t").alias("t1"), F.coalesce(F.sum(F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y"))), F.lit(0.0)).alias("path"), first.alias("f"), last.alias("l"),
        slope("p", "s").alias("p_slope"), F.max("w_start").alias("w_start"),
    )
    st = gestured(st)
    gap = lambda *k: (F.lead("t0").over(Window.partitionBy(*G, *k).orderBy("t0", "stroke")) - F.col("t1")) / 1e6
    return st.withColumns({"gap": gap(), "kind_gap": gap("kind")})


def gestured(st: DataFrame) -> DataFrame:
    """Rows of strokes (t0, t1, f, l, path) with duration, displacement and kind."""
    dx, dy = F.col("l.px") - F.col("f.px"), F.col("l.py") - F.col("f.py")
    st = st.withColumns({"dur": (F.col("t1") - F.col("t0")) / 1e6, "dx": dx, "dy": dy}).withColumn("disp", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")))
    is_ = lambda c: F.coalesce(c, F.lit(False))
    kind = F.when(is_((F.col("dur") >= LONG_PRESS_S) & (F.col("disp") <= MAX_TAP)), "longpress").when(is_(F.col("disp") >= MIN_SWIPE) | is_(F.col("path") >= MIN_SWIPE), "swipe").otherwise("tap")
    return st.withColumn("kind", kind)


def gestures(wd: DataFrame, st: DataFrame) -> DataFrame:
    """Events with their stroke's gesture."""
    return wd.join(st.select(*G, "stroke", "kind"), [*G, "stroke"], "left")


def event_list(cfg: PIConfig) -> list:
    n, T = F.count("*").cast("double"), cfg.window_s
    w, h = cfg.screen_w, cfg.screen_h
    x, y = F.col("px"), F.col("py")
    dx, dy = x - w / 2, y - h / 2
    rx, ry = spread("px", "py")
    share = lambda c: ratio(F.count_if(c), n)
    mx, my = F.avg("px") - w / 2, F.avg("py") - h / 2
    both = x.isNotNull() & y.isNotNull()
    return [
        *stats4("touch_position_x", "px", 0), *stats4("touch_position_y", "py", 0), *stats4("touch_pressure", "p", 0), *scalar4("total_touch_count", n, 0), *scalar4("touch_event_rate", n / T, 0),
        *stats4("touch_pressure_change_rate", F.when(F.col("dt") > 0, F.col("dp")), 0), *scalar4("high_pressure_touch_count", F.count_if(F.col("p") > HARD), 0),
        *stats4("touch_area", "area", 0), *stats4("touch_major_axis", "major", 0), *stats4("touch_minor_axis", "minor", 0), *stats4("touch_area_change_rate", F.when(F.col("dt") > 0, F.col("da")), 0),
        *scalar4("touch_pressure_area_correlation", correlation("p", "area"), 0), *scalar4("high_velocity_touch_count", F.count_if(F.col("v") > FAST), 0), *scalar4("touch_area_slope", slope("area", "s"), 0),
        *scalar4("edge_touch_ratio", share((x < 0.1 * w) | (x > w - 0.1 * w) | (y < 0.1 * h) | (y > h - 0.1 * h)), 0), *scalar4("left_half_touch_ratio", share(x < w / 2), 0),
        *scalar4("right_half_touch_ratio", share(x >= w / 2), 0), *scalar4("top_half_touch_ratio", share(y < h / 2), 0), *scalar4("bottom_half_touch_ratio", share(y >= h / 2), 0),
        *scalar4("central_touch_ratio", share(x.between(w / 3, 2 * w / 3) & y.between(h / 3, 2 * h / 3)), 0), *stats4("touch_offset_to_screen_center", F.sqrt(dx * dx + dy * dy), 0),
        *scalar4("central_bias", F.sqrt(mx * mx + my * my), 0), *scalar4("range_based_touch_dispersion", rx + ry, 0), *scalar4("rms_based_touch_dispersion", rms("px", "py", 0), 0),
        *scalar4("bbox_area_based_touch_dispersion", rx * ry, 0), *scalar4("touch_covariance", F.when(F.count_if(both) >= 2, F.covar_samp(F.when(both, x), F.when(both, y))), 0),
    ]


def event_stats(wd: DataFrame, cfg: PIConfig) -> DataFrame:
    return wd.groupBy(*G).agg(*event_list(cfg))


def stroke_stats(wd: DataFrame, st: DataFrame, cfg: PIConfig) -> DataFrame:
    T = cfg.window_s
    n, events = F.col("n"), F.col("n_event")
    per = st.groupBy(*G).agg(
        F.count("*").alias("n"), *scalar4("first_touch_latency", (F.min("t0") - F.max("w_start")) / 1e6, 0), *scalar4("first_touch_duration", F.min_by("dur", F.struct("t0", "stroke")), 0),
        *(c for k, name in KINDS.items() for c in scalar4(f"{name}_ratio", F.count_if(F.col("kind") == k) / F.count("*"), 0)), *stats4("touch_hold_duration", "dur", 0),
        *(c for k, name in KINDS.items() for c in stats4(f"{name}_duration", F.when(F.col("kind") == k, F.col("dur")), 0)), *stats4("inter_touch_interval", "gap", 0),
        *(c for k, name in KINDS.items() for c in stats4(f"inter_{name}_interval", F.when(F.col("kind") == k, F.col("kind_gap")), 0)),
        *scalar4("active_touch_time", F.sum("dur"), 0), *stats4("touch_stroke_pressure_slope", "p_slope", 0),
    )
    base = wd.groupBy(*G).agg(F.count("*").alias("n_event")).join(per, G, "left").fillna(0, ["n"])
    return base.select(*G, *[c for c in per.columns if c not in (*G, "n")], *scalar4("total_touch_stroke_count", n, 0), *scalar4("touch_stroke_rate", n / T, 0), *scalar4("touch_event_touch_stroke_ratio", ratio(events, n), 0))


def pressures(ge: DataFrame) -> DataFrame:
    return ge.where("kind IS NOT NULL").groupBy(*G).agg(*(c for k, name in KINDS.items() for c in stats4(f"{name}_pressure", F.when(F.col("kind") == k, F.col("p")), 0)))


def with_motion(sw: DataFrame, run, samples: int = 0) -> DataFrame:
    """sw with steps, directions, jerks and turns along an order of stroke and time; jerk and direction run on over the ends of strokes, turns don't."""
    d = lambda c: F.col(c) - F.lag(c).over(run)
    sw = sw.withColumns({"_s": (F.col("t") - F.lag("t").over(run)) / 1e6, "_same": F.coalesce(d("stroke") == 0, F.lit(True)), "_dx": F.coalesce(d("px"), F.lit(0.0)), "_dy": F.coalesce(d("py"), F.lit(0.0))})
    # of the C library, as in SQL: turns of exactly 45 degrees go by the last bit
    sw = sw.withColumn("theta", spectral.direction("_dy", "_dx"))
    if samples:  # a UDF loses how rows are dealt
        sw = dealt(sw, 2 * samples, *G)
    sw = sw.withColumns({f"j{k}": F.when(F.col("_s") > 0, d(f"a{k}") / F.col("_s")) for k in ("", "x", "y")} | {"turn": F.coalesce(d("theta"), F.lit(0.0))})
    # a turn in no time is infinite and takes the mean, std and one extreme with it
    sudden = F.col("_same") & (F.col("_s") == 0) & (F.col("turn") != 0)
    return sw.withColumns({"sudden": sudden, "omega": F.when(F.col("_same") & (F.col("_s") != 0), F.try_divide(F.col("turn"), F.col("_s")))})


def motion_list(of) -> list:
    omega, sudden = of("omega"), of("sudden")
    whole, up, down = f"coalesce(NOT max({sudden}), true)", f"coalesce(max({of('sudden AND turn > 0')}), false)", f"coalesce(max({of('sudden AND turn < 0')}), false)"
    om = (f"CASE WHEN {whole} THEN avg({omega}) END", f"CASE WHEN {whole} THEN stddev_pop({omega}) END", f"CASE WHEN NOT {down} THEN min({omega}) END", f"CASE WHEN NOT {up} THEN max({omega}) END")
    names = [(f"{c}{k}", f"swipe_{n}{'_' + k if k else ''}") for k in ("", "x", "y") for n, c in (("velocity", "v"), ("acceleration", "a"), ("jerk", "j"))]
    return [
        *(c for col, name in names for c in stats4(name, of(col), 0)), *stats4("swipe_direction", of("theta"), 0), *(F.expr(f"{c} AS swipe_angular_velocity_{s}") for c, s in zip(om, STATS, strict=True)),
        *scalar4("swipe_direction_change_count", f"count({of(f'CASE WHEN abs(turn) > {TURN} AND _same THEN 1 END')})", 0),
    ]


def swipe_motion(ge: DataFrame) -> DataFrame:
    """Speeds of swipe events."""
    return with_motion(ge.where("kind = 'swipe'"), by_stroke()).groupBy(*G).agg(*motion_list(only()))


def swipe_shape(ge: DataFrame, st: DataFrame, cfg: PIConfig) -> DataFrame:
    rx, ry = spread("px", "py")
    pts = ge.where("kind = 'swipe'").groupBy(*G).agg(
        *scalar4("range_based_swipe_dispersion", rx + ry, 0), *scalar4("rms_based_swipe_dispersion", rms("px", "py", 0), 0), *scalar4("bbox_area_based_swipe_dispersion", rx * ry, 0),
        *scalar4("swipe_bbox_width", rx, 0), *scalar4("swipe_bbox_height", ry, 0), *scalar4("swipe_bbox_area", rx * ry, 0), *scalar4("swipe_bbox_aspect_ratio", F.when(ry > 0, ratio(rx, ry)), 0),
    )
    sw = st.where("kind = 'swipe'")
    per = sw.groupBy(*G).agg(
        *stats4("swipe_path_length", "path", 0), *stats4("swipe_displacement", "disp", 0), *stats4("swipe_path_curvature", ratio("disp", "path"), 0),
        *scalar4("horizontal_swipe_rate", F.count_if(F.abs("dx") > F.abs("dy")) / cfg.window_s, 0), *scalar4("vertical_swipe_rate", F.count_if(F.abs("dy") > F.abs("dx")) / cfg.window_s, 0),
    )
    ends = sw.select(*G, F.explode(F.array("f", "l")).alias("e")).select(*G, "e.px", "e.py").groupBy(*G).agg(
        *scalar4("range_based_swipe_endpoint_dispersion", rx + ry, 0), *scalar4("rms_based_swipe_endpoint_dispersion", rms("px", "py", 0), 0), *scalar4("bbox_area_based_swipe_endpoint_dispersion", rx * ry, 0),
    )
    return pts.join(per, G).join(ends, G)


def grid_entropy(wd: DataFrame, grid: int = 10) -> DataFrame:
    """Entropy (natural) of a 10 x 10 grid over the events' bounding box; none for a flat box."""
    p = wd.where("px IS NOT NULL AND py IS NOT NULL").withColumns({"_x": F.min("px").over(in_window()), "_y": F.min("py").over(in_window()), "_w": F.max("px").over(in_window()) - F.min("px").over(in_window()), "_h": F.max("py").over(in_window()) - F.min("py").over(in_window())}).where("_w > 0 AND _h > 0")
    at = lambda v, low, size: F.least(F.floor((F.col(v) - F.col(low)) / F.col(size) * grid), F.lit(grid - 1))
    plus = lambda c: F.ln(F.col(c) + 1e-12)
    return geometry.entropy(p, G, F.struct(at("px", "_x", "_w"), at("py", "_y", "_h")), "_e", plus).select(*G, *scalar4("touch_entropy", "_e", 0))


def fractal(ge: DataFrame) -> DataFrame:
    p = ge.where("kind = 'swipe'").select(*G, F.col("px").alias("x"), F.col("py").alias("y"))
    return geometry.grid_dimension(p, G).select(*G, *scalar4("swipe_path_fractal_dimension", "dimension", 0))


def hulls(wd: DataFrame) -> DataFrame:
    p = wd.where("px IS NOT NULL AND py IS NOT NULL").groupBy(*G).agg(F.count("*").alias("_n"), F.collect_list("px").alias("_xs"), F.collect_list("py").alias("_ys")).where("_n >= 3").withColumn("_h", geometry.hull("_xs", "_ys"))
    return p.select(*G, *scalar4("touch_convex_hull_area", "_h.area", 0), *scalar4("touch_convex_hull_perimeter", "_h.perimeter", 0))


def rhythm(wd: DataFrame) -> DataFrame:
    """Spectra of the window's speeds and accelerations at its mean sampling rate."""
    of = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("t", "ord", F.col(c).alias("y"))))), lambda x: x["y"])
    seq = wd.groupBy(*G).agg(of("v").alias("_v"), of("a").alias("_a"), F.try_divide(F.lit(1.0), F.avg(F.when(F.col("dt") > 0, F.col("dt")))).alias("_fs"))
    seq = seq.withColumns({"_rv": spectral.power_rhythm("_v", "_fs"), "_ra": spectral.power_rhythm("_a", "_fs")})
    names = (("rate", "rate"), ("spectral_entropy", "entropy"), ("regularity", "regularity"))
    return seq.select(*G, *(c for kind, col in (("velocity", "_rv"), ("acceleration", "_ra")) for n, f in names for c in scalar4(f"{kind}_rhythm_{n}", F.col(f"{col}.{f}"), 0)))


def traced(wd: DataFrame, samples: int = 0) -> DataFrame:
    """wd with the stroke of every event, its gesture and measures, steps along swipes, and counts of cells; last marks the event that stands for its stroke."""
    of = Window.partitionBy(*G, "stroke")
    run = of.orderBy("t", "ord")
    t = wd.withColumns({"_x": F.col("px") - F.lag("px").over(run), "_y": F.col("py") - F.lag("py").over(run), "last": F.col("stroke").isNotNull() & F.lead(F.lit(1)).over(run).isNull()})
    first, last = (f(F.struct("px", "py"), F.struct("t", "ord")).over(of) for f in (F.min_by, F.max_by))
    t = t.withColumns({
        "t0": F.min("t").over(of), "t1": F.max("t").over(of), "path": F.coalesce(F.sum(F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y"))).over(of), F.lit(0.0)),
        "f": first, "l": last, "p_slope": slope("p", "s").over(of),
    })
    t = gestured(t).withColumn("kind", F.when(F.col("stroke").isNotNull(), F.col("kind")))
    gap = lambda *k: (F.lead("t0").over(Window.partitionBy(*G, "last", *k).orderBy("t0", "stroke")) - F.col("t1")) / 1e6
    t = with_motion(t.withColumns({"gap": gap(), "kind_gap": gap("kind")}), Window.partitionBy(*G, "kind").orderBy("stroke", "t", "ord"), samples)
    both = F.col("px").isNotNull() & F.col("py").isNotNull()
    at = lambda c, over: (F.min(F.when(both, F.col(c))).over(over), F.max(F.when(both, F.col(c))).over(over))
    every, swipes = in_window(), Window.partitionBy(*G, "kind")
    for name, over in (("all", every), ("own", swipes)):
        t = t.withColumns({f"{name}_{c}{i}": v for c in ("px", "py") for i, v in enumerate(at(c, over))})
    place = lambda name, c, n: F.least(F.floor(F.try_divide(F.col(c) - F.col(f"{name}_{c}0"), F.col(f"{name}_{c}1") - F.col(f"{name}_{c}0")) * n), F.lit(n - 1))
    t = t.withColumns({"_cell": F.when(both, F.struct(place("all", "px", 10), place("all", "py", 10)))} | {f"_g{n}": F.when(both, F.struct(place("own", "px", n), place("own", "py", n))) for n in GRIDS})
    return t.withColumns({"_held": F.count("*").over(Window.partitionBy(*G, "_cell")), "_all": F.count("_cell").over(every)})


def stroke_list(T: float) -> list:
    one, count = only("last"), lambda c: f"count(CASE WHEN {c} THEN 1 END)"
    n, kind = count("last"), {k: only(f"last AND kind = '{k}'") for k in KINDS}
    return [
        *scalar4("first_touch_latency", f"(min({one('t0')}) - max(w_start)) / 1e6D", 0), *scalar4("first_touch_duration", f"min_by(dur, {one('struct(t0, stroke)')})", 0),
        *(c for k, name in KINDS.items() for c in scalar4(f"{name}_ratio", quotient(f"count({kind[k]('1')})", n), 0)), *stats4("touch_hold_duration", one("dur"), 0),
        *(c for k, name in KINDS.items() for c in stats4(f"{name}_duration", kind[k]("dur"), 0)), *stats4("inter_touch_interval", one("gap"), 0),
        *(c for k, name in KINDS.items() for c in stats4(f"inter_{name}_interval", kind[k]("kind_gap"), 0)), *scalar4("active_touch_time", f"sum({one('dur')})", 0), *stats4("touch_stroke_pressure_slope", one("p_slope"), 0),
        *scalar4("total_touch_stroke_count", n, 0), *scalar4("touch_stroke_rate", f"{n} / {T}D", 0), *scalar4("touch_event_touch_stroke_ratio", quotient("count(*)", n), 0),
        *(c for k, name in KINDS.items() for c in stats4(f"{name}_pressure", only(f"kind = '{k}'")("p"), 0)),
    ]


def swipe_list(T: float) -> list:
    of, one = only("kind = 'swipe'"), only("last AND kind = 'swipe'")
    rx, ry = extent(of("px")), extent(of("py"))
    ends = {c: (one(f"f.{c}"), one(f"l.{c}")) for c in ("px", "py")}
    ex, ey = (f"(max(greatest({a}, {b})) - min(least({a}, {b})))" for a, b in ends.values())
    spread_ = [both_ways(F.expr(a), F.expr(b)) for a, b in ends.values()]
    flat = "any_value(CASE WHEN kind = 'swipe' THEN own_px1 <= own_px0 OR own_py1 <= own_py0 END, true)"
    hit = lambda n: f"ln(CAST(greatest(size(collect_set({of(f'_g{n}')})), 1) AS DOUBLE))"
    at = [math.log(n) for n in GRIDS]
    mid = sum(at) / len(at)
    dimension = " + ".join(f"{hit(n)} * {(a - mid) / sum((x - mid) ** 2 for x in at)!r}D" for n, a in zip(GRIDS, at, strict=True))
    rate = lambda c: f"count({one(f'CASE WHEN {c} THEN 1 END')}) / {T}D"
    return [
        *motion_list(of), *scalar4("range_based_swipe_dispersion", f"{rx} + {ry}", 0), *scalar4("rms_based_swipe_dispersion", rms(of("px"), of("py"), 0), 0), *scalar4("bbox_area_based_swipe_dispersion", f"{rx} * {ry}", 0),
        *scalar4("swipe_bbox_width", rx, 0), *scalar4("swipe_bbox_height", ry, 0), *scalar4("swipe_bbox_area", f"{rx} * {ry}", 0), *scalar4("swipe_bbox_aspect_ratio", f"CASE WHEN {ry} > 0 THEN {quotient(rx, ry)} END", 0),
        *stats4("swipe_path_length", one("path"), 0), *stats4("swipe_displacement", one("disp"), 0), *stats4("swipe_path_curvature", one(quotient("disp", "path")), 0),
        *scalar4("horizontal_swipe_rate", rate("abs(dx) > abs(dy)"), 0), *scalar4("vertical_swipe_rate", rate("abs(dy) > abs(dx)"), 0),
        *scalar4("range_based_swipe_endpoint_dispersion", f"{ex} + {ey}", 0), *scalar4("rms_based_swipe_endpoint_dispersion", F.sqrt(spread_[0] + spread_[1]), 0), *scalar4("bbox_area_based_swipe_endpoint_dispersion", f"{ex} * {ey}", 0),
        *scalar4("swipe_path_fractal_dimension", f"CASE WHEN count({of('1')}) >= 10 THEN CASE WHEN {flat} THEN 0.0D ELSE {dimension} END END", 0),
    ]


def indicators(samples: DataFrame, cfg: PIConfig) -> DataFrame:
    """sess, win, w_start, w_end and all indicators of every window that holds an event."""
    families = {"_swipe": swipe_list(cfg.window_s)}
    boxed = only("_cell IS NOT NULL AND all_px1 > all_px0 AND all_py1 > all_py0")
    ordered = lambda c: f"transform(array_sort(collect_list(CASE WHEN {c} IS NOT NULL THEN struct(t, ord, {c} AS y) END)), x -> x.y)"
    more = {
        "w_start": "max(w_start)", "w_end": "max(w_end)", "n_samples": "count(*)", "_swipe": "count(CASE WHEN kind = 'swipe' THEN 1 END)", "_pts": "collect_list(CASE WHEN px IS NOT NULL AND py IS NOT NULL THEN struct(px, py) END)",
        "_v": ordered("v"), "_a": ordered("a"), "_fs": "try_divide(1.0D, avg(CASE WHEN dt > 0 THEN dt END))",
    }
    held = traced(windows(samples, cfg), samples.count()).groupBy(*G).agg(
        *families["_swipe"], *event_list(cfg), *stroke_list(cfg.window_s), *scalar4("touch_entropy", f"avg({boxed('-ln(_held / _all + 1e-12D)')})", 0), *(F.expr(f"{x} AS {n}") for n, x in more.items()),
    )
    held = guarded(held, len(G), families).withColumns({"_h": geometry.hull(F.col("_pts.px"), F.col("_pts.py")), "_rv": spectral.power_rhythm("_v", "_fs"), "_ra": spectral.power_rhythm("_a", "_fs")})
    hull = lambda c: f"CASE WHEN size(_pts) >= 3 THEN _h.{c} END"
    names = (("rate", "rate"), ("spectral_entropy", "entropy"), ("regularity", "regularity"))
    return held.select(
        *[c for c in held.columns if c[0] != "_"], *scalar4("touch_convex_hull_area", hull("area"), 0), *scalar4("touch_convex_hull_perimeter", hull("perimeter"), 0),
        *(c for kind, col in (("velocity", "_rv"), ("acceleration", "_ra")) for n, f in names for c in scalar4(f"{kind}_rhythm_{n}", f"{col}.{f}", 0)),
    )
