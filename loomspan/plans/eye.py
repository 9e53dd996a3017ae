"""Eye-tracking indicators (93): gaze samples to one row for each session and window.

All grains stand on the rows of one table: a sample has the step from the one before it, that step's event, and, if it is
its event's last, the event's measures. So the rows of a session are dealt to windows once, window functions follow in one
partitioning, and one aggregation makes all indicators. Events are found inside each window, as a window's edge cuts them. The functions of single families are for queries of these alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions.stats import angular_diff, circular4, extent, guarded, one_more, only, quotient, ratio, rms, scalar4, spread, stats4, unwrapped
from loomspan.operators import geometry
from loomspan.operators.windows import CLIPPED, assign

from .config import PIConfig

G = ["sess", "win"]
MAX_GAP, MIN_FIX, MIN_SAC, BASE_SPEED, MAD_FACTOR, CELL = 200, 100, 15, 3000.0, 6.0, 50.0
AXIS, BACK = math.radians(15), math.radians(20)


def in_order():
    return Window.partitionBy(*G).orderBy("t", "ord")


def in_window():
    return Window.partitionBy(*G)


def windows(samples: DataFrame, cfg: PIConfig) -> DataFrame:
    """Samples dealt to clipped windows, with on (inside the screen, borders included)."""
    on = F.col("x").between(0, cfg.screen_w) & F.col("y").between(0, cfg.screen_h) & ~F.isnan("x") & ~F.isnan("y")
    return assign(samples, "t", CLIPPED, cfg.ms(cfg.window_s), cfg.ms(cfg.stride_s)).withColumn("on", F.coalesce(on, F.lit(False)))


def dwell(windowed: DataFrame, cfg: PIConfig) -> DataFrame:
    """Time spent on and off the screen and in its regions: the step to the next sample, up to 200 ms, goes to the earlier one's place."""
    return with_dwell(windowed).groupBy(*G).agg(*dwell_stats(cfg))


def with_dwell(windowed: DataFrame) -> DataFrame:
    step = F.lead("t").over(in_order()) - F.col("t")
    return windowed.withColumn("d", F.when((step > 0) & (step <= MAX_GAP), step).otherwise(0).cast("double"))


def dwell_stats(cfg: PIConfig) -> list:
    w, h = cfg.screen_w, cfg.screen_h
    regions = {
        "edge": f"x <= {0.1 * w} OR x >= {w - 0.1 * w} OR y <= {0.1 * h} OR y >= {h - 0.1 * h}", "left_half": f"x < {w / 2}", "right_half": f"x >= {w / 2}",
        "top_half": f"y < {h / 2}", "bottom_half": f"y >= {h / 2}", "central": f"x BETWEEN {w / 4} AND {w * 3 / 4} AND y BETWEEN {h / 4} AND {h * 3 / 4}",
    }
    total = lambda c: f"CASE WHEN count(*) >= 2 THEN sum(CASE WHEN {c} THEN d ELSE 0.0D END) END"
    span = "max(w_end) - max(w_start)"
    out = []
    for name, c in (("on_screen", "on"), ("off_screen", "NOT on")):
        out += scalar4(f"{name}_duration", total(c), 1) + scalar4(f"{name}_gaze_ratio", quotient(total(c), span), 1)
    for name, c in regions.items():
        out += scalar4(f"{name}_gaze_ratio", quotient(total(f"on AND ({c})"), span), 1)
    return out


def position_stats(cfg: PIConfig, of) -> list:
    """Of the rows that `of` lets through."""
    dx, dy = f"(x - {cfg.screen_w / 2})", f"(y - {cfg.screen_h / 2})"
    x, y, offset, at = of("x"), of("y"), of(f"sqrt({dx} * {dx} + {dy} * {dy})"), of("struct(t, ord)")
    w, h = extent(x), extent(y)
    first, last = F.min_by(F.struct("x", "y"), F.expr(at)), F.max_by(F.struct("x", "y"), F.expr(at))
    moved = F.sqrt((last["x"] - first["x"]) * (last["x"] - first["x"]) + (last["y"] - first["y"]) * (last["y"] - first["y"]))
    return [
        *stats4("gaze_position_x", x, 1), *stats4("gaze_position_y", y, 1), *scalar4("gaze_path_displacement", moved, 1), *scalar4("gaze_bbox_width", w, 1), *scalar4("gaze_bbox_height", h, 1),
        *scalar4("gaze_bbox_aspect_ratio", quotient(w, h), 1), *scalar4("range_based_gaze_dispersion", f"{w} + {h}", 1), *scalar4("rms_based_gaze_dispersion", rms(x, y, 1), 1),
        *scalar4("bbox_area_based_gaze_dispersion", f"{w} * {h}", 1), *scalar4("gaze_covariance", f"coalesce(covar_samp({x}, {y}), 0.0D)", 1),
        *stats4("gaze_offset_to_screen_center", offset, 1), *scalar4("central_bias", f"1 - {quotient(f'avg({offset})', f'max({offset})')}", 1),
    ]


def positions(windowed: DataFrame, cfg: PIConfig) -> DataFrame:
    """Indicators of on-screen positions alone."""
    return windowed.where("on").groupBy(*G).agg(*position_stats(cfg, only()))


def with_steps(df: DataFrame, run, among=None) -> DataFrame:
    """df with the step from the row before along a window order: t0, x0, y0 and, if it took up to 200 ms (and lies among some rows), speed, its parts and direction."""
    prev = lambda c: F.lag(c).over(run)
    iv = df.withColumns({"t0": prev("t"), "x0": prev("x"), "y0": prev("y")})
    dt, dx, dy = F.col("t") - F.col("t0"), F.col("x") - F.col("x0"), F.col("y") - F.col("y0")
    ok = (dt > 0) & (dt <= MAX_GAP)
    iv = iv.withColumns({"ok": ok if among is None else F.coalesce(ok & among, F.lit(False)), "s": dt / 1000.0, "dx": dx, "dy": dy}).withColumn("dist", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")))
    of = lambda c: F.when(F.col("ok"), F.try_divide(F.col(c), F.col("s")))
    return iv.withColumns({"v": of("dist"), "vx": of("dx"), "vy": of("dy"), "theta": F.when(F.col("ok"), F.atan2("dy", "dx"))})


def intervals(windowed: DataFrame) -> DataFrame:
    """Steps between consecutive on-screen samples of a window, with speed, its parts, direction and derivatives; a step over 200 ms or without time has none."""
    return with_steps(windowed.where("on").select("sess", "win", "w_start", "w_end", "t", "ord", "x", "y"), in_order()).where("t0 IS NOT NULL")


def derived(iv: DataFrame, run) -> DataFrame:
    """Acceleration and jerk of each speed along a window order, by one pass over it: a jerk needs the two rows before."""
    parts, back = ("", "x", "y"), lambda c, n: F.lag(c, n).over(run)
    iv = iv.withColumns({f"_v{k}{n}": back(f"v{k}", n) for k in parts for n in (1, 2)} | {"_s1": back("s", 1)})
    step = lambda a, b, s: F.when(F.col(s) > 0, F.try_divide(F.col(a) - F.col(b), F.col(s)))
    iv = iv.withColumns({f"a{k}": step(f"v{k}", f"_v{k}1", "s") for k in parts} | {f"_a{k}1": step(f"_v{k}1", f"_v{k}2", "_s1") for k in parts})
    iv = iv.withColumns({f"j{k}": step(f"a{k}", f"_a{k}1", "s") for k in parts})
    return iv.drop("_s1", *(c for k in parts for c in (f"_v{k}1", f"_v{k}2", f"_a{k}1")))


def motion_stats(name: str, of, prefix: str = "") -> list:
    return [s for k in ("", "x", "y") for n, c in (("velocity", "v"), ("acceleration", f"{prefix}a"), ("jerk", f"{prefix}j")) for s in stats4(f"{name}_{n}{'_' + k if k else ''}", of(f"{c}{k}"), 1)]


def kinematics(iv: DataFrame, on: DataFrame) -> DataFrame:
    """Speeds, accelerations, jerks and path of the window. A window with on-screen samples has a path of 0 without steps."""
    out = motion_stats("gaze", only())
    path = F.coalesce(F.sum(F.when(F.col("ok"), F.col("dist"))), F.lit(0.0))
    moving = derived(iv, in_order()).groupBy(*G).agg(*out, path.alias("path"))
    base = on.groupBy(*G).agg(F.count("*").alias("_n")).join(moving, G, "left").withColumn("path", F.coalesce("path", F.lit(0.0)))
    return base.select(*G, *[c for c in moving.columns if c not in (*G, "path")], "path", *scalar4("gaze_path_length", "path", 1))


def threshold(iv: DataFrame, over=None) -> DataFrame:
    """iv with thr: a window's adaptive speed threshold from the median and its absolute deviation."""
    over = over or in_window()
    iv = iv.withColumns({"_med": F.median("v").over(over), "_n": F.count("v").over(over)})
    iv = iv.withColumn("_mad", F.median(F.abs(F.col("v") - F.col("_med"))).over(over))
    thr = F.when(F.col("_n") >= 10, F.greatest(F.lit(BASE_SPEED), F.col("_med") + MAD_FACTOR * F.col("_mad"))).when(F.col("_n") > 0, F.greatest(F.lit(BASE_SPEED), F.col("_med"))).otherwise(F.lit(BASE_SPEED))
    return iv.withColumn("thr", thr).drop("_med", "_n", "_mad")


def labelled(iv: DataFrame) -> DataFrame:
    """Valid intervals with their event: kind (fixation or saccade), island, and e_start, e_end; events that are too short are gone."""
    kind = F.when(~F.col("ok"), None).when(F.col("v") > F.col("thr"), "saccade").otherwise("fixation")
    iv = threshold(iv).withColumn("kind", kind).withColumn("_prev", F.lag("kind").over(in_order()))
    iv = iv.withColumn("island", F.sum(F.when(F.col("kind").eqNullSafe(F.col("_prev")), 0).otherwise(1)).over(in_order())).where("ok")
    of = Window.partitionBy(*G, "island")
    iv = iv.withColumns({"e_start": F.min("t0").over(of), "e_end": F.max("t").over(of)})
    span = F.col("e_end") - F.col("e_start")
    return iv.where(((F.col("kind") == "fixation") & (span >= MIN_FIX)) | ((F.col("kind") == "saccade") & (span >= MIN_SAC))).drop("_prev")


def events(lab: DataFrame) -> DataFrame:
    """One row for each event from its samples: an interval gives its first sample, the last one its second too."""
    here = F.struct(F.col("t0").alias("t"), F.col("x0").alias("x"), F.col("y0").alias("y"), F.col("dist").alias("d"))
    there = F.struct("t", "x", "y", F.lit(0.0).alias("d"))
    keys = [*G, "w_start", "w_end", "kind", "island", "e_start", "e_end"]
    pts = lab.select(*keys, F.explode(F.when(F.col("t") == F.col("e_end"), F.array(here, there)).otherwise(F.array(here))).alias("q")).select(*keys, "q.*")
    pts = pts.withColumns({"cx": F.floor(F.col("x") / CELL), "cy": F.floor(F.col("y") / CELL)})
    w, h = spread("x", "y")
    first, last = F.min_by(F.struct("x", "y"), "t"), F.max_by(F.struct("x", "y"), "t")
    ev = pts.groupBy(*keys).agg(
        w.alias("w"), h.alias("h"), rms("x", "y", 1).alias("rms"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.sum("d").alias("path"), first.alias("a"), last.alias("b"),
    )
    ent = geometry.entropy(pts, [*G, "island"], F.struct("cx", "cy"), "entropy")
    ev = ev.join(ent, [*G, "island"]).withColumns({"dur": (F.col("e_end") - F.col("e_start")).cast("double"), "ex": F.col("b.x"), "ey": F.col("b.y"), "dx": F.col("b.x") - F.col("a.x"), "dy": F.col("b.y") - F.col("a.y")})
    ev = ev.withColumns({"disp": F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")), "dir": F.atan2("dy", "dx")})
    of = Window.partitionBy(*G, "kind").orderBy("e_start")
    return ev.withColumns({"gap": (F.lead("e_start").over(of) - F.col("e_end")).cast("double"), "turn": angular_diff(F.col("dir"), F.lag("dir").over(of))})


def shape(kind: str, of=None) -> list:
    """Indicators that fixations and saccades share, of the rows that `of` lets through."""
    k, of = kind, of or only()
    w, h, start = of("w"), of("h"), of("e_start")
    return [
        *stats4(f"{k}_duration", of("dur"), 1), *stats4(f"{k}_bbox_width", w, 1), *stats4(f"{k}_bbox_height", h, 1), *stats4(f"{k}_bbox_aspect_ratio", quotient(w, "h"), 1),
        *stats4(f"range_based_{k}_dispersion", of("w + h"), 1), *stats4(f"rms_based_{k}_dispersion", of("rms"), 1), *stats4(f"bbox_area_based_{k}_dispersion", of("w * h"), 1),
        *stats4(f"{k}_entropy", of("entropy"), 1), *stats4(f"inter_{k}_interval", of("gap"), 1), *scalar4(f"first_{k}_latency", f"min({start}) - max(w_start)", 1), *scalar4(f"first_{k}_duration", f"min_by(dur, {start})", 1),
    ]


def points(prefix: str, x: str, y: str) -> list:
    w, h = extent(x), extent(y)
    name = prefix.removesuffix("_dispersion")
    return [
        *scalar4(f"range_based_{name}_dispersion", f"{w} + {h}", 1), *scalar4(f"rms_based_{name}_dispersion", rms(x, y, 1), 1), *scalar4(f"bbox_area_based_{name}_dispersion", f"{w} * {h}", 1),
        *scalar4(f"{name}_covariance", f"coalesce(covar_samp({x}, {y}), 0.0D)", 1),
    ]


def drift_stats(of) -> list:
    return [s for k in ("", "x", "y") for s in stats4(f"fixational_drift_velocity{'_' + k if k else ''}", of(f"v{k}"), 1)]


def fixations(ev: DataFrame) -> DataFrame:
    f = ev.where("kind = 'fixation'").groupBy(*G).agg(*shape("fixation"), *points("fixation_centroid", "mx", "my"), F.count("*").alias("n_fix"), F.collect_list("mx").alias("_xs"), F.collect_list("my").alias("_ys"))
    h = f.withColumn("_hull", geometry.hull("_xs", "_ys"))
    return h.select(*[c for c in f.columns if c[0] != "_"], *scalar4("fixation_convex_hull_area", "_hull.area", 1), *scalar4("fixation_convex_hull_perimeter", "_hull.perimeter", 1))


def drift(lab: DataFrame) -> DataFrame:
    return lab.where("kind = 'fixation'").groupBy(*G).agg(*drift_stats(only()))


def saccade_stats(of) -> list:
    """Of the saccades that `of` lets through."""
    back = f"count({of(f'CASE WHEN abs(turn - pi()) < {BACK} THEN 1 END')})"
    seconds, n, one = "(max(w_end) - max(w_start)) / 1000.0D", f"count({of('1')})", F.expr(of("1"))
    near = lambda a: F.count_if((one == 1) & ((angular_diff(F.col("dir"), F.lit(a)) < AXIS) | (angular_diff(F.col("dir"), F.lit(a + math.pi)) < AXIS)))
    two = lambda c: f"CASE WHEN {n} >= 2 THEN {c} END"
    return [
        *shape("saccade", of), *points("saccade_endpoint", of("ex"), of("ey")), *stats4("saccade_displacement", of("disp"), 1), *circular4("saccade_direction", of("dir")),
        *stats4("saccade_path_length", of("path"), 1), *stats4("saccade_path_curvature", quotient(of("path"), "disp"), 1),
        *scalar4("horizontal_saccade_rate", ratio(near(0.0), seconds), 1), *scalar4("vertical_saccade_rate", ratio(near(math.pi / 2), seconds), 1),
        *scalar4("backtrack_saccade_rate", two(quotient(back, f"sum({of('dur')}) / 1000.0D")), 1), *scalar4("backtrack_saccade_ratio", two(quotient(back, n)), 1),
    ]


def saccades(ev: DataFrame) -> DataFrame:
    return ev.where("kind = 'saccade'").groupBy(*G).agg(*saccade_stats(only()), F.count("*").alias("n_sac"))


def with_saccade_motion(lab: DataFrame, run) -> DataFrame:
    """lab with derivatives (sa*, sj*) and turns per second (omega) along an order that ends with each event."""
    step = lambda c: F.when(F.col("s") > 0, F.try_divide(F.col(c) - F.lag(c).over(run), F.col("s")))
    lab = lab.withColumns({f"sa{k}": step(f"v{k}") for k in ("", "x", "y")} | {"_turn": F.col("theta") - F.lag("theta").over(run)})
    return lab.withColumns({f"sj{k}": step(f"sa{k}") for k in ("", "x", "y")} | {"omega": F.try_divide(unwrapped(F.col("_turn")), F.col("s"))})


def saccade_motion(lab: DataFrame) -> DataFrame:
    """Speeds inside saccades; derivatives don't reach over a saccade's ends."""
    s = with_saccade_motion(lab.where("kind = 'saccade'"), Window.partitionBy(*G, "island").orderBy("t", "ord"))
    return s.groupBy(*G).agg(*motion_stats("saccade", only(), "s"), *stats4("saccade_angular_velocity", "omega", 1))


def with_path(df: DataFrame, keys: list[str]) -> DataFrame:
    """df with the counts of the rows' cells in the scanpath of their group."""
    path = geometry.with_recurrence(df, keys, ["t", "ord"], geometry.cell("x", "y", CELL))
    return path.withColumns({"_held": F.count("*").over(Window.partitionBy(*keys, "_item")), "_all": F.count("*").over(Window.partitionBy(*keys))})


def path_stats(of) -> list:
    """Entropy, fractal dimension and recurrence of the cells of the rows that `of` lets through: a row's share of a sum over cells is its own count's."""
    rate, determinism = geometry.recurrence_of(of)
    return [
        *scalar4("gaze_entropy", f"avg({of('-log2(_held / _all)')})", 1), *scalar4("scanpath_fractal_dimension", geometry.box_slope("x", "y", of), 1),
        *scalar4("scanpath_revisit_ratio", rate, 1), *scalar4("scanpath_determinism_ratio", determinism, 1),
    ]


def scanpath(on: DataFrame) -> DataFrame:
    return with_path(on.select(*G, "t", "ord", "x", "y"), G).groupBy(*G).agg(*path_stats(only()))


def rate_stats(n_fix, n_sac, seconds) -> list:
    return [*scalar4("fixation_rate", quotient(n_fix, seconds), 1), *scalar4("saccade_rate", quotient(n_sac, seconds), 1), *scalar4("fixation_saccade_ratio", quotient(n_fix, n_sac), 1)]


def rates(on: DataFrame, fix: DataFrame, sac: DataFrame) -> DataFrame:
    """Counts of events over the window: zero, not null, where on-screen samples have none."""
    base = on.groupBy(*G).agg(F.max("w_start").alias("w_start"), F.max("w_end").alias("w_end"))
    n = base.join(fix.select(*G, "n_fix"), G, "left").join(sac.select(*G, "n_sac"), G, "left").fillna(0, ["n_fix", "n_sac"])
    return n.select(*G, *rate_stats("n_fix", "n_sac", "(w_end - w_start) / 1000.0D"))


def traced(windowed: DataFrame) -> DataFrame:
    """windowed with the step, event and event measures of every row. kind is that of the row's event; last marks an event's last row, whose measures count."""
    on = Window.partitionBy(*G, "on")
    run = on.orderBy("t", "ord")
    t = threshold(derived(with_steps(with_dwell(windowed), run, F.col("on")), run), on)
    t = t.withColumn("kind", F.when(F.col("ok"), F.when(F.col("v") > F.col("thr"), "saccade").otherwise("fixation")))
    t = t.withColumns({"_k1": F.lag("kind").over(run), "_k2": F.lag("kind", 2).over(run), "_th1": F.lag("theta").over(run)})
    t = t.withColumn("island", F.sum(F.when(F.col("kind").eqNullSafe(F.col("_k1")), 0).otherwise(1)).over(run))
    # an event is a run of rows, so its derivatives are the window's where the rows before belong to it too
    one = F.coalesce(F.col("kind") == F.col("_k1"), F.lit(False))
    two = one & F.coalesce(F.col("_k1") == F.col("_k2"), F.lit(False))
    inside = {f"s{c}{k}": F.when(rows, F.col(f"{c}{k}")) for c, rows in (("a", one), ("j", two)) for k in ("", "x", "y")}
    turn = F.when(one, F.col("theta") - F.col("_th1"))
    return event_measures(t.withColumns({**inside, "omega": F.try_divide(unwrapped(turn), F.col("s"))}).drop("_k1", "_k2", "_th1"))


def event_measures(t: DataFrame) -> DataFrame:
    """The measures of events on their rows: an event's points are its steps' first samples and the last one's second. Rows are sorted once, by event and cell."""
    of = Window.partitionBy(*G, "on", "island")
    place = lambda x, y: F.struct(F.floor(F.col(x) / CELL), F.floor(F.col(y) / CELL))
    t = t.withColumn("_cell", place("x0", "y0")).withColumn("_c", F.count("*").over(Window.partitionBy(*G, "on", "island", "_cell")))
    low_high = {f"_{f.__name__}_{c}": f(f"{c}0").over(of) for c in "xy" for f in (F.min, F.max, F.sum, F.var_pop, F.avg)}
    ends = {"_a": F.min_by(F.struct("x0", "y0"), "t").over(of), "_z": F.max_by(F.struct("x", "y"), "t").over(of)}
    t = t.withColumns({"e_start": F.min("t0").over(of), "e_end": F.max("t").over(of), "_n": F.count("*").over(of), "path": F.sum("dist").over(of), **low_high, **ends})
    least = F.when(F.col("kind") == "fixation", MIN_FIX).when(F.col("kind") == "saccade", MIN_SAC)
    t = t.withColumn("kind", F.when(F.col("e_end") - F.col("e_start") >= least, F.col("kind")))
    t = t.withColumns({"last": F.col("kind").isNotNull() & (F.col("t") == F.col("e_end")), "ex": F.when(F.col("kind").isNotNull(), F.col("_z.x")), "ey": F.when(F.col("kind").isNotNull(), F.col("_z.y"))})
    here = F.col("_cell") == place("ex", "ey")
    bits = lambda c: -F.log2(c / (F.col("_n") + 1))
    own = F.sum(bits(F.col("_c") + here.cast("int"))).over(of) + bits(F.count_if(here).over(of) + 1)
    t = t.withColumn("entropy", own / (F.col("_n") + 1) + 0.0)
    spans = {k: F.greatest(f"_max_{c}", f"e{c}") - F.least(f"_min_{c}", f"e{c}") for k, c in (("w", "x"), ("h", "y"))}
    means = {f"m{c}": (F.col(f"_sum_{c}") + F.col(f"e{c}")) / (F.col("_n") + 1) for c in "xy"}
    spread_ = [one_more(F.col(f"_var_pop_{c}"), F.col(f"_avg_{c}"), F.col("_n"), F.col(f"e{c}")) for c in "xy"]
    dx, dy = F.col("ex") - F.col("_a.x0"), F.col("ey") - F.col("_a.y0")
    t = t.withColumns({**spans, **means, "rms": F.sqrt(spread_[0] + spread_[1]), "dur": (F.col("e_end") - F.col("e_start")).cast("double"), "disp": F.sqrt(dx * dx + dy * dy), "dir": F.atan2(dy, dx)})
    t = t.drop(*(c for c in t.columns if c[0] == "_"))
    nxt = Window.partitionBy(*G, "kind", "last").orderBy("e_start")
    return t.withColumns({"gap": (F.lead("e_start").over(nxt) - F.col("e_end")).cast("double"), "turn": angular_diff(F.col("dir"), F.lag("dir").over(nxt))})


def indicators(samples: DataFrame, cfg: PIConfig) -> DataFrame:
    """sess, win, w_start, w_end and all indicators of every window that holds a sample."""
    wd = windows(samples, cfg)
    on, (fix, sac), (in_fix, in_sac) = only("on"), (only(f"last AND kind = '{k}'") for k in ("fixation", "saccade")), (only(f"kind = '{k}'") for k in ("fixation", "saccade"))
    count = lambda of: f"count({of('1')})"
    path = "coalesce(sum(CASE WHEN ok THEN dist END), 0.0D)"
    families = {
        "_on": [*position_stats(cfg, on), *motion_stats("gaze", only()), *scalar4("gaze_path_length", path, 1), *rate_stats(count(fix), count(sac), "(max(w_end) - max(w_start)) / 1000.0D")],
        "_fix": [*shape("fixation", fix), *points("fixation_centroid", fix("mx"), fix("my")), *drift_stats(in_fix)],
        "_sac": [*saccade_stats(sac), *motion_stats("saccade", in_sac, "s"), *stats4("saccade_angular_velocity", in_sac("omega"), 1)],
    }
    more = {
        "w_start": "max(w_start)", "w_end": "max(w_end)", "n_samples": "count(*)", "_on": count(on), "_fix": count(fix), "_sac": count(sac), "_points": f"collect_list({fix('struct(mx, my)')})",
        "_path": f"array_sort(collect_list({on('struct(t, ord, x, y)')}))",
    }
    held = traced(wd).groupBy(*G).agg(*(c for part in families.values() for c in part), *dwell_stats(cfg), *(F.expr(f"{x} AS {n}") for n, x in more.items()))
    held = guarded(held, len(G), families).withColumns({"_hull": geometry.hull(F.col("_points.mx"), F.col("_points.my")), "_scan": geometry.scanpath(F.col("_path.x"), F.col("_path.y"), F.lit(CELL))})
    some = lambda c: F.when(F.col("_fix") > 0, F.col(c))
    scan = {"gaze_entropy": "entropy", "scanpath_fractal_dimension": "dimension", "scanpath_revisit_ratio": "rate", "scanpath_determinism_ratio": "determinism"}
    return held.select(
        *[c for c in held.columns if c[0] != "_"], *(c for n, f in scan.items() for c in scalar4(n, f"_scan.{f}", 1)), *scalar4("gaze_path_curvature", ratio("gaze_path_length_mean", "gaze_path_displacement_mean"), 1),
        *scalar4("fixation_convex_hull_area", some("_hull.area"), 1), *scalar4("fixation_convex_hull_perimeter", some("_hull.perimeter"), 1),
    )
