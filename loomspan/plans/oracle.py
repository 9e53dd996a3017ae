"""DuckDB SQL of the registered queries: windows by range joins, statistics by plain aggregates."""

from __future__ import annotations

PI = "pi()"


def fin(e: str) -> str:
    return f"CASE WHEN isfinite(({e})::DOUBLE) THEN ({e})::DOUBLE END"


def rd(e: str) -> str:
    """Rounded as catalogue.rounded() does."""
    return f"round(({e})::DOUBLE, 9)::FLOAT::DOUBLE + 0.0"


def st(name: str, e: str, ddof: int) -> str:
    v = fin(e)
    return f"{rd(f'avg({v})')} AS {name}_mean, {rd(f'{"stddev_samp" if ddof else "stddev_pop"}({v})')} AS {name}_std, {rd(f'min({v})')} AS {name}_min, {rd(f'max({v})')} AS {name}_max"


def sc(name: str, e: str, ddof: int) -> str:
    v = rd(fin(e))
    std = "NULL::DOUBLE" if ddof else f"CASE WHEN ({v}) IS NOT NULL THEN 0.0::DOUBLE END"
    return f"{v} AS {name}_mean, {std} AS {name}_std, {v} AS {name}_min, {v} AS {name}_max"


def cols(*parts: str) -> str:
    return ",\n  ".join(parts)


def query(base: str, select: str, source: str, group: bool = True) -> str:
    return f"WITH {base}\nSELECT sess, win,\n  {select}\nFROM {source}{' GROUP BY sess, win' if group else ''}"


EVENTS = "e AS (SELECT *, (props->>'k')::INT AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)"


def hop(table: str, t: str, policy: str, size: int, stride: int, end: str | None = None) -> str:
    """b (anchors), w (windows) and d (samples in windows) by a range join."""
    n = f"floor((t_max - t0) / {float(stride)})::BIGINT + 1" if policy == "nonempty" else f"ceil((t_max - t0) / {float(stride)})::BIGINT"
    stop = f"least(w0 + {size}, t_max)" if policy == "clipped" else f"w0 + {size}"
    number = "dense_rank() OVER (PARTITION BY sess ORDER BY w0)::INT" if policy == "nonempty" else "k"
    return f"""b AS (SELECT sess, min({t}) AS t0, max({end or t}) AS t_max FROM {table} GROUP BY sess),
w0 AS (SELECT sess, t0 + i * {stride} AS w0, (i + 1)::INT AS k, t_max FROM (SELECT *, unnest(range(0, greatest({n}, 0))) AS i FROM b)),
w AS (SELECT sess, k, w0, w0 AS w_start, {stop} AS w_end FROM w0),
dd AS (SELECT s.*, w.w0, w.k, w_start, w_end FROM {table} s JOIN w ON s.sess = w.sess AND s.{t} >= w_start AND s.{t} < w_end),
d AS (SELECT * EXCLUDE (k, w0), {number} AS win FROM dd)"""


GAZE = f"""{EVENTS},
g0 AS (SELECT *, (rn // 8) * 2 + (rn % 8 = 7)::INT AS blk, 1700000000000 + sum(20 + k + CASE WHEN event_type = 'signup' AND k < 10 THEN 400 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY rn) AS t FROM e),
g AS (SELECT user_id AS sess, rn AS ord, t::BIGINT AS t, (blk * 389 + user_id * 97) % 1500 - 20 + value / 50 AS x, ((blk * 211 + user_id * 53) % 940 - 10 + k % 11)::DOUBLE AS y FROM g0),
{hop("g", "t", "clipped", 2000, 1000)},
o AS (SELECT * FROM d WHERE x BETWEEN 0 AND 1440 AND y BETWEEN 0 AND 900)"""
INTERVALS = f"""{GAZE},
i0 AS (SELECT *, lag(t) OVER q AS t0, lag(x) OVER q AS x0, lag(y) OVER q AS y0 FROM o WINDOW q AS (PARTITION BY sess, win ORDER BY t, ord)),
i1 AS (SELECT *, t - t0 > 0 AND t - t0 <= 200 AS ok, (t - t0) / 1000.0::DOUBLE AS s, sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0)) AS dist FROM i0 WHERE t0 IS NOT NULL),
i2 AS (SELECT *, CASE WHEN ok THEN dist / s END AS v, CASE WHEN ok THEN (x - x0) / s END AS vx, CASE WHEN ok THEN (y - y0) / s END AS vy, CASE WHEN ok THEN atan2(y - y0, x - x0) END AS th FROM i1),
i3 AS (SELECT *, CASE WHEN s > 0 THEN (v - lag(v) OVER q) / s END AS a, CASE WHEN s > 0 THEN (vx - lag(vx) OVER q) / s END AS ax, CASE WHEN s > 0 THEN (vy - lag(vy) OVER q) / s END AS ay FROM i2 WINDOW q AS (PARTITION BY sess, win ORDER BY t, ord)),
iv AS (SELECT *, CASE WHEN s > 0 THEN (a - lag(a) OVER q) / s END AS j, CASE WHEN s > 0 THEN (ax - lag(ax) OVER q) / s END AS jx, CASE WHEN s > 0 THEN (ay - lag(ay) OVER q) / s END AS jy FROM i3 WINDOW q AS (PARTITION BY sess, win ORDER BY t, ord))"""
THRESHOLD = f"""{INTERVALS},
m1 AS (SELECT sess, win, median(v) AS med, count(v) AS n FROM iv GROUP BY ALL),
m2 AS (SELECT sess, win, median(abs(v - med)) AS mad FROM iv JOIN m1 USING (sess, win) GROUP BY ALL),
th AS (SELECT sess, win, CASE WHEN n >= 10 THEN greatest(3000.0, med + 6 * mad) WHEN n > 0 THEN greatest(3000.0, med) ELSE 3000.0 END AS thr FROM m1 JOIN m2 USING (sess, win))"""
SEGMENTS = f"""{THRESHOLD},
l0 AS (SELECT iv.*, CASE WHEN NOT ok THEN NULL WHEN v > thr THEN 'saccade' ELSE 'fixation' END AS kind FROM iv JOIN th USING (sess, win)),
l1 AS (SELECT *, CASE WHEN kind IS NOT DISTINCT FROM lag(kind) OVER q AND row_number() OVER q > 1 THEN 0 ELSE 1 END AS new FROM l0 WINDOW q AS (PARTITION BY sess, win ORDER BY t, ord)),
l2 AS (SELECT *, sum(new) OVER (PARTITION BY sess, win ORDER BY t, ord) AS isl FROM l1),
l3 AS (SELECT *, min(t0) OVER z AS es, max(t) OVER z AS ee FROM l2 WHERE ok WINDOW z AS (PARTITION BY sess, win, isl)),
lab AS (SELECT * FROM l3 WHERE kind = 'fixation' AND ee - es >= 100 OR kind = 'saccade' AND ee - es >= 15),
pts AS (SELECT sess, win, w_start, w_end, kind, isl, es, ee, t0 AS t, x0 AS x, y0 AS y, dist AS dd FROM lab UNION ALL SELECT sess, win, w_start, w_end, kind, isl, es, ee, t, x, y, 0 FROM lab WHERE t = ee),
en AS (SELECT sess, win, isl, sum(-p * log2(p)) AS ent FROM (SELECT sess, win, isl, count(*) / sum(count(*)) OVER (PARTITION BY sess, win, isl) AS p FROM pts GROUP BY sess, win, isl, floor(x / 50), floor(y / 50)) GROUP BY ALL),
ev0 AS (SELECT sess, win, w_start, w_end, kind, isl, es, ee, max(x) - min(x) AS w, max(y) - min(y) AS h, sqrt(coalesce(var_samp(x), 0) + coalesce(var_samp(y), 0)) AS rms, avg(x) AS mx, avg(y) AS my, sum(dd) AS path,
  arg_min(x, t) AS ax, arg_min(y, t) AS ay, arg_max(x, t) AS ex, arg_max(y, t) AS ey FROM pts GROUP BY ALL),
ev1 AS (SELECT *, (ee - es)::DOUBLE AS dur, sqrt((ex - ax) * (ex - ax) + (ey - ay) * (ey - ay)) AS disp, atan2(ey - ay, ex - ax) AS dir FROM ev0 JOIN en USING (sess, win, isl)),
ev AS (SELECT *, lead(es) OVER q - ee AS gap, abs((dir - lag(dir) OVER q + pi()) - 2 * pi() * floor((dir - lag(dir) OVER q + pi()) / (2 * pi())) - pi()) AS turn FROM ev1 WINDOW q AS (PARTITION BY sess, win, kind ORDER BY es))"""


def xyz(prefix: str, stem: str) -> list[str]:
    return [st(f"{prefix}_{stem}{s}", f"{stem[0]}{c}", 1) for s, c in (("", ""), ("_x", "x"), ("_y", "y"))]


def shape(k: str) -> list[str]:
    return [
        st(f"{k}_duration", "dur", 1), st(f"{k}_bbox_width", "w", 1), st(f"{k}_bbox_height", "h", 1), st(f"{k}_bbox_aspect_ratio", "w / nullif(h, 0)", 1), st(f"range_based_{k}_dispersion", "w + h", 1),
        st(f"rms_based_{k}_dispersion", "rms", 1), st(f"bbox_area_based_{k}_dispersion", "w * h", 1), st(f"{k}_entropy", "ent", 1),
        sc(f"first_{k}_latency", "min(es) - max(w_start)", 1), sc(f"first_{k}_duration", "arg_min(dur, es)", 1),
    ]


def cloud(name: str, x: str, y: str) -> list[str]:
    w, h = f"(max({x}) - min({x}))", f"(max({y}) - min({y}))"
    return [
        sc(f"range_based_{name}_dispersion", f"{w} + {h}", 1), sc(f"rms_based_{name}_dispersion", f"sqrt(coalesce(var_samp({x}), 0) + coalesce(var_samp({y}), 0))", 1),
        sc(f"bbox_area_based_{name}_dispersion", f"{w} * {h}", 1), sc(f"{name}_covariance", f"coalesce(covar_samp({x}, {y}), 0)", 1),
    ]


def angle(a: str, b: str) -> str:
    return f"abs(({a} - {b} + pi()) - 2 * pi() * floor(({a} - {b} + pi()) / (2 * pi())) - pi())"


def eye() -> dict[str, str]:
    near = lambda a: f"({angle('dir', a)} < radians(15) OR {angle('dir', f'({a} + pi())')} < radians(15))"
    sec = "(max(w_end) - max(w_start)) / 1000.0"
    dw = lambda c: f"CASE WHEN count(*) >= 2 THEN sum(CASE WHEN {c} THEN dw ELSE 0 END) END"
    span = "(max(w_end) - max(w_start))"
    on = "coalesce(x BETWEEN 0 AND 1440 AND y BETWEEN 0 AND 900, false)"
    regions = {"edge": "(x <= 144 OR x >= 1296 OR y <= 90 OR y >= 810)", "left_half": "x < 720", "right_half": "x >= 720", "top_half": "y < 450", "bottom_half": "y >= 450", "central": "x BETWEEN 360 AND 1080 AND y BETWEEN 225 AND 675"}
    off = "sqrt((x - 720) * (x - 720) + (y - 450) * (y - 450))"
    w, h = "(max(x) - min(x))", "(max(y) - min(y))"
    fx, fy, lx, ly = (f"arg_{f}({c}, t * 1000000 + ord)" for f in ("min", "max") for c in ("x", "y"))
    path = f"{GAZE.replace('o AS', 'o AS', 1)}"
    circ = "(dir + pi()) - 2 * pi() * floor((dir + pi()) / (2 * pi())) - pi()"
    r = "least(sqrt(avg(cos(dir)) * avg(cos(dir)) + avg(sin(dir)) * avg(sin(dir))), 1.0)"
    turn = "(dt + pi()) - 2 * pi() * floor((dt + pi()) / (2 * pi())) - pi()"
    return {
        "win_clipped": f"WITH {path} SELECT sess, k AS win, w_start, w_end, (SELECT count(*) FROM g WHERE g.sess = w.sess AND t >= w_start AND t < w_end) AS n FROM w",
        "eye_position_velocity": query(INTERVALS + f", p AS (SELECT sess, win, {cols(st('gaze_position_x', 'x', 1), st('gaze_position_y', 'y', 1))} FROM o GROUP BY ALL), q AS (SELECT sess, win, {cols(*xyz('gaze', 'velocity'), *xyz('gaze', 'acceleration'))} FROM iv GROUP BY ALL)", "p.* EXCLUDE (sess, win), q.* EXCLUDE (sess, win)", "p LEFT JOIN q USING (sess, win)", False),
        "eye_jerk": query(INTERVALS, cols(*xyz("gaze", "jerk")), "iv"),
        "eye_path_bbox_dispersion": query(
            INTERVALS + f""", p AS (SELECT sess, win, {w} AS w, {h} AS h, sqrt(coalesce(var_samp(x), 0) + coalesce(var_samp(y), 0)) AS rms, coalesce(covar_samp(x, y), 0) AS cov,
  sqrt(({lx} - {fx}) * ({lx} - {fx}) + ({ly} - {fy}) * ({ly} - {fy})) AS disp FROM o GROUP BY ALL),
q AS (SELECT sess, win, sum(CASE WHEN ok THEN dist END) AS path FROM iv GROUP BY ALL), r AS (SELECT p.*, coalesce(path, 0) AS path FROM p LEFT JOIN q USING (sess, win))""",
            cols(sc("gaze_path_length", "path", 1), sc("gaze_path_displacement", "disp", 1), sc("gaze_path_curvature", "path / nullif(disp, 0)", 1), sc("gaze_bbox_width", "w", 1), sc("gaze_bbox_height", "h", 1), sc("gaze_bbox_aspect_ratio", "w / nullif(h, 0)", 1),
                 sc("range_based_gaze_dispersion", "w + h", 1), sc("rms_based_gaze_dispersion", "rms", 1), sc("bbox_area_based_gaze_dispersion", "w * h", 1), sc("gaze_covariance", "cov", 1)), "r", False),
        "eye_entropy": query(GAZE + ", c AS (SELECT sess, win, count(*) / sum(count(*)) OVER (PARTITION BY sess, win) AS p FROM o GROUP BY sess, win, floor(x / 50), floor(y / 50))", sc("gaze_entropy", "sum(-p * log2(p))", 1), "c"),
        "eye_fractal": query(GAZE + ", c AS (SELECT sess, win, s, count(DISTINCT (floor(x / s), floor(y / s))) AS n, count(*) AS m FROM o, (VALUES (4), (8), (16), (32), (64), (128), (256)) v(s) GROUP BY ALL)", sc("scanpath_fractal_dimension", "CASE WHEN max(m) >= 2 THEN regr_slope(ln(n), ln(1.0 / s)) END", 1), "c"),
        "eye_rqa": query(GAZE + """, p AS (SELECT sess, win, row_number() OVER (PARTITION BY sess, win ORDER BY t, ord) AS i, floor(x / 50) * 100000 + floor(y / 50) AS c FROM o),
m AS (SELECT a.sess, a.win, a.i, b.i AS j FROM p a JOIN p b ON a.sess = b.sess AND a.win = b.win AND a.c = b.c),
l AS (SELECT m.*, EXISTS (SELECT 1 FROM m n WHERE n.sess = m.sess AND n.win = m.win AND (n.i = m.i + 1 AND n.j = m.j + 1 OR n.i = m.i - 1 AND n.j = m.j - 1)) AS line FROM m)""",
            cols(sc("scanpath_revisit_ratio", "count(*) / (max(i) * max(i))", 1), sc("scanpath_determinism_ratio", "sum(line::INT) / count(*)", 1)), "l"),
        "eye_dwell_regions": query(GAZE + ", n AS (SELECT *, CASE WHEN lead(t) OVER q - t BETWEEN 1 AND 200 THEN lead(t) OVER q - t ELSE 0 END AS dw FROM d WINDOW q AS (PARTITION BY sess, win ORDER BY t, ord))",
            cols(*(x for n, c in (("on_screen", on), ("off_screen", f"NOT {on}")) for x in (sc(f"{n}_duration", dw(c), 1), sc(f"{n}_gaze_ratio", f"{dw(c)} / {span}", 1))), *(sc(f"{n}_gaze_ratio", f"{dw(f'{on} AND {c}')} / {span}", 1) for n, c in regions.items())), "n"),
        "eye_center_bias": query(GAZE, cols(st("gaze_offset_to_screen_center", off, 1), sc("central_bias", f"1 - avg({off}) / nullif(max({off}), 0)", 1)), "o"),
        "eye_threshold": query(THRESHOLD, f"{rd('thr')} AS thr", "th", False),
        "eye_fixations": query(SEGMENTS, cols(*shape("fixation")), "ev WHERE kind = 'fixation'"),
        "eye_saccades": query(SEGMENTS + """, z0 AS (SELECT *, lag(v) OVER q AS pv, lag(vx) OVER q AS pvx, lag(vy) OVER q AS pvy, th - lag(th) OVER q AS dt FROM lab WHERE kind = 'saccade' WINDOW q AS (PARTITION BY sess, win, isl ORDER BY t, ord)),
z1 AS (SELECT * EXCLUDE (a, ax, ay, j, jx, jy), (v - pv) / s AS a, (vx - pvx) / s AS ax, (vy - pvy) / s AS ay FROM z0),
z2 AS (SELECT *, (a - lag(a) OVER q) / s AS j, (ax - lag(ax) OVER q) / s AS jx, (ay - lag(ay) OVER q) / s AS jy FROM z1 WINDOW q AS (PARTITION BY sess, win, isl ORDER BY t, ord)),
""" + f"z AS (SELECT sess, win, {cols(*xyz('saccade', 'velocity'), *xyz('saccade', 'acceleration'), *xyz('saccade', 'jerk'), st('saccade_angular_velocity', f'CASE WHEN abs(dt) < pi() THEN dt ELSE {turn} END / s', 1))} FROM z2 GROUP BY ALL), "
            + f"""y AS (SELECT sess, win, {cols(*shape('saccade'), st('saccade_displacement', 'disp', 1), st('saccade_path_length', 'path', 1), st('saccade_path_curvature', 'path / nullif(disp, 0)', 1))},
  {rd('atan2(avg(sin(dir)), avg(cos(dir)))')} AS saccade_direction_mean, {rd(f'CASE WHEN count(*) < 2 THEN NULL WHEN {r} <= 0 THEN pi() / sqrt(3) ELSE sqrt(-2 * ln({r})) END')} AS saccade_direction_std, {rd(f'min({circ})')} AS saccade_direction_min, {rd(f'max({circ})')} AS saccade_direction_max,
  {cols(sc('horizontal_saccade_rate', f'count(*) FILTER (WHERE {near("0.0")}) / ({sec})', 1), sc('vertical_saccade_rate', f'count(*) FILTER (WHERE {near("pi() / 2")}) / ({sec})', 1))} FROM ev WHERE kind = 'saccade' GROUP BY ALL)""",
            "y.* EXCLUDE (sess, win), z.* EXCLUDE (sess, win)", "y JOIN z USING (sess, win)", False),
        "eye_event_geometry": query(SEGMENTS + f", f AS (SELECT sess, win, {cols(*cloud('fixation_centroid', 'mx', 'my'))} FROM ev WHERE kind = 'fixation' GROUP BY ALL), s AS (SELECT sess, win, {cols(*cloud('saccade_endpoint', 'ex', 'ey'))} FROM ev WHERE kind = 'saccade' GROUP BY ALL)", "f.* EXCLUDE (sess, win), s.* EXCLUDE (sess, win)", "f FULL JOIN s USING (sess, win)", False),
        "eye_intervals_backtrack": query(SEGMENTS + f""", c AS (SELECT sess, win, max(w_end) - max(w_start) AS span FROM o GROUP BY ALL),
n AS (SELECT sess, win, count(*) FILTER (WHERE kind = 'fixation') AS nf, count(*) FILTER (WHERE kind = 'saccade') AS ns FROM ev GROUP BY ALL),
k AS (SELECT sess, win, {cols(st('inter_fixation_interval', "CASE WHEN kind = 'fixation' THEN gap END", 1), st('inter_saccade_interval', "CASE WHEN kind = 'saccade' THEN gap END", 1))},
  count(*) FILTER (WHERE kind = 'saccade') AS m, count(*) FILTER (WHERE kind = 'saccade' AND abs(turn - pi()) < radians(20)) AS back, sum(dur) FILTER (WHERE kind = 'saccade') / 1000.0 AS sec FROM ev GROUP BY ALL)""",
            cols("k.* EXCLUDE (sess, win, m, back, sec)", sc("fixation_rate", "coalesce(nf, 0) / (span / 1000.0)", 1), sc("saccade_rate", "coalesce(ns, 0) / (span / 1000.0)", 1), sc("fixation_saccade_ratio", "coalesce(nf, 0) / nullif(coalesce(ns, 0), 0)", 1),
                 sc("backtrack_saccade_rate", "CASE WHEN m >= 2 THEN back / nullif(sec, 0) END", 1), sc("backtrack_saccade_ratio", "CASE WHEN m >= 2 THEN back / m END", 1)), "c LEFT JOIN n USING (sess, win) LEFT JOIN k USING (sess, win)", False),
        "eye_drift": query(SEGMENTS, cols(*(st(f"fixational_drift_velocity{s}", f"v{c}", 1) for s, c in (("", ""), ("_x", "x"), ("_y", "y")))), "lab WHERE kind = 'fixation'"),
    }


# Tokens of the categories that the adapter's presses have.
CATEGORY = """CASE WHEN token = 'SPACE' THEN 'space' WHEN token = 'BACKSPACE' THEN 'backspace' WHEN token = 'ENTER' THEN 'enter' WHEN token = 'SHIFT' THEN 'shift' WHEN token = 'CONTROL' THEN 'control'
  WHEN token = 'ARROWLEFT' THEN 'cursor' WHEN regexp_full_match(token, '[A-Z]') THEN 'alphabetic' WHEN regexp_full_match(token, '[0-9]') THEN 'digit' WHEN length(token) = 1 THEN 'punctuation' ELSE 'other' END"""
PRESSES = f"""{EVENTS},
k0 AS (SELECT user_id AS sess, rn AS ord, k, sum(60 + round(value * 10)::BIGINT) OVER (PARTITION BY user_id ORDER BY rn) * 1000 AS down,
  CASE WHEN k < 40 THEN chr(65 + k % 26) WHEN k < 48 THEN (k % 10)::VARCHAR WHEN k < 60 THEN 'SPACE' WHEN k < 64 THEN 'BACKSPACE' WHEN k < 66 THEN ',' WHEN k < 78 THEN 'CONTROL' WHEN k < 80 THEN 'SHIFT' WHEN k < 82 THEN 'ENTER'
  WHEN k < 84 THEN 'ARROWLEFT' WHEN k < 88 THEN 'Z' WHEN k < 92 THEN 'V' WHEN k < 96 THEN 'X' ELSE 'C' END AS token FROM e),
g AS (SELECT sess, ord, token, down::BIGINT AS down, (down + (30 + (k * 37) % 200) * 1000)::BIGINT AS up, (30 + (k * 37) % 200)::DOUBLE AS hold FROM k0),
{hop("g", "down", "full", 20_000_000, 10_000_000, "up")},
c AS (SELECT *, {CATEGORY} AS cat FROM d),
s AS (SELECT *, lead(down) OVER q AS d1, lead(up) OVER q AS u1, lead(token) OVER q AS t1, lag(token) OVER q AS t0, row_number() OVER q AS i FROM c WINDOW q AS (PARTITION BY sess, win ORDER BY down, ord))"""
KEYS = ("alphabetic", "space", "backspace", "delete", "enter", "capslock", "shift", "control", "alt", "tab", "escape", "insert", "punctuation", "digit")


def keyboard() -> dict[str, str]:
    name = lambda k: "spacebar" if k == "space" else k
    ms = "(arg_max(up, down * 1000 + ord) - min(down)) / 1000.0"
    hit = lambda t: f"token = 'CONTROL' AND t1 = '{t}'"
    return {
        "win_full": f"WITH {PRESSES} SELECT sess, k AS win, w_start, w_end, (SELECT count(*) FROM g WHERE g.sess = w.sess AND down >= w_start AND down < w_end) AS n FROM w",
        "key_counts_ratios": query(PRESSES, cols(
            sc("total_keystroke_count", "count(*)", 0), sc("character_keystroke_count", "count(*) FILTER (WHERE cat IN ('alphabetic', 'digit', 'punctuation'))", 0), sc("non_character_keystroke_count", "count(*) FILTER (WHERE cat NOT IN ('alphabetic', 'digit', 'punctuation'))", 0),
            sc("first_keystroke_latency", "(min(down) - max(w_start)) / 1000.0", 0), sc("typing_duration", ms, 0), sc("typing_velocity", f"count(*) / greatest({ms} / 1000.0, 1e-9)", 0),
            *(sc(f"{name(k)}_key_ratio", f"count(*) FILTER (WHERE cat = '{k}') / count(*)", 0) for k in KEYS), sc("cursor_move_key_ratio", "count(*) FILTER (WHERE cat = 'cursor') / count(*)", 0)), "c"),
        "key_holds": query(PRESSES, cols(st("key_hold_duration", "hold", 0), *(st(f"{name(k)}_key_hold_duration", f"CASE WHEN cat = '{k}' THEN hold END", 0) for k in KEYS), st("cursor_move_key_duration", "CASE WHEN cat = 'cursor' THEN hold END", 0)), "c"),
        "key_intervals_overlap": query(PRESSES, cols(
            st("down_down_interval", "(d1 - down) / 1000.0", 0), st("up_down_interval", "(d1 - up) / 1000.0", 0), st("up_up_interval", "(u1 - up) / 1000.0", 0), st("key_overlap_duration", "CASE WHEN d1 IS NOT NULL THEN greatest(0, (up - d1) / 1000.0) END", 0),
            sc("key_overlap_ratio", "avg((d1 < up)::INT)", 0), st("ngram_typing_duration", "(d1 - down) / 1000.0", 0)), "s"),
        "key_pause_burst": query(PRESSES + f""", p AS (SELECT *, count(*) OVER (PARTITION BY sess, win) AS n, CASE WHEN (d1 - up) / 1000.0 >= 2000 THEN (d1 - up) / 1000.0 END AS pause FROM s),
p1 AS (SELECT *, coalesce(lag(pause IS NOT NULL) OVER q, false)::INT AS new FROM p WINDOW q AS (PARTITION BY sess, win ORDER BY down, ord)), p2 AS (SELECT *, sum(new) OVER (PARTITION BY sess, win ORDER BY down, ord) AS bu FROM p1),
bs AS (SELECT sess, win, bu, count(*)::DOUBLE AS len, (max(down) - min(down)) / 1000.0 AS dur FROM p2 WHERE n >= 2 GROUP BY ALL),
x AS (SELECT sess, win, {cols(st('pause_duration', 'pause', 0), sc('pause_ratio', f'CASE WHEN count(*) >= 2 THEN coalesce(sum(pause), 0) / greatest({ms}, 1e-9) END', 0))} FROM p GROUP BY ALL),
y AS (SELECT sess, win, {cols(st('burst_length', 'len', 0), st('burst_duration', 'dur', 0), st('burst_velocity', 'CASE WHEN dur > 0 THEN len / (dur / 1000.0) END', 0))} FROM bs GROUP BY ALL)""",
            "x.* EXCLUDE (sess, win), y.* EXCLUDE (sess, win)", "x LEFT JOIN y USING (sess, win)", False),
        "key_words_ngrams": query(PRESSES + """, f AS (SELECT *, lead(down) OVER (PARTITION BY sess, win ORDER BY down, ord) - down AS gap FROM s WHERE token <> 'SPACE' AND (i = 1 OR t0 = 'SPACE'))""", st("inter_word_interval", "gap / 1000.0", 0), "f"),
        "key_chords": query(PRESSES, cols(*(x for n, t in (("undo", "Z"), ("paste", "V"), ("cut", "X"), ("copy", "C")) for x in (st(f"{n}_duration", f"CASE WHEN {hit(t)} THEN (greatest(up, u1) - down) / 1000.0 END", 0), sc(f"{n}_ratio", f"count(*) FILTER (WHERE {hit(t)}) / count(*)", 0)))), "s"),
        "key_entropy": query(PRESSES + f""", a AS (SELECT sess, win, count(*) / sum(count(*)) OVER (PARTITION BY sess, win) AS p FROM c GROUP BY sess, win, cat), a1 AS (SELECT sess, win, {sc('key_category_entropy', 'sum(-p * log2(p))', 0)} FROM a GROUP BY ALL),
h AS (SELECT sess, win, count(*) / sum(count(*)) OVER (PARTITION BY sess, win) AS p FROM s WHERE t1 IS NOT NULL GROUP BY sess, win, token, t1), h1 AS (SELECT sess, win, {sc('ngram_distribution_entropy', 'sum(-p * log2(p))', 0)} FROM h GROUP BY ALL)""",
            "a1.* EXCLUDE (sess, win), h1.* EXCLUDE (sess, win)", "a1 LEFT JOIN h1 USING (sess, win)", False),
        "key_lifo_pairing": f"""WITH RECURSIVE {EVENTS},
k0 AS (SELECT user_id AS sess, chr(65 + k % 5) AS token, event_type IN ('click', 'view', 'signup') AS down, sum(60 + round(value * 10)::BIGINT) OVER (PARTITION BY user_id ORDER BY rn) * 1000 AS t, rn FROM e),
k1 AS (SELECT *, row_number() OVER (PARTITION BY sess, token ORDER BY t, rn) AS i FROM k0),
r AS (SELECT sess, token, 0::BIGINT AS i, []::BIGINT[] AS stack, NULL::BIGINT AS opened, NULL::BIGINT AS closed FROM (SELECT DISTINCT sess, token FROM k1)
  UNION ALL SELECT r.sess, r.token, k1.i, CASE WHEN down THEN list_append(stack, t::BIGINT) ELSE stack[:-2] END, CASE WHEN NOT down THEN stack[-1] END, CASE WHEN NOT down AND len(stack) > 0 THEN t::BIGINT END
  FROM r JOIN k1 ON k1.sess = r.sess AND k1.token = r.token AND k1.i = r.i + 1)
SELECT sess, token, opened AS down, closed AS up, (closed - opened) / 1000.0 AS hold FROM r WHERE closed IS NOT NULL""",
    }


TOUCH = f"""{EVENTS},
u0 AS (SELECT *, rn // 8 AS blk, rn % 8 AS m FROM e),
u1 AS (SELECT *, sum(CASE WHEN blk % 3 = 2 THEN 120 + k ELSE 8 + k % 20 END) OVER (PARTITION BY user_id ORDER BY rn) AS ms FROM u0),
g AS (SELECT user_id AS sess, rn AS ord, ((ms - min(ms) OVER (PARTITION BY user_id)) * 1000)::BIGINT AS t, (blk % 2)::INT AS pi, CASE WHEN m = 0 THEN 1 WHEN m <= 5 THEN 2 WHEN m = 6 THEN 3 ELSE 4 END AS et,
  ((blk * 211) % 1200 + 100 + CASE WHEN blk % 3 = 1 THEN m * (10 + k % 30) ELSE k % 3 END)::DOUBLE AS px, ((blk * 137) % 700 + 50 + CASE WHEN blk % 3 = 1 THEN m * (k % 20) ELSE k % 2 END)::DOUBLE AS py,
  (k % 101) / 100 AS p, (5 + k % 7)::DOUBLE AS h, 4 + value / 100 AS w FROM u1),
{hop("g", "t", "nonempty", 2_000_000, 1_000_000)},
v0 AS (SELECT *, t / 1e6 AS s, h * w AS area, greatest(h, w) AS major, least(h, w) AS minor, last_value(CASE WHEN et IN (1, 3) THEN et END IGNORE NULLS) OVER (PARTITION BY sess, win, pi ORDER BY t, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS le,
  sum((et = 1)::INT) OVER (PARTITION BY sess, win ORDER BY pi, t, ord) AS nd FROM d),
v1 AS (SELECT *, CASE WHEN et = 1 OR le = 1 THEN nd - 1 END AS sid, (t - lag(t) OVER q) / 1e6 AS dt, px - lag(px) OVER q AS dx, py - lag(py) OVER q AS dy, p - lag(p) OVER q AS dp, area - lag(area) OVER q AS da FROM v0 WINDOW q AS (PARTITION BY sess, win ORDER BY t, ord)),
v2 AS (SELECT *, dx / nullif(dt, 0) AS vx, dy / nullif(dt, 0) AS vy, sqrt((dx / nullif(dt, 0)) ** 2 + (dy / nullif(dt, 0)) ** 2) AS v FROM v1),
ev AS (SELECT *, (vx - lag(vx) OVER q) / nullif(dt, 0) AS ax, (vy - lag(vy) OVER q) / nullif(dt, 0) AS ay, (v - lag(v) OVER q) / nullif(dt, 0) AS a FROM v2 WINDOW q AS (PARTITION BY sess, win ORDER BY t, ord))"""
STROKES = f"""{TOUCH},
s0 AS (SELECT *, sqrt((px - lag(px) OVER q) ** 2 + (py - lag(py) OVER q) ** 2) AS leg FROM ev WHERE sid IS NOT NULL WINDOW q AS (PARTITION BY sess, win, sid ORDER BY t, ord)),
s1 AS (SELECT sess, win, sid, max(w_start) AS w_start, min(t) AS t0, max(t) AS t1, (max(t) - min(t)) / 1e6 AS dur, coalesce(sum(leg), 0) AS path, arg_min(px, t * 1000000 + ord) AS fx, arg_min(py, t * 1000000 + ord) AS fy, arg_max(px, t * 1000000 + ord) AS lx, arg_max(py, t * 1000000 + ord) AS ly,
  {fin('CASE WHEN count(DISTINCT s) > 1 THEN regr_slope(p, s) END')} AS ps FROM s0 GROUP BY ALL),
s2 AS (SELECT *, sqrt((lx - fx) ** 2 + (ly - fy) ** 2) AS disp FROM s1),
s3 AS (SELECT *, CASE WHEN dur >= 0.5 AND disp <= 20 THEN 'longpress' WHEN disp >= 50 OR path >= 50 THEN 'swipe' ELSE 'tap' END AS kind FROM s2),
sk AS (SELECT *, (lead(t0) OVER (PARTITION BY sess, win ORDER BY t0, sid) - t1) / 1e6 AS gap, (lead(t0) OVER (PARTITION BY sess, win, kind ORDER BY t0, sid) - t1) / 1e6 AS kgap FROM s3),
ge AS (SELECT ev.*, kind FROM ev LEFT JOIN sk USING (sess, win, sid)),
z0 AS (SELECT *, (t - lag(t) OVER q) / 1e6 AS ds, coalesce(sid - lag(sid) OVER q = 0, true) AS same, atan2(coalesce(py - lag(py) OVER q, 0), coalesce(px - lag(px) OVER q, 0)) AS th, a - lag(a) OVER q AS d_a, ax - lag(ax) OVER q AS d_ax, ay - lag(ay) OVER q AS d_ay
  FROM ge WHERE kind = 'swipe' WINDOW q AS (PARTITION BY sess, win ORDER BY sid, t, ord)),
sw AS (SELECT *, CASE WHEN ds > 0 THEN d_a / ds END AS j, CASE WHEN ds > 0 THEN d_ax / ds END AS jx, CASE WHEN ds > 0 THEN d_ay / ds END AS jy, coalesce(th - lag(th) OVER (PARTITION BY sess, win ORDER BY sid, t, ord), 0) AS turn FROM z0)"""
KINDS = {"tap": "tap", "swipe": "swipe", "longpress": "long_press"}


def touch() -> dict[str, str]:
    box = lambda x, y: (f"(max({x}) - min({x}))", f"(max({y}) - min({y}))")
    rx, ry = box("px", "py")
    n = "count(*)"
    share = lambda c: f"count(*) FILTER (WHERE {c}) / {n}"
    om = "CASE WHEN same AND ds <> 0 THEN turn / ds END"
    one = lambda k, e: f"CASE WHEN kind = '{k}' THEN {e} END"
    corr = "CASE WHEN stddev_pop(p) * stddev_pop(area) > 1e-12 * avg(abs(p)) * avg(abs(area)) THEN covar_pop(p, area) / (stddev_pop(p) * stddev_pop(area)) END"
    return {
        "win_full_nonempty": f"WITH {TOUCH} SELECT sess, win, min(w_start) AS w_start, min(w_end) AS w_end, count(*) AS n FROM d GROUP BY ALL",
        "touch_strokes": query(STROKES + f""", c AS (SELECT sess, win, count(*) AS ne FROM ev GROUP BY ALL),
x AS (SELECT sess, win, count(*) AS ns, {cols(sc('first_touch_latency', '(min(t0) - max(w_start)) / 1e6', 0), sc('first_touch_duration', 'arg_min(dur, t0 * 1000 + sid)', 0), st('touch_hold_duration', 'dur', 0), st('inter_touch_interval', 'gap', 0), sc('active_touch_time', 'sum(dur)', 0), st('touch_stroke_pressure_slope', 'ps', 0))} FROM sk GROUP BY ALL)""",
            cols("x.* EXCLUDE (sess, win, ns)", sc("total_touch_stroke_count", "coalesce(ns, 0)", 0), sc("touch_stroke_rate", "coalesce(ns, 0) / 2.0", 0), sc("touch_event_touch_stroke_ratio", "ne / nullif(coalesce(ns, 0), 0)", 0)), "c LEFT JOIN x USING (sess, win)", False),
        "touch_gestures": query(STROKES + f""", x AS (SELECT sess, win, {cols(*(y for k, m in KINDS.items() for y in (sc(f'{m}_ratio', f"count(*) FILTER (WHERE kind = '{k}') / count(*)", 0), st(f'{m}_duration', one(k, 'dur'), 0), st(f'inter_{m}_interval', one(k, 'kgap'), 0))))} FROM sk GROUP BY ALL),
y AS (SELECT sess, win, {cols(*(st(f'{m}_pressure', one(k, 'p'), 0) for k, m in KINDS.items()))} FROM ge WHERE kind IS NOT NULL GROUP BY ALL)""", "x.* EXCLUDE (sess, win), y.* EXCLUDE (sess, win)", "x JOIN y USING (sess, win)", False),
        "touch_swipe_kinematics": query(STROKES, cols(*(st(f"swipe_{m}{s}", f"{c}{x}", 0) for s, x in (("", ""), ("_x", "x"), ("_y", "y")) for m, c in (("velocity", "v"), ("acceleration", "a"), ("jerk", "j")))), "sw"),
        "touch_direction": query(STROKES, cols(st("swipe_direction", "th", 0), st("swipe_angular_velocity", om, 0), sc("swipe_direction_change_count", "count(*) FILTER (WHERE abs(turn) > radians(45) AND same)", 0)), "sw"),
        "touch_kinematics": query(TOUCH, cols(sc("high_velocity_touch_count", "count(*) FILTER (WHERE v > 1000)", 0), st("touch_pressure_change_rate", "CASE WHEN dt > 0 THEN abs(dp / dt) END", 0), st("touch_area_change_rate", "CASE WHEN dt > 0 THEN abs(da / dt) END", 0)), "ev"),
        "touch_swipe_geometry": query(STROKES + f""", x AS (SELECT sess, win, {cols(sc('range_based_swipe_dispersion', f'{rx} + {ry}', 0), sc('rms_based_swipe_dispersion', 'sqrt(var_pop(px) + var_pop(py))', 0), sc('bbox_area_based_swipe_dispersion', f'{rx} * {ry}', 0), sc('swipe_bbox_width', rx, 0), sc('swipe_bbox_height', ry, 0), sc('swipe_bbox_area', f'{rx} * {ry}', 0), sc('swipe_bbox_aspect_ratio', f'{rx} / nullif({ry}, 0)', 0))} FROM ge WHERE kind = 'swipe' GROUP BY ALL),
y AS (SELECT sess, win, {cols(st('swipe_path_length', 'path', 0), st('swipe_displacement', 'disp', 0), st('swipe_path_curvature', 'disp / nullif(path, 0)', 0), sc('horizontal_swipe_rate', 'count(*) FILTER (WHERE abs(lx - fx) > abs(ly - fy)) / 2.0', 0), sc('vertical_swipe_rate', 'count(*) FILTER (WHERE abs(ly - fy) > abs(lx - fx)) / 2.0', 0))} FROM sk WHERE kind = 'swipe' GROUP BY ALL),
q AS (SELECT sess, win, fx AS px, fy AS py FROM sk WHERE kind = 'swipe' UNION ALL SELECT sess, win, lx, ly FROM sk WHERE kind = 'swipe'),
z AS (SELECT sess, win, {cols(sc('range_based_swipe_endpoint_dispersion', f'{rx} + {ry}', 0), sc('rms_based_swipe_endpoint_dispersion', 'sqrt(var_pop(px) + var_pop(py))', 0), sc('bbox_area_based_swipe_endpoint_dispersion', f'{rx} * {ry}', 0))} FROM q GROUP BY ALL)""",
            "x.* EXCLUDE (sess, win), y.* EXCLUDE (sess, win), z.* EXCLUDE (sess, win)", "x JOIN y USING (sess, win) JOIN z USING (sess, win)", False),
        "touch_regions": query(TOUCH, cols(
            sc("edge_touch_ratio", share("px < 144 OR px > 1296 OR py < 90 OR py > 810"), 0), sc("left_half_touch_ratio", share("px < 720"), 0), sc("right_half_touch_ratio", share("px >= 720"), 0), sc("top_half_touch_ratio", share("py < 450"), 0), sc("bottom_half_touch_ratio", share("py >= 450"), 0),
            sc("central_touch_ratio", share("px BETWEEN 480 AND 960 AND py BETWEEN 300 AND 600"), 0), st("touch_offset_to_screen_center", "sqrt((px - 720) ** 2 + (py - 450) ** 2)", 0), sc("central_bias", "sqrt((avg(px) - 720) ** 2 + (avg(py) - 450) ** 2)", 0),
            sc("range_based_touch_dispersion", f"{rx} + {ry}", 0), sc("rms_based_touch_dispersion", "sqrt(var_pop(px) + var_pop(py))", 0), sc("bbox_area_based_touch_dispersion", f"{rx} * {ry}", 0), sc("touch_covariance", "CASE WHEN count(*) >= 2 THEN covar_samp(px, py) END", 0)), "ev"),
        "touch_pressure_area": query(TOUCH, cols(
            st("touch_position_x", "px", 0), st("touch_position_y", "py", 0), st("touch_pressure", "p", 0), sc("total_touch_count", "count(*)", 0), sc("touch_event_rate", "count(*) / 2.0", 0), sc("high_pressure_touch_count", "count(*) FILTER (WHERE p > 0.8)", 0),
            st("touch_area", "area", 0), st("touch_major_axis", "major", 0), st("touch_minor_axis", "minor", 0), sc("touch_pressure_area_correlation", corr, 0), sc("touch_area_slope", "CASE WHEN count(DISTINCT s) > 1 THEN regr_slope(area, s) END", 0)), "ev"),
        "touch_entropy": query(TOUCH + f""", q AS (SELECT sess, win, px, py, min(px) OVER z AS x0, max(px) OVER z - min(px) OVER z AS bw, min(py) OVER z AS y0, max(py) OVER z - min(py) OVER z AS bh FROM ev WINDOW z AS (PARTITION BY sess, win)),
r AS (SELECT sess, win, count(*) / sum(count(*)) OVER (PARTITION BY sess, win) AS f FROM q WHERE bw > 0 AND bh > 0 GROUP BY sess, win, least(floor((px - x0) / bw * 10), 9), least(floor((py - y0) / bh * 10), 9))""", sc("touch_entropy", "sum(-f * ln(f + 1e-12))", 0), "r"),
        "touch_fractal": query(STROKES + f""", q AS (SELECT sess, win, px, py, count(*) OVER z AS n, min(px) OVER z AS x0, max(px) OVER z - min(px) OVER z AS bw, min(py) OVER z AS y0, max(py) OVER z - min(py) OVER z AS bh FROM ge WHERE kind = 'swipe' WINDOW z AS (PARTITION BY sess, win)),
r AS (SELECT sess, win, g, max(n) AS n, max(bw) AS bw, max(bh) AS bh, count(DISTINCT (least(floor((px - x0) / nullif(bw, 0) * g), g - 1), least(floor((py - y0) / nullif(bh, 0) * g), g - 1))) AS c FROM q, (VALUES (4), (8), (16)) v(g) GROUP BY ALL)""",
            sc("swipe_path_fractal_dimension", "CASE WHEN max(n) >= 10 THEN CASE WHEN max(bw) <= 0 OR max(bh) <= 0 THEN 0.0 ELSE regr_slope(ln(greatest(c, 1)), ln(g)) END END", 0), "r"),
    }


VOICE = f"""f0 AS (SELECT o_custkey % 20 AS sess, o_totalprice, row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY o_orderkey) AS ord FROM orders),
g AS (SELECT sess, ord, ord + 1 AS en, (CASE WHEN (ord // 30) % 3 = 0 THEN 1e-6 ELSE o_totalprice / 1e6 END)::FLOAT AS rms FROM f0),
{hop("g", "ord", "padded", 300, 150, "en")},
fr AS (SELECT sess, k AS win, w_start, unnest(range(0, 300)) AS i FROM w),
fw AS (SELECT fr.sess, fr.win, i, coalesce(g.rms, 1e-6::FLOAT) AS rms FROM fr LEFT JOIN g ON g.sess = fr.sess AND g.ord = w_start + i),
pc AS (SELECT sess, win, quantile_cont(rms::DOUBLE, 0.75) AS p75 FROM fw GROUP BY ALL),
sp AS (SELECT fw.*, rms >= greatest(1e-6, p75 * 0.15)::FLOAT AS speech FROM fw JOIN pc USING (sess, win))"""
PAUSES = f"""{VOICE},
r0 AS (SELECT *, (speech IS DISTINCT FROM lag(speech) OVER (PARTITION BY sess, win ORDER BY i))::INT AS new FROM sp), r1 AS (SELECT *, sum(new) OVER (PARTITION BY sess, win ORDER BY i) AS isl FROM r0),
r2 AS (SELECT *, NOT speech AND count(*) OVER (PARTITION BY sess, win, isl) * 0.01 >= 0.2 AS pause FROM r1),
r3 AS (SELECT *, (pause IS DISTINCT FROM lag(pause) OVER (PARTITION BY sess, win ORDER BY i))::INT AS newp FROM r2), r4 AS (SELECT *, sum(newp) OVER (PARTITION BY sess, win ORDER BY i) AS pis FROM r3),
pa AS (SELECT sess, win, isl, count(*) * 0.01::DOUBLE AS d FROM r2 WHERE pause GROUP BY ALL),
ut AS (SELECT sess, win, pis, (max(i) FILTER (WHERE speech) + 1) * 0.01::DOUBLE - min(i) FILTER (WHERE speech) * 0.01::DOUBLE AS d FROM r4 WHERE NOT pause GROUP BY ALL HAVING count(*) FILTER (WHERE speech) > 0)"""
ENVELOPE = f"""{VOICE},
e0 AS (SELECT *, CASE WHEN speech THEN sum(rms::DOUBLE) OVER (PARTITION BY sess, win ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5 ELSE 0 END AS env FROM sp),
en AS (SELECT *, sum(env) OVER (PARTITION BY sess, win ORDER BY i ROWS BETWEEN 25 PRECEDING AND 24 FOLLOWING) / 50 AS tr FROM e0)"""


def voice() -> dict[str, str]:
    null = lambda n: f"NULL::DOUBLE AS {n}_mean, NULL::DOUBLE AS {n}_std, NULL::DOUBLE AS {n}_min, NULL::DOUBLE AS {n}_max"
    return {
        "win_padded": f"WITH {VOICE} SELECT sess, k AS win, w_start, w_end, (SELECT count(*) FROM g WHERE g.sess = w.sess AND ord >= w_start AND ord < w_end) AS n FROM w",
        "voice_vad_pause": query(PAUSES + f""", b0 AS (SELECT sess, win, count(*) FILTER (WHERE speech) * 0.01::DOUBLE AS ts, count(*) FILTER (WHERE NOT speech) * 0.01::DOUBLE AS tn FROM sp GROUP BY ALL),
b1 AS (SELECT sess, win, {st('pause_duration', 'd', 0)}, sum(d) AS s1, count(*) AS n1 FROM pa GROUP BY ALL), b2 AS (SELECT sess, win, {st('utterance_duration', 'd', 0)}, sum(d) AS s2, count(*) AS n2 FROM ut GROUP BY ALL)""",
            cols("b1.* EXCLUDE (sess, win, s1, n1)", "b2.* EXCLUDE (sess, win, s2, n2)", sc("total_speech_time", "ts", 0), sc("speech_ratio", "ts / 3", 0), sc("total_nonspeech_time", "tn", 0), sc("nonspeech_ratio", "tn / 3", 0), sc("pause_ratio", "coalesce(s1, 0) / 3", 0), sc("pause_rate", "coalesce(n1, 0) / 3", 0),
                 sc("utterance_ratio", "coalesce(s2, 0) / 3", 0), sc("utterance_rate", "coalesce(n2, 0) / 3", 0), sc("utterance_pause_ratio", "coalesce(s2, 0) / nullif(coalesce(s1, 0), 0)", 0)), "b0 LEFT JOIN b1 USING (sess, win) LEFT JOIN b2 USING (sess, win)", False),
        "voice_loudness": query(VOICE + ", l AS (SELECT sess, win, 20 * log10(greatest(rms::DOUBLE, 1e-12)) AS db, (row_number() OVER (PARTITION BY sess, win ORDER BY i) - 1) * 0.01::DOUBLE AS t FROM sp WHERE speech)",
            cols(st("loudness_level", "db", 0), sc("loudness_range", "quantile_cont(db, 0.95) - quantile_cont(db, 0.05)", 0), sc("loudness_slope", "CASE WHEN count(*) >= 2 THEN regr_slope(db, t) END", 0)), "l"),
        "voice_envelope_ma": query(ENVELOPE, sc("amplitude_tremor_extent", "sqrt(avg((env - tr) * (env - tr)))", 0), "en"),
        "null_indicators": f"WITH {PRESSES} SELECT sess, k AS win, {cols(*map(null, ('key_sequence_levenshtein_distance', 'ngram_distribution_similarity', 'dynamic_time_warping_similarity', 'frequency_domain_similarity', 'rouge_l_similarity')))} FROM w",
    }


def hull(points: str) -> str:
    """CTEs that end in hp (sess, win, area, perimeter), of points (sess, win, x, y): an edge has no point to its right, and those on its line lie on it."""
    return f"""hq AS (SELECT DISTINCT sess, win, x, y FROM ({points})),
he AS (SELECT a.sess, a.win, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2, min((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x)) AS lo, max((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x)) AS hi,
  bool_and((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) <> 0 OR (c.x - a.x) * (c.x - b.x) + (c.y - a.y) * (c.y - b.y) <= 0) AS within
  FROM hq a JOIN hq b ON a.sess = b.sess AND a.win = b.win AND (a.x <> b.x OR a.y <> b.y) JOIN hq c ON a.sess = c.sess AND a.win = c.win GROUP BY ALL),
hp AS (SELECT sess, win, sum(x1 * y2 - y1 * x2) / 2 AS area, sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS perimeter FROM he WHERE lo >= 0 AND hi > 0 AND within GROUP BY ALL)"""


def dft(name: str, values: str) -> str:
    """CTE name (sess, win, n, k, mag) of values (sess, win, i from 0, y): magnitudes of the centred values' discrete Fourier transform, k from 0 to n / 2."""
    return f"""{name}v AS (SELECT sess, win, i, y - avg(y) OVER z AS y, count(*) OVER z AS n FROM ({values}) WINDOW z AS (PARTITION BY sess, win)),
{name}k AS (SELECT DISTINCT sess, win, n, unnest(range(0, n // 2 + 1)) AS k FROM (SELECT DISTINCT sess, win, n FROM {name}v)),
{name} AS (SELECT v.sess, v.win, max(v.n) AS n, k, sqrt(sum(y * cos(2 * pi() * ((k * i) % v.n) / v.n)) ** 2 + sum(y * sin(2 * pi() * ((k * i) % v.n) / v.n)) ** 2) AS mag FROM {name}v v JOIN {name}k q ON v.sess = q.sess AND v.win = q.win GROUP BY v.sess, v.win, k)"""


def band(name: str, source: str, low: float, high: float) -> str:
    """CTE name (sess, win, rate, entropy, regularity) of a dft's magnitudes at 100 values a second within a band."""
    return f"""{name}b AS (SELECT *, k * 100.0 / n AS f, sum(mag) OVER z AS total, avg(mag) OVER z AS mean FROM {source} WHERE n >= 4 AND k > 0 AND k * 100.0 / n BETWEEN {low} AND {high} WINDOW z AS (PARTITION BY sess, win)),
{name} AS (SELECT sess, win, arg_max(f, mag * 1e9 - k * 1e-9) AS rate, CASE WHEN max(total) > 0 THEN sum(CASE WHEN mag > 0 THEN -mag / total * log2(mag / total) ELSE 0 END) END AS entropy, max(mag) / (max(mean) + 1e-12) AS regularity FROM {name}b GROUP BY ALL)"""


def spectra() -> dict[str, str]:
    power = lambda n, of, c: dft(f"{n}f", f"SELECT sess, win, row_number() OVER (PARTITION BY sess, win ORDER BY t, ord) - 1 AS i, {c} AS y FROM {of} WHERE {c} IS NOT NULL") + f""",
{n}p AS (SELECT *, mag * mag AS pw, sum(mag * mag) OVER z AS total, avg(mag * mag) OVER z AS mean FROM {n}f WHERE n >= 4 AND k > 0 WINDOW z AS (PARTITION BY sess, win)),
{n} AS (SELECT p.sess, p.win, arg_max(k / n * fs, pw) AS rate, sum(-pw / total * log2(pw / total + 1e-12)) AS entropy, max(pw) / (max(mean) + 1e-12) AS regularity FROM {n}p p JOIN fs USING (sess, win) WHERE fs IS NOT NULL AND total > 0 GROUP BY ALL)"""  # noqa: E731
    return {
        "touch_rhythm": query(
            TOUCH + f", fs AS (SELECT sess, win, 1.0 / avg(CASE WHEN dt > 0 THEN dt END) AS fs FROM ev GROUP BY ALL), {power('rv', 'ev', 'v')}, {power('ra', 'ev', 'a')}",
            cols(*(sc(f"{k}_rhythm_{n}", f"{r}.{c}", 0) for k, r in (("velocity", "rv"), ("acceleration", "ra")) for n, c in (("rate", "rate"), ("spectral_entropy", "entropy"), ("regularity", "regularity")))), "fs LEFT JOIN rv USING (sess, win) LEFT JOIN ra USING (sess, win)", False),
        "voice_rhythm": query(
            ENVELOPE + f", {dft('ef', 'SELECT sess, win, i, env AS y FROM en')}, {band('eb', 'ef', 0.5, 12.0)}, {dft('tf', 'SELECT sess, win, i, env - tr AS y FROM en')}, {band('tb', 'tf', 3.0, 12.0)}",
            cols(sc("envelope_rhythm_rate", "eb.rate", 0), sc("envelope_rhythm_spectral_entropy", "eb.entropy", 0), sc("envelope_rhythm_regularity", "eb.regularity", 0), sc("amplitude_tremor_rate", "tb.rate", 0)), "eb JOIN tb USING (sess, win)", False),
        "audio_spectrum": f"WITH a AS (SELECT vec_id AS sess, 1 AS win, unnest(range(0, len(embedding))) AS i, unnest(embedding)::DOUBLE AS y FROM embeddings), {dft('af', 'SELECT * FROM a')}, {band('ab', 'af', 0.5, 12.0)} SELECT sess, {rd('rate')} AS rate, {rd('entropy')} AS entropy, {rd('regularity')} AS regularity FROM ab",
        # a run of equal values between lower neighbours is a peak; the highest left takes those nearer than 8 frames away
        "voice_syllables": "WITH RECURSIVE " + ENVELOPE + f""",
q0 AS (SELECT *, (env IS DISTINCT FROM lag(env) OVER q)::INT AS new FROM en WINDOW q AS (PARTITION BY sess, win ORDER BY i)), q1 AS (SELECT *, sum(new) OVER (PARTITION BY sess, win ORDER BY i) AS r FROM q0),
q2 AS (SELECT sess, win, r, max(env) AS y, (min(i) + max(i)) // 2 AS i FROM q1 GROUP BY ALL), q3 AS (SELECT *, lag(y) OVER q < y AND lead(y) OVER q < y AS top FROM q2 WINDOW q AS (PARTITION BY sess, win ORDER BY r)),
hi AS (SELECT sess, win, CASE WHEN max(env) > 0 THEN quantile_cont(env, 0.75) END AS least, count(*) FILTER (WHERE speech) * 0.01::DOUBLE AS ts FROM en GROUP BY ALL),
pk AS (SELECT sess, win, max(ts) AS ts, coalesce(list({{'y': y, 'i': i}} ORDER BY y DESC, i DESC) FILTER (WHERE top AND y >= coalesce(least, y)), []) AS rest FROM q3 JOIN hi USING (sess, win) GROUP BY ALL),
gr AS (SELECT sess, win, ts, rest, 0 AS n FROM pk UNION ALL SELECT sess, win, ts, list_filter(rest, lambda z: abs(z.i - rest[1].i) >= 8), n + 1 FROM gr WHERE len(rest) > 0)
SELECT sess, win, {sc('speech_velocity', 'max(n) / nullif(max(ts), 0)', 0)} FROM gr GROUP BY ALL""",
        "voice_pitch": query(
            ENVELOPE + f""", fz AS (SELECT sess, ord, CASE WHEN ord % 7 <> 0 THEN 80 + fmod(rms::DOUBLE * 300, 200) END AS f0 FROM g),
vo AS (SELECT sp.*, f0, coalesce(f0 > 0, false) AS voiced FROM sp JOIN fr USING (sess, win, i) LEFT JOIN fz ON fz.sess = sp.sess AND fz.ord = fr.w_start + i WHERE speech),
vp AS (SELECT *, lag(voiced) OVER (PARTITION BY sess, win ORDER BY i) AND NOT voiced AS broke FROM vo),
s0 AS (SELECT sess, win, 12 * log2(f0 / 55) AS s, row_number() OVER q AS j, count(*) OVER (PARTITION BY sess, win) AS m FROM vo WHERE voiced WINDOW q AS (PARTITION BY sess, win ORDER BY i)),
s1 AS (SELECT *, s - CASE WHEN m = 1 THEN s ELSE (sum(s) OVER (PARTITION BY sess, win ORDER BY j ROWS BETWEEN least(50, m) // 2 PRECEDING AND (least(50, m) - 1) // 2 FOLLOWING) * (1::FLOAT / least(50, m)::FLOAT)::DOUBLE)::FLOAT::DOUBLE END AS y FROM s0),
{dft('pf', 'SELECT sess, win, j - 1 AS i, y FROM s1')}, {band('pb', 'pf', 3.0, 12.0)},
s2 AS (SELECT sess, win, stddev_pop(s) AS sd, quantile_cont(s, 0.95) - quantile_cont(s, 0.05) AS span, sqrt(avg(y * y)) AS extent FROM s1 GROUP BY ALL),
x AS (SELECT sess, win, {cols(st('pitch_level_f0', 'CASE WHEN voiced THEN f0 END', 0))}, count(*) AS n, count(*) FILTER (WHERE voiced) AS k, count(*) FILTER (WHERE broke) AS br FROM vp GROUP BY ALL)""",
            cols("x.* EXCLUDE (sess, win, n, k, br)", sc("voiced_ratio", "CASE WHEN k > 0 THEN k / n END", 0), sc("unvoiced_ratio", "CASE WHEN k > 0 THEN 1 - k / n END", 0), sc("voicing_breaks_rate", "CASE WHEN k > 0 AND n >= 2 THEN br / (n * 0.01::DOUBLE) END", 0),
                 sc("pitch_variability", "sd", 0), sc("pitch_range", "span", 0), sc("pitch_tremor_extent", "extent", 0), sc("pitch_tremor_rate", "rate", 0)), "x LEFT JOIN s2 USING (sess, win) LEFT JOIN pb USING (sess, win)", False),
    }


def signals() -> dict[str, str]:
    """Frames of 100 samples each 40, their loudness in single precision, and YIN by sums over lags."""
    base = """c AS (SELECT c_custkey AS sess, 100 + (c_custkey * 7) % 300 + c_nationkey / 10.0::DOUBLE AS hz, c_nationkey AS k FROM customer),
sg AS (SELECT sess, list_transform(range(800), lambda i: round(64 * (0.5::DOUBLE * sin(2 * pi() * hz * i / 4000) + 0.3::DOUBLE * sin(2 * pi() * 2 * hz * i / 4000 + k)) * CASE WHEN i >= 400 THEN 1.0::DOUBLE ELSE (k % 4 + 1) / 4.0::DOUBLE END) / 64) AS y FROM c),
pd AS (SELECT sess, y, list_concat(list_concat(list_transform(range(50), lambda i: 0.0::DOUBLE), y), list_transform(range(50), lambda i: 0.0::DOUBLE)) AS z FROM sg),
ff AS (SELECT sess, y, z, unnest(range(18)) AS i FROM pd),
fm AS (SELECT sess, i, sqrt((list_sum(list_transform(y[i * 40 + 1 : i * 40 + 100], lambda v: v * v))::FLOAT / 100::FLOAT + 1e-12::FLOAT)::DOUBLE)::FLOAT AS rms, z[i * 40 + 1 : i * 40 + 100] AS w FROM ff),
lg AS (SELECT sess, i, w, unnest(range(1, 51)) AS lag FROM fm),
df AS (SELECT sess, i, lag, list_sum(list_transform(range(1, 51), lambda j: (w[j] - w[j + lag]) * (w[j] - w[j + lag]))) AS d FROM lg),
mn AS (SELECT *, sum(d) OVER (PARTITION BY sess, i ORDER BY lag ROWS UNBOUNDED PRECEDING) / lag AS m FROM df),
nm AS (SELECT sess, i, lag, CASE WHEN m > 0 THEN d / m ELSE 1.0 END AS n FROM mn),
nb AS (SELECT *, lag(n) OVER q AS a, lead(n) OVER q AS b FROM nm WINDOW q AS (PARTITION BY sess, i ORDER BY lag)),
bs AS (SELECT sess, i, min(lag) FILTER (lag BETWEEN 9 AND 48 AND n < a AND n <= b AND n < 0.1) AS dip, min_by(lag, (n, lag)) FILTER (lag BETWEEN 8 AND 49) AS low FROM nb GROUP BY sess, i),
pk AS (SELECT bs.sess, bs.i, lag, n, coalesce(a, 1.0) AS a, coalesce(b, n) AS b, a - 2 * n + b AS bend FROM bs JOIN nb ON nb.sess = bs.sess AND nb.i = bs.i AND nb.lag = coalesce(dip, low)),
tr AS (SELECT pk.sess, 1 AS win, pk.i, rms, 4000 / (lag + CASE WHEN bend > 0 AND abs(a - b) < 2 * bend THEN 0.5 * (a - b) / bend ELSE 0.0 END) AS f0 FROM pk JOIN fm USING (sess, i)),
sp AS (SELECT *, rms >= greatest(1e-6, quantile_cont(rms::DOUBLE, 0.75) OVER (PARTITION BY sess) * 0.15)::FLOAT AS speech FROM tr)"""
    return {
        "voice_signal_frames": f"WITH {base} SELECT sess, i, {rd('rms')} AS rms, {rd('f0')} AS f0 FROM tr",
        "voice_signal_pitch": query(base, cols(st("pitch_level_f0", "f0", 0), sc("voiced_ratio", "1.0", 0), sc("voicing_breaks_rate", "CASE WHEN count(*) >= 2 THEN 0.0 END", 0)), "sp WHERE speech"),
    }


def hulls() -> dict[str, str]:
    return {
        "eye_hull": query(SEGMENTS + ", " + hull("SELECT sess, win, mx AS x, my AS y FROM ev WHERE kind = 'fixation'") + ", hw AS (SELECT DISTINCT sess, win FROM ev WHERE kind = 'fixation')",
            cols(sc("fixation_convex_hull_area", "coalesce(area, 0)", 1), sc("fixation_convex_hull_perimeter", "coalesce(perimeter, 0)", 1)), "hw LEFT JOIN hp USING (sess, win)", False),
        "touch_hull": query(TOUCH + ", " + hull("SELECT sess, win, px AS x, py AS y FROM ev") + ", hw AS (SELECT sess, win FROM ev GROUP BY ALL HAVING count(*) >= 3)",
            cols(sc("touch_convex_hull_area", "coalesce(area, 0)", 0), sc("touch_convex_hull_perimeter", "coalesce(perimeter, 0)", 0)), "hw LEFT JOIN hp USING (sess, win)", False),
    }


def wide(spine: str, extra: str, parts: list[str], sql: dict[str, str], nulls: tuple = ()) -> str:
    """All indicators of a modality: the windows with each part's columns."""
    null = "".join(f", NULL::DOUBLE AS {n}_{k}" for n in nulls for k in ("mean", "std", "min", "max"))
    joins = "\n".join(f"LEFT JOIN ({sql[p]}) p{i} USING (sess, win)" for i, p in enumerate(parts))
    return f"SELECT z.sess, z.win{extra}, {', '.join(f'p{i}.* EXCLUDE (sess, win)' for i in range(len(parts)))}{null} FROM ({spine}) z\n{joins}"


def every() -> dict[str, str]:
    sql = {**eye(), **keyboard(), **touch(), **voice(), **spectra(), **signals(), **hulls()}
    pitch = tuple(f"{n}" for n in ("pitch_level_f0", "voiced_ratio", "unvoiced_ratio", "voicing_breaks_rate", "pitch_variability", "pitch_range", "pitch_tremor_extent", "pitch_tremor_rate"))
    span, counted = ", z.w_start, z.w_end, z.n_samples", "min(w_start) AS w_start, min(w_end) AS w_end, count(*) AS n_samples FROM d GROUP BY sess, win"
    sql["eye_indicators"] = wide(f"WITH {GAZE} SELECT sess, win, {counted}", span, ["eye_position_velocity", "eye_jerk", "eye_path_bbox_dispersion", "eye_entropy", "eye_fractal", "eye_rqa", "eye_dwell_regions", "eye_center_bias", "eye_fixations", "eye_saccades", "eye_event_geometry", "eye_intervals_backtrack", "eye_drift", "eye_hull"], sql)
    keys = f"WITH {PRESSES}, nn AS (SELECT sess, win, count(*) AS n FROM d GROUP BY ALL) SELECT w.sess, w.k AS win, w_start, w_end, coalesce(n, 0) AS n_samples FROM w LEFT JOIN nn ON nn.sess = w.sess AND nn.win = w.k"
    sql["keyboard_indicators"] = wide(keys, span, [k for k in sql if k.startswith("key_") and k != "key_lifo_pairing"], sql, ("key_sequence_levenshtein_distance", "ngram_distribution_similarity", "rouge_l_similarity"))
    sql["touch_indicators"] = wide(f"WITH {TOUCH} SELECT sess, win, {counted}", span, [k for k in sql if k.startswith("touch_") and k != "touch_indicators"], sql)
    sql["voice_indicators"] = wide(f"WITH {VOICE} SELECT DISTINCT sess, win FROM fw", "", [k for k in sql if k.startswith("voice_") and "signal" not in k and k not in ("voice_pitch", "voice_indicators")], sql, (*pitch, "dynamic_time_warping_similarity", "frequency_domain_similarity", "rouge_l_similarity"))
    return sql


SQL = every()
