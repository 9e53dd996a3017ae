"""Keyboard indicators (62): presses to one row for each session and window. Windows without a press stay, with nulls.

Presses, steps, bursts and words stand on the rows of one table (a burst's last press and a word's first stand for them), and
one aggregation makes the row. The functions of single families are for queries of these alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import tokens
from loomspan.functions.stats import null4, only, scalar4, stats4
from loomspan.operators import geometry
from loomspan.operators.sequence import lifo_pairs
from loomspan.operators.windows import FULL, assign, bounds, spine

from .config import PIConfig

G = ["sess", "win"]
KEYS = ("alphabetic", "space", "backspace", "delete", "enter", "capslock", "shift", "control", "alt", "tab", "escape", "insert", "punctuation", "digit")
CHORDS = {"undo": "Z", "paste": "V", "cut": "X", "copy": "C"}


def in_order():
    return Window.partitionBy(*G).orderBy("down", "ord")


def pair_events(events: DataFrame) -> DataFrame:
    """Presses (sess, ord, token, down, up, hold) from KEY_DOWN and KEY_UP events (sess, ord, token, action, t): last in, first out for each token. Events without a token or time take no part."""
    e = events.where("token <> '' AND t IS NOT NULL")
    pairs = lifo_pairs(e, ["sess", "token"], ["t", "ord"], F.upper("action") == "KEY_DOWN", F.upper("action") == "KEY_UP", "t")
    out = pairs.where("closed >= opened").select("sess", "token", F.col("opened").alias("down"), F.col("closed").alias("up"), ((F.col("closed") - F.col("opened")) / 1000.0).alias("hold"))
    return out.withColumn("ord", F.row_number().over(Window.partitionBy("sess").orderBy("down", "up", "token"))).select("sess", "ord", "token", "down", "up", "hold")


def windows(presses: DataFrame, cfg: PIConfig) -> DataFrame:
    wd = assign(presses, "down", FULL, cfg.us(cfg.window_s), cfg.us(cfg.stride_s), end="up")
    return wd.withColumn("category", tokens.category(F.col("token")))


def all_windows(presses: DataFrame, cfg: PIConfig) -> DataFrame:
    return spine(bounds(presses, "down", "up"), FULL, cfg.us(cfg.window_s), cfg.us(cfg.stride_s))


def typing() -> tuple:
    """N, typing time in ms: from the first press to the release of the last press."""
    return F.count("*"), (F.max_by("up", F.struct("down", "ord")) - F.min("down")) / 1000.0


def counts(wd: DataFrame) -> DataFrame:
    return wd.groupBy(*G).agg(*count_list())


def count_list() -> list:
    n, ms = typing()
    chars = F.count_if(F.col("category").isin("alphabetic", "digit", "punctuation"))
    out = [
        *scalar4("total_keystroke_count", n, 0), *scalar4("character_keystroke_count", chars, 0), *scalar4("non_character_keystroke_count", n - chars, 0),
        *scalar4("first_keystroke_latency", (F.min("down") - F.max("w_start")) / 1000.0, 0), *scalar4("typing_duration", ms, 0), *scalar4("typing_velocity", n / F.greatest(ms / 1000.0, F.lit(1e-9)), 0),
    ]
    for k in KEYS:
        name = "spacebar" if k == "space" else k
        out += scalar4(f"{name}_key_ratio", f"count_if(category = '{k}') / count(*)", 0)
    return [*out, *scalar4("cursor_move_key_ratio", "count_if(category = 'cursor') / count(*)", 0)]


def holds(wd: DataFrame) -> DataFrame:
    return wd.groupBy(*G).agg(*hold_list())


def hold_list() -> list:
    of = lambda k: f"CASE WHEN category = '{k}' THEN hold END"
    out = stats4("key_hold_duration", "hold", 0)
    for k in KEYS:
        out += stats4(f"{'spacebar' if k == 'space' else k}_key_hold_duration", of(k), 0)
    return [*out, *stats4("cursor_move_key_duration", of("cursor"), 0)]


def steps(wd: DataFrame, n: int) -> DataFrame:
    """Presses with the next one's times and the intervals in ms."""
    nxt = wd.withColumns({"d1": F.lead("down").over(in_order()), "u1": F.lead("up").over(in_order()), "tok1": F.lead("token").over(in_order()), "tok0": F.lag("token").over(in_order()), "i": F.row_number().over(in_order())})
    ms = lambda a, b: (F.col(a) - F.col(b)) / 1000.0
    nxt = nxt.withColumns({"dd": ms("d1", "down"), "ud": ms("d1", "up"), "uu": ms("u1", "up")})
    far = (F.lead("down", n - 1).over(in_order()) - F.col("down")) / 1000.0 if n >= 2 else F.lit(None).cast("double")
    gram = F.array(F.col("token"), *(F.lead("token", i).over(in_order()) for i in range(1, n)))
    return nxt.withColumns({"over": F.greatest(F.lit(0.0), -F.col("ud")), "ngram_ms": far, "ngram": F.when(far.isNotNull(), gram) if n >= 2 else F.lit(None).cast("array<string>")})


def step_stats(st: DataFrame, cfg: PIConfig) -> DataFrame:
    return st.groupBy(*G).agg(*step_list(cfg))


def step_list(cfg: PIConfig) -> list:
    _, ms = typing()
    pause = F.when(F.col("ud") >= cfg.pause_ms, F.col("ud"))
    return [
        *stats4("down_down_interval", "dd", 0), *stats4("up_down_interval", "ud", 0), *stats4("up_up_interval", "uu", 0), *stats4("key_overlap_duration", F.when(F.col("ud").isNotNull(), F.col("over")), 0),
        *scalar4("key_overlap_ratio", F.avg((F.col("ud") < 0).cast("double")), 0), *stats4("ngram_typing_duration", "ngram_ms", 0), *stats4("pause_duration", pause, 0),
        *scalar4("pause_ratio", F.when(F.count("*") >= 2, F.coalesce(F.sum(pause), F.lit(0.0)) / F.greatest(ms, F.lit(1e-9))), 0),
    ]


BURST = (("burst_length", "n"), ("burst_duration", "ms"), ("burst_velocity", "CASE WHEN ms > 0 THEN n / (ms / 1000.0D) END"))


def with_bursts(st: DataFrame, cfg: PIConfig) -> DataFrame:
    """st with the number of its burst, a run of presses between pauses."""
    after = F.coalesce(F.lag("ud").over(in_order()) >= cfg.pause_ms, F.lit(False))
    return st.withColumn("_new", after.cast("int")).withColumn("burst", F.sum("_new").over(in_order())).drop("_new")


def bursts(st: DataFrame, cfg: PIConfig) -> DataFrame:
    """Measures of bursts; none in a window of one press."""
    b = with_bursts(st.withColumn("_n", F.count("*").over(Window.partitionBy(*G))).where("_n >= 2"), cfg).groupBy(*G, "burst").agg(F.count("*").cast("double").alias("n"), ((F.max("down") - F.min("down")) / 1000.0).alias("ms"))
    return b.groupBy(*G).agg(*(c for name, value in BURST for c in stats4(name, value, 0)))


def starts_word():
    return ~tokens.is_space(F.col("token")) & ((F.col("i") == 1) | tokens.is_space(F.col("tok0")))


def words(st: DataFrame) -> DataFrame:
    w = st.where(starts_word()).withColumn("ms", (F.lead("down").over(in_order()) - F.col("down")) / 1000.0)
    return w.groupBy(*G).agg(*stats4("inter_word_interval", "ms", 0))


def chords(st: DataFrame) -> DataFrame:
    return st.groupBy(*G).agg(*chord_list())


def chord_list() -> list:
    held = F.col("token").isin(*tokens.CATEGORIES["control"])
    ms = (F.greatest("up", "u1") - F.col("down")) / 1000.0
    out = []
    for name, key in CHORDS.items():
        hit = held & (F.col("tok1") == key)
        out += stats4(f"{name}_duration", F.when(hit, ms), 0) + scalar4(f"{name}_ratio", F.count_if(hit) / F.count("*"), 0)
    return out


def entropies(st: DataFrame) -> DataFrame:
    cat = geometry.entropy(st, G, "category", "_c").select(*G, *scalar4("key_category_entropy", "_c", 0))
    gram = geometry.entropy(st, G, "ngram", "_g").select(*G, *scalar4("ngram_distribution_entropy", "_g", 0))
    return cat.join(gram, G, "left")


def undefined() -> list:
    """Indicators that are declared without a definition: always null."""
    return [c for n in ("key_sequence_levenshtein_distance", "ngram_distribution_similarity", "rouge_l_similarity") for c in null4(n)]


def traced(wd: DataFrame, cfg: PIConfig) -> DataFrame:
    """wd with steps, the burst of every press (last: the press that stands for it), the way to the next word's start, and counts of categories and n-grams."""
    t = with_bursts(steps(wd, cfg.ngram), cfg)
    every, of = Window.partitionBy(*G), Window.partitionBy(*G, "burst")
    t = t.withColumns({"_n": F.count("*").over(every), "n": F.count("*").over(of).cast("double"), "ms": (F.max("down").over(of) - F.min("down").over(of)) / 1000.0, "last": F.lead(F.lit(1)).over(of.orderBy("down", "ord")).isNull()})
    t = t.withColumn("starts", F.coalesce(starts_word(), F.lit(False)))
    t = t.withColumn("word_ms", (F.lead("down").over(Window.partitionBy(*G, "starts").orderBy("down", "ord")) - F.col("down")) / 1000.0)
    for item in ("category", "ngram"):
        t = t.withColumns({f"{item}_n": F.count(item).over(every), f"{item}_c": F.count("*").over(Window.partitionBy(*G, item))})
    return t


def indicators(presses: DataFrame, cfg: PIConfig) -> DataFrame:
    wd = windows(presses, cfg)
    burst, word = only("last AND _n >= 2"), only("starts")
    entropy = lambda item: f"avg(CASE WHEN {item} IS NOT NULL THEN -log2({item}_c / {item}_n) END)"
    held = traced(wd, cfg).groupBy(*G).agg(
        F.count("*").alias("n_samples"), *count_list(), *hold_list(), *step_list(cfg), *chord_list(), *(c for name, value in BURST for c in stats4(name, burst(value), 0)),
        *stats4("inter_word_interval", word("word_ms"), 0), *scalar4("key_category_entropy", entropy("category"), 0), *scalar4("ngram_distribution_entropy", entropy("ngram"), 0),
    )
    return all_windows(presses, cfg).join(held, G, "left").fillna(0, ["n_samples"]).select("*", *undefined())
