"""Numeric kernels on arrays: spectra, peaks, pitch. NumPy only, applied to whole arrays by Arrow-backed UDFs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def doubles(*names: str) -> T.StructType:
    """A struct of doubles. UDFs take types, not text, as text needs a session when the module is imported."""
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


RHYTHM = doubles("rate", "entropy", "regularity")


def strongest(y: np.ndarray, power: np.ndarray) -> int:
    """Place of the largest power (0 is the first bin above 0 Hz). Those equal but for rounding are summed again term by term in time's order, as SQL does, with the C library's sines, as NumPy's differ from them in the last bit on some processors; of what is equal still, the lowest."""
    near = np.flatnonzero(power >= power.max() * (1 - 1e-9))
    if len(near) == 1:
        return int(near[0])
    n, i = len(y), np.arange(len(y))
    z = y - np.cumsum(y)[-1] / n
    cos, sin = (np.array([f(2 * math.pi * m / n) for m in range(n)]) for f in (math.cos, math.sin))
    again = []
    for k in near + 1:
        mag = math.sqrt(math.pow(np.cumsum(z * cos[k * i % n])[-1], 2) + math.pow(np.cumsum(z * sin[k * i % n])[-1], 2))
        again.append(mag * mag)
    return int(near[np.argmax(again)])


def power_spectrum_features(y: np.ndarray, fs: float) -> tuple:
    """Dominant frequency, entropy in bits and peak over mean of the power spectrum above 0 Hz; none for fewer than four values or a constant."""
    y = y[~np.isnan(y)]
    if len(y) < 4 or not fs > 0:
        return None, None, None
    power = np.abs(np.fft.rfft(y - y.mean()))[1:] ** 2
    freq = np.fft.rfftfreq(len(y), 1 / fs)[1:]
    if not power.any():
        return None, None, None
    i, p = strongest(y, power), power / power.sum()
    return float(freq[i]), float(-(p * np.log2(p + 1e-12)).sum()), float(power[i] / (power.mean() + 1e-12))


def band_features(y: np.ndarray, fs: float, low: float, high: float) -> tuple:
    """The same of the magnitude spectrum within a band; entropy is none where the band is silent."""
    if len(y) < 4:
        return None, None, None
    mag, freq = np.abs(np.fft.rfft(y - y.mean())), np.fft.rfftfreq(len(y), 1 / fs)
    band = (freq >= low) & (freq <= high) & (freq > 0)
    if not band.any():
        return None, None, None
    m, f = mag[band], freq[band]
    p = m / m.sum() if m.sum() > 0 else np.zeros(0)
    p = p[p > 0]
    return float(f[m.argmax()]), float(-(p * np.log2(p)).sum()) if m.sum() > 0 else None, float(m.max() / (m.mean() + 1e-12))


@F.pandas_udf(T.DoubleType())
def direction(dy: pd.Series, dx: pd.Series) -> pd.Series:
    """Angle of a step by the C library's atan2, which DuckDB calls too; the JVM's differs from it in the last bit here and there."""
    return pd.Series([math.atan2(b, a) for b, a in zip(dy.to_list(), dx.to_list(), strict=True)], dtype="float64")


def arrays(col: pd.Series) -> list[np.ndarray]:
    return [np.zeros(0) if x is None else np.asarray(x, dtype=float) for x in col]


@F.pandas_udf(RHYTHM)
def power_rhythm(ys: pd.Series, fs: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([power_spectrum_features(y, np.nan if f is None else f) for y, f in zip(arrays(ys), fs, strict=True)], columns=["rate", "entropy", "regularity"])


@F.pandas_udf(RHYTHM)
def band_rhythm(ys: pd.Series, fs: pd.Series, low: pd.Series, high: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([band_features(y, f, a, b) for y, f, a, b in zip(arrays(ys), fs, low, high, strict=True)], columns=["rate", "entropy", "regularity"])


def peaks(y: np.ndarray, distance: int, height: float | None) -> np.ndarray:
    """Local maxima (a plateau counts once, at its middle) of at least `height`; of two closer than `distance` the higher stays, of equal ones the later."""
    if len(y) < 3:
        return np.zeros(0, int)
    edge = np.flatnonzero(y[1:] != y[:-1]) + 1  # where runs of equal values start
    first, last = np.concatenate(([0], edge)), np.concatenate((edge, [len(y)])) - 1
    v = y[first]
    top = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1
    at = (first[top] + last[top]) // 2
    if height is not None:
        at = at[y[at] >= height]
    return at[unsuppressed(at.tolist(), np.argsort(y[at], kind="stable")[::-1].tolist(), distance)]


def unsuppressed(at: list[int], order: list[int], distance: int) -> np.ndarray:
    """Which of ascending places stay if each in turn puts out those nearer than `distance`: a list linked both ways, from which a place goes once."""
    n = len(at)
    before, after, keep = list(range(-1, n - 1)), list(range(1, n + 1)), np.ones(n, bool)
    for k in order:
        if not keep[k]:
            continue
        for step in (before, after):
            j = step[k]
            while 0 <= j < n and abs(at[j] - at[k]) < distance:
                keep[j] = False
                j = step[j]
            step[k] = j
        if before[k] >= 0:
            after[before[k]] = k
        if after[k] < n:
            before[after[k]] = k
    return keep


@F.pandas_udf(T.IntegerType())
def count_syllables(ys: pd.Series) -> pd.Series:
    """Peaks of speech envelopes: 8 frames apart, at or above the 75th percentile where there is speech."""
    return pd.Series([len(peaks(y, 8, float(np.percentile(y, 75)) if (y > 0).any() else None)) for y in arrays(ys)], dtype="int32")


def yin(y: np.ndarray, sr: int, **options) -> np.ndarray:
    """yin_rows() of one signal."""
    return yin_rows(np.asarray(y, float)[None], sr, **options)[0]


def yin_rows(ys: np.ndarray, sr: int, low: float = 50.0, high: float = 500.0, frame_s: float = 0.025, hop_s: float = 0.01, threshold: float = 0.1) -> np.ndarray:
    """Fundamental frequency of each frame (columns) of signals of one length (rows) by YIN: cumulative mean normalised difference, first dip below the threshold (else the lowest), parabolic refinement.

    Frames are centred with zeros around the signal. A lag can be at most half a frame, so with frames of 25 ms the lowest pitch found is 80 Hz. Short signals are taken together, up to FRAMES frames.
    """
    frame, hop = round(frame_s * sr), round(hop_s * sr)
    half = frame // 2
    longest, shortest = min(half - 1, int(np.ceil(sr / low))), max(1, int(np.floor(sr / high)))
    if longest <= shortest + 1:
        return np.zeros((len(ys), 0))
    ys = np.pad(np.asarray(ys, float), ((0, 0), (half, half)))
    count = 1 + (ys.shape[1] - frame) // hop
    view = np.lib.stride_tricks.sliding_window_view(ys, frame, axis=1)[:, : (count - 1) * hop + 1 : hop]
    step, out = max(1, FRAMES // count), []
    for at in range(0, len(ys), step):
        rows = view[at] if step == 1 else view[at : at + step].reshape(-1, frame)
        out.append(np.concatenate([pitch_of(rows[lo : lo + FRAMES], sr, longest, shortest, threshold) for lo in range(0, len(rows), FRAMES)]).reshape(-1, count))
    return np.concatenate(out)


#: Frames that are transformed at once.
FRAMES = 4096


def differences(rows: np.ndarray, width: int, lags: int) -> np.ndarray:
    """Sums of squared differences of each frame's first `width` values and those `lag` later, for lags below `lags`, by correlation in the frequency domain."""
    size = 1 << (rows.shape[1] + width - 1).bit_length()
    shared = np.fft.irfft(np.conj(np.fft.rfft(rows[:, :width], size)) * np.fft.rfft(rows, size), size)[:, :lags]
    energy = np.concatenate((np.zeros((len(rows), 1)), np.cumsum(rows**2, 1)), 1)
    both = energy[:, [width]] + energy[:, width : width + lags] - energy[:, :lags]
    out = both - 2 * shared
    return np.where(out > 1e-12 * both, out, 0.0)  # what is below is rounding


def pitch_of(rows: np.ndarray, sr: int, longest: int, shortest: int, threshold: float) -> np.ndarray:
    """Pitch of each frame."""
    lags = longest + 2
    diff = differences(rows, rows.shape[1] - longest - 1, lags)
    mean = np.cumsum(diff[:, 1:], 1) / np.arange(1, lags)
    norm = np.ones_like(diff)
    norm[:, 1:] = np.divide(diff[:, 1:], mean, out=np.ones_like(mean), where=mean > 0)
    cand = norm[:, shortest : longest + 1]
    good = np.zeros(cand.shape, bool)
    good[:, 1:-1] = (cand[:, 1:-1] < cand[:, :-2]) & (cand[:, 1:-1] <= cand[:, 2:]) & (cand[:, 1:-1] < threshold)
    k = shortest + np.where(good.any(1), good.argmax(1), cand.argmin(1))
    a, b, c = (norm[np.arange(len(norm)), i] for i in (k - 1, k, np.minimum(k + 1, longest + 1)))
    bend = a - 2 * b + c
    fits = (bend > 0) & (np.abs(a - c) < 2 * bend)
    return sr / (k + np.where(fits, 0.5 * (a - c) / np.where(fits, bend, 1.0), 0.0))


def frame_rms(y: np.ndarray, rate: int, frame_s: float = 0.025, hop_s: float = 0.01) -> np.ndarray:
    """Root mean square of full frames of a signal, or of each of several (rows), in single precision; a shorter signal is padded to one frame."""
    size, hop = round(frame_s * rate), round(hop_s * rate)
    if y.shape[-1] < size:
        y = np.pad(y, [(0, 0)] * (y.ndim - 1) + [(0, size - y.shape[-1])])
    rows = np.lib.stride_tricks.sliding_window_view(y.astype(np.float32), size, axis=-1)[..., ::hop, :]
    return np.sqrt((rows**2).mean(-1, dtype=np.float32) + np.float32(1e-12)).astype(np.float32)


def tracked(y: np.ndarray, rate: int) -> tuple[np.ndarray, list]:
    """(rms, pitch) of a signal's frames; a frame beyond the pitch track has none."""
    rms = frame_rms(y, rate)
    f0 = yin(y, rate)[: len(rms)]
    return rms, [*f0.tolist(), *[None] * (len(rms) - len(f0))]


def tracked_rows(ys: np.ndarray, rate: int) -> list[list[dict]]:
    """Loudness and pitch of the frames of signals of one length; a frame beyond the pitch track has no pitch."""
    rms = frame_rms(ys, rate)
    f0 = yin_rows(ys, rate)[:, : rms.shape[1]]
    rest = [None] * (rms.shape[1] - f0.shape[1])
    return [[{"rms": a, "f0": b} for a, b in zip(r, [*f, *rest], strict=True)] for r, f in zip(rms.tolist(), f0.tolist(), strict=True)]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("rms", T.FloatType()), T.StructField("f0", T.DoubleType())])))
def track(ys: pd.Series, rates: pd.Series) -> pd.Series:
    """Loudness and pitch of the frames of whole signals; those of one length and rate are transformed together, 256 at most."""
    signals, out = arrays(ys), [None] * len(ys)
    alike: dict[tuple, list[int]] = {}
    for i, (y, rate) in enumerate(zip(signals, rates, strict=True)):
        alike.setdefault((len(y), int(rate)), []).append(i)
    for (_, rate), members in alike.items():
        for lo in range(0, len(members), 256):
            some = members[lo : lo + 256]
            for i, frames in zip(some, tracked_rows(np.stack([signals[j] for j in some]), rate), strict=True):
                out[i] = frames
    return pd.Series(out, dtype=object)


def moving_average(y: np.ndarray, width: int) -> np.ndarray:
    """Centred mean with zeros beyond the ends, in single precision."""
    width = min(width, len(y))
    return y if width <= 1 else np.convolve(y, np.ones(width, np.float32) / width, "same").astype(np.float32)


PITCH = doubles("variability", "span", "extent", "rate")


@F.pandas_udf(PITCH)
def pitch_shape(f0s: pd.Series) -> pd.DataFrame:
    """Spread, 5-95 % range, tremor extent and rate of voiced frames' pitch in semitones above 55 Hz."""
    out = []
    for f0 in arrays(f0s):
        if not len(f0):
            out.append((None,) * 4)
            continue
        st = 12 * np.log2(np.maximum(f0, 1e-9) / 55)
        rest = st - moving_average(st, 50).astype(float)
        out.append((float(st.std()), float(np.percentile(st, 95) - np.percentile(st, 5)), float(np.sqrt((rest**2).mean())), band_features(rest, 100.0, 3, 12)[0]))
    return pd.DataFrame(out, columns=["variability", "span", "extent", "rate"])
