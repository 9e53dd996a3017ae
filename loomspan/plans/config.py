"""Settings of the indicator builders."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PIConfig:
    window_s: float = 60.0
    stride_s: float = 30.0
    screen_w: float = 1440.0
    screen_h: float = 900.0
    timezone: str = "Asia/Seoul"
    pause_ms: float = 2000.0
    ngram: int = 2
    holdtime_mode: str = "paired_rows"

    def __post_init__(self):
        if self.window_s <= 0 or self.stride_s <= 0:
            raise ValueError("window and stride must be positive")
        if self.ngram < 1 or self.holdtime_mode not in ("paired_rows", "event_pairing", "auto"):
            raise ValueError("ngram must be positive, and holdtime_mode paired_rows, event_pairing or auto")

    @staticmethod
    def ms(seconds: float) -> int:
        return round(seconds * 1000)

    @staticmethod
    def us(seconds: float) -> int:
        return round(seconds * 1_000_000)
