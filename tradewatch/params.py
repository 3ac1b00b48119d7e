"""Tunable parameters with their production defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


def _read(env: Mapping[str, str] | None, name: str, default, convert):
    env = os.environ if env is None else env
    return convert(env[name]) if name in env else default


@dataclass(frozen=True)
class SpoofingParams:
    """Alert when a window holds more than min_cancel_count cancels at a rate above min_cancel_rate."""

    window_sec: int = 120
    slide_sec: int = 30
    min_cancel_count: int = 10
    min_cancel_rate: float = 0.8
    watermark_sec: int = 5

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> SpoofingParams:
        return cls(
            window_sec=60 * _read(env, "WINDOW_SIZE_MIN", 2, int),
            slide_sec=_read(env, "WINDOW_SLIDE_SEC", cls.slide_sec, int),
            min_cancel_count=_read(env, "MIN_CANCEL_COUNT", cls.min_cancel_count, int),
            min_cancel_rate=_read(env, "MIN_CANCEL_RATE", cls.min_cancel_rate, float),
        )


@dataclass(frozen=True)
class WashParams:
    """Alert when a pair has at least min_match_count opposite fills within the tolerances."""

    window_sec: int = 300
    match_gap_sec: int = 30
    min_match_count: int = 3
    max_price_diff_pct: float = 0.5
    max_qty_diff_pct: float = 10.0
    watermark_sec: int = 5

    @property
    def price_tolerance(self) -> float:
        return self.max_price_diff_pct / 100.0

    @property
    def quantity_tolerance(self) -> float:
        return self.max_qty_diff_pct / 100.0

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> WashParams:
        return cls(
            window_sec=60 * _read(env, "WINDOW_SIZE_MIN", 5, int),
            match_gap_sec=_read(env, "MATCH_WINDOW_SEC", cls.match_gap_sec, int),
            min_match_count=_read(env, "MIN_MATCH_COUNT", cls.min_match_count, int),
            max_price_diff_pct=_read(env, "MAX_PRICE_DIFF_PCT", cls.max_price_diff_pct, float),
            max_qty_diff_pct=_read(env, "MAX_QTY_DIFF_PCT", cls.max_qty_diff_pct, float),
        )


@dataclass(frozen=True)
class LakeParams:
    """Cadence of the lake jobs, and how far back the first order cycle looks, None for all."""

    landing_sec: int = 60
    cycle_sec: int = 300
    lookback_hours: int | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> LakeParams:
        return cls(
            landing_sec=_read(env, "BATCH_SECONDS", cls.landing_sec, int),
            cycle_sec=_read(env, "INTERVAL_SECONDS", cls.cycle_sec, int),
            lookback_hours=_read(env, "LOOKBACK_HOURS", cls.lookback_hours, int),
        )


@dataclass(frozen=True)
class ExportParams:
    """Row limits of the exported samples, None for all rows; alerts are split evenly over the types."""

    alert_limit: int | None = None
    order_limit: int | None = None
    leg_limit: int | None = None


@dataclass(frozen=True)
class ServingParams:
    """Row limits of the analyst views, None for all rows."""

    feed_limit: int | None = None
    top_traders: int | None = None
    drilldown_limit: int | None = None
