"""All thresholds, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    # sessions
    tiny_shares: int = 100
    at_offer_max: float = 90.0
    thin_minutes: int = 60
    thin_share: float = 0.80
    crawler_price: float = 100.0
    midpoint: int = 11 * 60 + 15
    full_range: int = 13 * 60 + 10
    close_cutoff: int = 12 * 60 + 30
    max_sessions_back: int | None = None  # the oldest session that a previous close may come from
    active_sessions: int = 20
    # clock: minutes of the local day; weekend in dayofweek numbers (Friday, Saturday)
    window_start: int = 9 * 60
    window_end: int = 13 * 60
    close_minute: int = 13 * 60 + 30
    weekend: tuple[int, ...] = (6, 7)
    # intraday signals
    no_protection_bid: int = 20_000
    buyers_ratio: float = 1.6
    big_qty: int = 100_000
    bait_age: int = 300
    tiny_trade: int = 100
    wall_qty: int = 200_000
    # wake-up
    pace_min: float = 3.0
    trades_min: int = 20
    baseline_sessions: int = 10
    wakeup_slots: tuple[int, ...] = (4, 5, 6, 7, 8)
    throttle_secs: int = 60
    # scoring
    score_minutes: tuple[int, ...] = (5, 15, 60)
    min_move: float = 1.0
    # bars and swings
    min_captures: int = 10
    spike_multiple: float = 2.0
    min_swing: float = 2.0
    target_floor: float = 2.0
    fib_levels: tuple[float, ...] = (0.236, 0.382, 0.5, 0.618, 0.786)
    # capture
    sources: tuple[str, ...] = ("client", "server")  # highest precedence first
    late_minutes: int = 15
    early_seconds: int = 60
    gap_secs: int = 90
    fresh_secs: int = 60
    stale_secs: int = 300
    min_coverage: float = 0.5
    label_confidence: float = 0.9
    max_price: float = 1e6
    max_qty: float = 1e15
    max_level: int = 20


LIMITS = Limits()
