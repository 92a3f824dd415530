"""Options of the engine, from environment variables or defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    symbols: tuple[str, ...] = ("BTC-USDT", "ETH-USDT")
    store: str = "candles-store"
    stream: str = "trades"
    checkpoint: str = "candles-checkpoint"
    allowed_lateness_ms: int = 5_000
    idle_grace_ms: int = 2_000
    max_skew_ms: int = 30_000
    dedup_window: int = 100_000
    batch_files: int = 1_000
    repair_lookback_ms: int = 86_400_000
    repair_every_s: int = 300

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, prefix: str = "CANDLES_") -> Settings:
        """Each field from its upper-case name with the prefix; symbols are separated by commas."""
        env = dict(os.environ) if env is None else env
        given = {}
        for f in fields(cls):
            value = env.get(prefix + f.name.upper())
            if value is None:
                continue
            if f.name == "symbols":
                given[f.name] = tuple(s.strip() for s in value.split(",") if s.strip())
            else:
                given[f.name] = int(value) if isinstance(f.default, int) else value
        return cls(**given)
