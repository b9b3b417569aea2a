"""Settings, all of them parameters; nothing is read from the environment."""

from __future__ import annotations

from dataclasses import dataclass

SOURCES = ("catalunya", "valencia", "galicia")
FORMATS = ("json", "xml", "csv")
MODES = ("RULES", "FUZZY", "LLM")
PROVIDERS = ("groq", "openai", "anthropic", "google", "stub")


@dataclass(frozen=True)
class EngineConfig:
    mode: str = "RULES"
    fuzzy_high: float = 0.85
    fuzzy_low: float = 0.70
    fuzzy_top: int = 3
    model_provider: str = "stub"
    model_batch: int = 5
    model_timeout_s: float = 10.0
    model_min_delay_ms: int = 4000
    files_per_trigger: int = 100
    trigger_ms: int = 50
    model_callers: int = 1
    sink_retries: int = 3
    sink_base_ms: int = 200
    redelivery: str = "1 hour"
    table_folders: int = 64
    dedup_scope: str = "message_id"
    strict_timing: bool = False
    max_file_bytes: int = 50 * 1024 * 1024

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if self.model_provider not in PROVIDERS:
            raise ValueError(f"model_provider must be one of {PROVIDERS}")
        if not 1 <= self.model_timeout_s <= 30:
            raise ValueError("model_timeout_s must be between 1 and 30")
        if not 0 <= self.fuzzy_low <= self.fuzzy_high <= 1:
            raise ValueError("0 <= fuzzy_low <= fuzzy_high <= 1")


def bounded(name: str, value: float, low: float, high: float) -> float:
    """The value, if it lies within the bounds of the interface."""
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}")
    return value
