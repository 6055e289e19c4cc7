"""Thresholds and targets of the pipeline, all parameters of one record."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Curation:
    target_size: int = 12_000
    bigram_floor: int = 50
    bigram_floor_rare: int = 20
    sample_size: int = 256
    accent_weight: float = 2.0
    balance_weight: float = 5.0
    length_target: dict[str, float] = field(default_factory=lambda: {"short": 0.40, "med": 0.40, "long": 0.20})
    prosody_target: dict[str, float] = field(default_factory=lambda: {"declarative": 0.60, "interrogative": 0.20, "exclamatory": 0.10, "complex": 0.10})


@dataclass(frozen=True)
class Quality:
    sample_rate: int = 16_000
    ratio_min: float = 0.04
    ratio_max: float = 0.12
    clip_peak: float = 0.999
    rms_min: float = 0.005
    silence_db: float = -40.0
    silence_ms: int = 800
    edge_s: float = 0.1
    hop: int = 160
    wer_max: float = 0.08
    sigmas: float = 3.0
    axes: tuple[str, ...] = ("duration_s", "rms", "f0_mean", "centroid")
    min_hours: float = 2.0


@dataclass(frozen=True)
class Evaluation:
    ecapa_weight: float = 0.35
    wavlm_weight: float = 0.25
    wer_weight: float = 0.30
    #: Stands for a fourth metric that isn't measured.
    constant: float = 0.06
    variance_weight: float = 0.5
    band: tuple[float, float] = (0.55, 0.75)
    eval_size: int = 250
    seed: int = 20260523


@dataclass(frozen=True)
class Progress:
    target: int = 12_000
    stall_minutes: int = 60
    quiet_ticks: int = 2
    most_restarts: int = 10
    retries: int = 5
