"""Contracts of the models that the pipeline calls, and their batching over partitions.

A model is loaded once per task; a row on which it fails becomes a row with an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Phonemizer(Protocol):
    def __call__(self, sentences: list[str]) -> list[str]:
        """One line of phonemes per sentence."""


class Transcriber(Protocol):
    def __call__(self, samples: list[float]) -> str: ...


class SpeakerEncoder(Protocol):
    def __call__(self, samples: list[float]) -> list[float]: ...


class Synthesizer(Protocol):
    def __call__(self, sentence: str) -> bytes: ...


def phonemize(rows: DataFrame, load: Callable[[], Phonemizer], column: str = "sentence", batch: int = 200) -> DataFrame:
    """(column, phonemes) in batches; a batch that gives another number of lines is done one by one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            sentences = frame[column].tolist()
            out: list[str] = []
            for k in range(0, len(sentences), batch):
                part = sentences[k : k + batch]
                lines = model(part)
                if len(lines) != len(part):
                    lines = ["".join(model([s])[:1]) for s in part]
                out += lines
            yield pd.DataFrame({column: sentences, "phonemes": out})

    return rows.select(column).mapInPandas(run, f"{column} string, phonemes string")


def apply_model(rows: DataFrame, load: Callable[[], Callable], key: str, column: str, kind: str) -> DataFrame:
    """(key, value, error) for a transcriber, an encoder or a synthesiser."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            out = []
            for k, v in zip(frame[key], frame[column], strict=True):
                try:
                    out.append((k, model(v), None))
                except Exception as e:
                    out.append((k, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[key, "value", "error"])

    return rows.select(key, column).mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, value {kind}, error string")
