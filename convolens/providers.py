"""What a deployment can plug in: encoders, language models and enrichers, by kind and name."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame

from .operators.language import best_hint
from .operators.vectors import hashed_encoder


class Encoder(Protocol):
    """Texts to vectors of unit length; called in workers, so it must be picklable or load itself there."""

    def __call__(self, texts: list[str]) -> list[list[float]]: ...


class LanguageModel(Protocol):
    """A text column to struct<language, confidence>."""

    def __call__(self, text: Column) -> Column: ...


class Enricher(Protocol):
    """Scored mentions (mention_id and all columns of fact_mentions) to a fact table with mention_id; it must not collect."""

    def __call__(self, mentions: DataFrame) -> DataFrame: ...


_MADE: dict[tuple[str, str], Callable[..., Any]] = {("encoder", "hashed-ngrams"): hashed_encoder, ("language", "hints"): lambda **options: lambda text: best_hint(text, **options)}
KINDS = ("encoder", "language", "enricher")


def register(kind: str, name: str, make: Callable[..., Any]) -> None:
    """Offer ``make(**options)`` under a name; a name that is taken is replaced."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind of provider: {kind}")
    _MADE[kind, name] = make


def names(kind: str) -> list[str]:
    return sorted(n for k, n in _MADE if k == kind)


def make(kind: str, name: str, **options: Any) -> Any:
    if (kind, name) not in _MADE:
        raise ValueError(f"no {kind} named {name}; there are: {', '.join(names(kind)) or 'none'}")
    return _MADE[kind, name](**options)
