"""Settings of the engine's stages, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Processing:
    extract_tables: bool = True
    extract_images: bool = True
    extract_formulas: bool = True
    use_ocr: bool = False
    ocr_languages: tuple[str, ...] = ("eng",)
    output_format: str = "markdown"

    def __post_init__(self) -> None:
        if self.output_format not in ("markdown", "json", "full"):
            raise ValueError(f"output_format: {self.output_format}")
        if wrong := set(self.ocr_languages) - {"eng", "rus", "chi_sim", "chi_tra"}:
            raise ValueError(f"ocr_languages: {sorted(wrong)}")


@dataclass(frozen=True)
class Chunking:
    longest: int = 6000
    overlap: int = 500
    shortest: int = 1000


@dataclass(frozen=True)
class Gates:
    basic: float = 70.0
    enhancement: float = 0.7
    final: float = 80.0
    level4: float = 80.0
    overall: float = 0.85
    most_issues: int = 10


@dataclass(frozen=True)
class Pipeline:
    language: str = "ru"
    processing: Processing = field(default_factory=Processing)
    chunking: Chunking = field(default_factory=Chunking)
    gates: Gates = field(default_factory=Gates)
    #: Attempts of a model call and the cost limit: a document falls back when more than half of its pieces failed.
    attempts: int = 3
    #: Levels 2 and 5 of quality too, and level 3's meaning from word vectors that the documents train.
    correct: bool = False
    trained_meaning: bool = False
