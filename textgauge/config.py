"""Settings of the corpus, scoring and gate jobs.

Plain frozen dataclasses; each checks its own ranges when built.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# Label codes, label names and default shares.
HUMAN = 0
AI = 1
UNKNOWN = -1
CLASSES = (HUMAN, AI)
LABEL_CODES = {"human": HUMAN, "ai": AI}
CLASS_NAMES = {HUMAN: "human", AI: "ai"}
SEED = 42


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


@dataclass(frozen=True)
class CorpusConfig:
    """How a raw ``(key, text, source)`` table becomes a training corpus."""

    text: str = "text"
    label: str = "generated"
    source: str = "source"
    drop_duplicates: bool = True
    min_length: int = 50
    max_length: int = 5000
    lowercase: bool = False
    strip_whitespace: bool = True  # the final strip makes the result the same either way
    drop_special: bool = False
    balance: bool = True
    seed: int = SEED

    def __post_init__(self):
        _require(self.min_length >= 0, "min_length must not be negative")
        _require(self.max_length > self.min_length, "max_length must exceed min_length")

    def params(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class QualityConfig:
    """Limits of the table quality gate.  Fixed values: the defaults."""

    expected_columns: tuple[str, ...] = ("text", "generated", "source")
    required_columns: tuple[str, ...] = ("text", "generated")
    text: str = "text"
    label: str = "generated"
    min_length: int = 10
    max_length: int = 10000
    expected_labels: tuple[int, ...] = CLASSES
    min_class_rows: int = 100
    max_null_fraction: float = 0.05
    min_balance: float = 0.5

    def __post_init__(self):
        _require(self.max_length > self.min_length, "max_length must exceed min_length")
        _require(0 <= self.max_null_fraction <= 1, "max_null_fraction must lie in [0, 1]")
        _require(self.min_class_rows > 0, "min_class_rows must be positive")


@dataclass(frozen=True)
class SplitConfig:
    """Shares of the stratified three-way split."""

    validation: float = 0.15
    test: float = 0.15
    seed: int = SEED

    def __post_init__(self):
        _require(self.validation > 0 and self.test > 0, "shares must be positive")
        _require(self.validation + self.test < 1, "the shares must leave rows to train on")


@dataclass(frozen=True)
class ScoreConfig:
    """Batch and stream scoring."""

    text: str = "text"
    batch_size: int = 32
    max_tokens: int | None = None  # only for a model that has an input window
    light_clean: bool = True
    class_names: tuple[str, ...] = ("human", "ai")

    def __post_init__(self):
        _require(self.batch_size > 0, "batch_size must be positive")
        _require(self.max_tokens is None or self.max_tokens > 0, "max_tokens must be positive")


@dataclass(frozen=True)
class TrainConfig:
    """Linear text classifier and the rule that ends its parameter search."""

    features: int = 1 << 18
    max_tokens: int | None = None
    min_texts: int = 2  # a token of fewer training texts has no weight
    max_iter: int = 50
    reg_ladder: tuple[float, ...] = (1.0, 0.3, 0.1, 0.03, 0.01, 0.003, 0.001)
    patience: int = 5
    min_gain: float = 0.001
    split: SplitConfig = field(default_factory=SplitConfig)


@dataclass(frozen=True)
class GateConfig:
    """Release limits for a scored test set.  Fixed values: the defaults."""

    min_accuracy: float = 0.85
    min_f1: float = 0.85
    min_precision: float = 0.80
    min_recall: float = 0.80
    min_auc: float = 0.85
    max_brier: float = 0.25
    max_ece: float = 0.1
    bins: int = 10
    min_class_f1: float = 0.75
    min_support: int = 10
    max_imbalance: float = 3.0
    max_prediction_share: float = 0.8
    allowed_labels: tuple[int, ...] = CLASSES
    replicates: int = 1000
    seed: int = SEED

    def __post_init__(self):
        for name in ("min_accuracy", "min_f1", "min_precision", "min_recall", "min_auc"):
            _require(0 <= getattr(self, name) <= 1, f"{name} must lie in [0, 1]")
        _require(self.bins > 0, "bins must be positive")
