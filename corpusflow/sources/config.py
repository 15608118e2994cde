"""Configuration records.  They live on the driver and are checked when they are built."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

#: File suffixes and the Spark reader used for each.
READERS = {".parquet": "parquet", ".json": "json", ".jsonl": "json", ".csv": "csv", ".txt": "text", ".orc": "orc"}

#: Default names of the special tokens, in id order.
SPECIAL_TOKENS = {"pad": "<pad>", "eos": "<eos>", "bos": "<bos>", "unk": "<unk>"}


def load_mapping(path: str | Path) -> dict[str, Any]:
    """Read a config file: YAML when PyYAML is there, JSON always."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError(f"{path}: YAML configs need PyYAML; use JSON instead") from error
    return yaml.safe_load(text)


class _FromFile:
    @classmethod
    def from_file(cls, path: str | Path):
        return cls(**load_mapping(path))


def _require(condition: bool, message: str) -> None:
    if not condition:
        raise ValueError(message)


@dataclass
class CorpusConfig(_FromFile):
    """Where a corpus is and how its splits are named.

    ``source`` is ``local`` (a file or folder at ``path``) or ``huggingface`` (known, but fetching from
    the hub is outside this engine).  ``id_field`` names a unique integer column; without it ids come
    from the position of a row in its file.
    """

    name: str
    source: str
    text_field: str
    splits: dict[str, str]
    config_name: str | None = None
    path: str | None = None
    format: str | None = None
    id_field: str | None = None

    def __post_init__(self) -> None:
        _require("train" in self.splits, "splits must have a 'train' entry")
        _require(not (self.source == "local" and not self.path), "a local corpus needs a path")
        _require(not (self.source == "huggingface" and self.path), "a hub corpus takes no path")


@dataclass
class TokenizerConfig(_FromFile):
    """Vocabulary size, special-token names, and where results go."""

    name: str
    type: str
    vocab_size: int
    dataset_config: str
    special_tokens: dict[str, str] = field(default_factory=lambda: dict(SPECIAL_TOKENS))
    output_dir: str = ""
    tokenized_output_dir: str = ""
    val_split: float = 0.05
    num_threads: int | None = None  # accepted for compatibility; Spark decides the parallelism

    def __post_init__(self) -> None:
        missing = [role for role in SPECIAL_TOKENS if role not in self.special_tokens]
        _require(not missing, f"special_tokens lacks {missing}")


@dataclass
class WindowConfig(_FromFile):
    """Geometry of training windows and batches."""

    train_path: str
    val_path: str
    block_size: int
    stride: int
    dtype: str
    eos_token_id: int | None
    batch_size: int
    num_workers: int = 0  # accepted for compatibility
    pin_memory: bool = False  # accepted for compatibility
    drop_last: bool = False

    def __post_init__(self) -> None:
        check_window_arguments(self.block_size, self.stride)
        _require(self.batch_size > 0, "batch_size must be positive")
        _require(self.num_workers >= 0, "num_workers must not be negative")


@dataclass
class StepConfig(_FromFile):
    """What the step plan needs to know about a training run; other training settings are ignored."""

    learning_rate: float
    min_lr: float
    warmup_ratio: float
    max_steps: int
    accumulate_grad_batches: int = 1
    scheduler: str = "cosine"

    def __post_init__(self) -> None:
        _require(self.learning_rate > 0, "learning_rate must be positive")
        _require(self.min_lr >= 0, "min_lr must not be negative")
        _require(0 <= self.warmup_ratio <= 1, "warmup_ratio must lie between 0 and 1")
        _require(self.max_steps > 0, "max_steps must be positive")
        _require(self.accumulate_grad_batches > 0, "accumulate_grad_batches must be positive")
        _require(self.scheduler in ("cosine", "none"), "scheduler must be 'cosine' or 'none'")

    @classmethod
    def from_file(cls, path: str | Path) -> "StepConfig":
        known = cls.__dataclass_fields__
        return cls(**{key: value for key, value in load_mapping(path).items() if key in known})


def check_window_arguments(block_size: int, stride: int) -> None:
    _require(block_size > 0, "block_size must be positive")
    _require(stride > 0, "stride must be positive")
    _require(stride <= block_size, "stride must not be larger than block_size")
