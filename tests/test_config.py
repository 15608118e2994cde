import json

import pytest

from corpusflow.sources.config import CorpusConfig, StepConfig, TokenizerConfig, WindowConfig

GOOD = dict(name="c", source="local", text_field="text", splits={"train": "train"}, path="/data")
WINDOW = dict(train_path="a", val_path="b", block_size=8, stride=4, dtype="uint16", eos_token_id=None, batch_size=2)
STEPS = dict(learning_rate=1e-3, min_lr=1e-4, warmup_ratio=0.1, max_steps=10)


@pytest.mark.parametrize(
    "change",
    [{"splits": {"validation": "v"}}, {"path": None}, {"source": "huggingface"}],
)
def test_corpus_config_rejects(change):
    with pytest.raises(ValueError):
        CorpusConfig(**{**GOOD, **change})


def test_hub_config_is_valid_without_path():
    assert CorpusConfig(**{**GOOD, "source": "huggingface", "path": None}).path is None


@pytest.mark.parametrize(
    "change",
    [{"block_size": 0}, {"stride": 0}, {"stride": 9}, {"batch_size": 0}, {"num_workers": -1}],
)
def test_window_config_rejects(change):
    with pytest.raises(ValueError):
        WindowConfig(**{**WINDOW, **change})


@pytest.mark.parametrize(
    "change",
    [
        {"learning_rate": 0},
        {"min_lr": -1},
        {"warmup_ratio": 1.5},
        {"max_steps": 0},
        {"accumulate_grad_batches": 0},
        {"scheduler": "linear"},
    ],
)
def test_step_config_rejects(change):
    with pytest.raises(ValueError):
        StepConfig(**{**STEPS, **change})


def test_tokenizer_config_needs_all_special_tokens():
    with pytest.raises(ValueError):
        TokenizerConfig("t", "BPE", 300, "d", special_tokens={"pad": "<pad>"})


def test_configs_from_files(tmp_path):
    (tmp_path / "c.yaml").write_text("name: c\nsource: local\ntext_field: text\npath: /data\nsplits:\n  train: train\n")
    assert CorpusConfig.from_file(tmp_path / "c.yaml") == CorpusConfig(**GOOD)
    (tmp_path / "s.json").write_text(json.dumps({**STEPS, "precision": "bf16-mixed"}))
    assert StepConfig.from_file(tmp_path / "s.json") == StepConfig(**STEPS)
