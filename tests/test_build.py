"""From a corpus folder to vocabulary, token files, metadata and a subset."""

import json

from corpusflow.operators.vocabulary import Vocabulary
import pytest

from corpusflow.__main__ import main
from corpusflow.plans.build import corpus_report, create_subset, tokenize_corpus, train_tokenizer, training_batches
from corpusflow.sources.config import CorpusConfig, TokenizerConfig, WindowConfig, load_mapping
from corpusflow.sources.token_bin import read_windows, token_count


def make(tmp_path, documents, with_validation):
    rows = documents.select("doc_id", "text")
    rows.where("doc_id % 10 > 0" if with_validation else "true").write.parquet(str(tmp_path / "corpus" / "train"))
    if with_validation:
        rows.where("doc_id % 10 = 0").write.parquet(str(tmp_path / "corpus" / "validation"))
    corpus = dict(
        name="c", source="local", text_field="text", id_field="doc_id", path=str(tmp_path / "corpus"),
        splits={"train": "train", "validation": "validation"},
    )
    (tmp_path / "corpus.json").write_text(json.dumps(corpus))
    return TokenizerConfig(
        "t", "BPE", 268, str(tmp_path / "corpus.json"),
        output_dir=str(tmp_path / "vocab"), tokenized_output_dir=str(tmp_path / "tokens"), val_split=0.1,
    )


def run(spark, config):
    vocab = train_tokenizer(spark, config).vocab
    assert Vocabulary.load(spark, f"{config.output_dir}/vocabulary") == vocab
    stream = tokenize_corpus(spark, config)
    meta = spark.read.json(f"{config.tokenized_output_dir}/metadata").collect()[0].asDict(recursive=True)
    for name, split in (("train", "train"), ("val", "validation")):
        files = f"{config.tokenized_output_dir}/tokens/{split}"
        assert meta[f"{name}_tokens"] == stream.totals[split] == token_count(files, meta["dtype"])
    return vocab, meta


def test_with_held_out_validation(spark, documents, tmp_path):
    config = make(tmp_path, documents, False)
    vocab, meta = run(spark, config)
    assert (meta["train_examples"], meta["val_examples"], meta["seed"], meta["val_split"]) == (180, 20, 42, 0.1)
    assert not meta["used_existing_split"] and meta["vocab_size"] == vocab.n_vocab == 268
    tokens = f"{config.tokenized_output_dir}/tokens"
    create_subset(spark, tokens, str(tmp_path / "sub"), {"train": 1000, "validation": 100})
    assert token_count(f"{tmp_path}/sub/train", "uint16") == 1000
    first = read_windows(spark, f"{tokens}/train", 64, 64).where("window_id < 3").collect()
    sub = read_windows(spark, f"{tmp_path}/sub/train", 64, 64).where("window_id < 3").collect()
    assert sorted(first) == sorted(sub)
    data = WindowConfig(
        f"{tokens}/train", f"{tokens}/validation", 64, 64, meta["dtype"], vocab.eos_id, batch_size=10, drop_last=True
    )
    train, held_out = training_batches(spark, data, context_length=64)
    windows = {name: (meta[f"{name}_tokens"] - 65) // 64 + 1 for name in ("train", "val")}
    assert train.count() == windows["train"] // 10 * 10 and held_out.count() == windows["val"]
    assert train.where("array_contains(y, -100)").count() == 0 < held_out.where("array_contains(y, -100)").count()
    with pytest.raises(ValueError, match="context"):
        training_batches(spark, data, context_length=63)


def test_with_existing_validation(spark, documents, tmp_path):
    config = make(tmp_path, documents, True)
    vocab, meta = run(spark, config)
    assert meta["used_existing_split"] and "seed" not in meta
    assert (meta["train_examples"], meta["val_examples"]) == (180, 20)
    # documents follow each other as stored
    window = read_windows(spark, f"{config.tokenized_output_dir}/tokens/train", 16, 16).where("window_id = 0").first()
    text = documents.where("doc_id = 1").first().text
    spelled = b"".join(vocab.all_bytes()[i] for i in window.x[1:])
    assert window.x[0] == vocab.bos_id and text.encode().startswith(spelled)
    report = corpus_report(spark, CorpusConfig(**load_mapping(config.dataset_config)))
    assert {(r["split"], r.original) for r in report.collect()} == {("train", 180), ("validation", 20)}


def test_command_line(spark, documents, tmp_path, capsys):
    config = make(tmp_path, documents, False)
    (tmp_path / "t.json").write_text(json.dumps({k: v for k, v in vars(config).items()}))
    main(["report", "--config", str(tmp_path / "corpus.json")])
    main(["train-tokenizer", "--config", str(tmp_path / "t.json")])
    main(["tokenize", "--config", str(tmp_path / "t.json")])
    assert "train:" in capsys.readouterr().out
    tokens = f"{config.tokenized_output_dir}/tokens"
    main(["subset", "--source", tokens, "--target", f"{tmp_path}/s", "--train-tokens", "50", "--val-tokens", "7"])
    assert token_count(f"{tmp_path}/s/validation", "uint16") == 7
