"""The vocabulary: bytes 0-255, merged tokens, then the special tokens pad, eos, bos, unk."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from corpusflow.sources.config import SPECIAL_TOKENS

SCHEMA = (
    "token_id INT, bytes BINARY, left_id INT, right_id INT, pair_freq BIGINT, is_special BOOLEAN, name STRING"
)


@dataclass(frozen=True)
class Merge:
    left_id: int
    right_id: int
    pair_freq: int


@dataclass
class Vocabulary:
    """Small by construction (``vocab_size`` rows), so it is held on the driver and broadcast."""

    merges: list[Merge] = field(default_factory=list)
    special_names: dict[str, str] = field(default_factory=lambda: dict(SPECIAL_TOKENS))

    def __post_init__(self) -> None:
        tokens = [bytes([value]) for value in range(256)]
        for merge in self.merges:
            tokens.append(tokens[merge.left_id] + tokens[merge.right_id])
        self.tokens: list[bytes] = tokens
        # equal byte strings: the lower id is the one used for encoding
        self.ranks: dict[bytes, int] = {}
        for token_id, token in enumerate(tokens):
            self.ranks.setdefault(token, token_id)
        self.specials = {
            role: len(tokens) + place for place, role in enumerate(("pad", "eos", "bos", "unk"))
        }

    @property
    def n_vocab(self) -> int:
        return len(self.tokens) + len(self.specials)

    @property
    def pad_id(self) -> int:
        return self.specials["pad"]

    @property
    def eos_id(self) -> int:
        return self.specials["eos"]

    @property
    def bos_id(self) -> int:
        return self.specials["bos"]

    @property
    def unk_id(self) -> int:
        return self.specials["unk"]

    @property
    def dtype(self) -> str:
        """Narrowest unsigned type that holds every id."""
        return "uint16" if self.n_vocab < 65536 else "uint32"

    def token_id(self, name: str) -> int:
        """Id of a special token by its literal name."""
        for role, special_name in self.special_names.items():
            if special_name == name:
                return self.specials[role]
        raise KeyError(name)

    def all_bytes(self) -> list[bytes]:
        """Bytes of every id, special tokens (their names) included."""
        return self.tokens + [self.special_names[role].encode() for role in self.specials]

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = []
        for token_id, token in enumerate(self.tokens):
            merge = self.merges[token_id - 256] if token_id >= 256 else None
            rows.append(
                (
                    token_id,
                    bytearray(token),
                    merge.left_id if merge else None,
                    merge.right_id if merge else None,
                    merge.pair_freq if merge else None,
                    False,
                    None,
                )
            )
        for role, token_id in self.specials.items():
            name = self.special_names[role]
            rows.append((token_id, bytearray(name.encode()), None, None, None, True, name))
        return spark.createDataFrame(rows, SCHEMA)

    @staticmethod
    def from_df(df: DataFrame) -> "Vocabulary":
        rows = df.orderBy("token_id").collect()
        merges = [Merge(row.left_id, row.right_id, row.pair_freq) for row in rows if row.left_id is not None]
        names = [row.name for row in rows if row.is_special]
        if len(names) != 4:
            raise ValueError(f"a vocabulary has 4 special tokens, found {len(names)}")
        vocab = Vocabulary(merges, dict(zip(("pad", "eos", "bos", "unk"), names)))
        if vocab.n_vocab != len(rows):
            raise ValueError(f"vocabulary table has {len(rows)} rows, its merges give {vocab.n_vocab}")
        return vocab

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_df(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Vocabulary":
        return Vocabulary.from_df(spark.read.schema(SCHEMA).parquet(path))
