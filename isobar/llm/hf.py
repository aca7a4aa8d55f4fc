"""Whole-text token ids as the tokenizers library gives them, resolving each distinct piece once."""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import SparkSession

from .pretoken import PieceEncoder, split_spaced, split_words


def read_tokenizer(spark: SparkSession, path: str) -> str:
    """The tokenizer file's text; a plain path is the driver's own file."""
    if "://" in path:
        return spark.sparkContext.wholeTextFiles(path).first()[1]
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + k for k, b in enumerate(rest)}


_APART = "\U0010ffff"
_SPLITS = {"spaced": split_spaced, "words": split_words}


def prepared(spec: str) -> tuple[str, str, bool]:
    """The file's text, the splitter that its pre-tokenizer amounts to, and whether text is normalised and lower-cased first.

    The driver finds this out once; workers needn't read the whole vocabulary as JSON.
    """
    return spec, *_plan(json.loads(spec))


def _plan(spec: dict) -> tuple[str, bool]:
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and norm is None:
        return "spaced", False
    steps = [p.get("type") for p in pre.get("pretokenizers", [])]
    if steps == ["Split", "ByteLevel"] and not pre["pretokenizers"][1].get("use_regex", True):
        split = pre["pretokenizers"][0]
        words = split["pattern"].get("Regex") == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        norms = [n["type"] for n in (norm or {}).get("normalizers", [])]
        if words and split["behavior"] == "Removed" and split["invert"] and norms == ["NFC", "Replace", "Lowercase"]:
            return "words", True
    return "", False


class TextEncoder:
    """Ids of texts without special tokens; strings of special tokens in a text are ordinary text.

    A file whose pre-tokenizer isn't one of the two known ones is left to the library text by text.
    """

    def __init__(self, prepared: tuple[str, str, bool]) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec, kind, self.lower = prepared
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        split = _SPLITS.get(kind)
        letters, model = byte_letters(), self.tokenizer.model

        def spelt(text: str) -> str:
            return text.encode().decode("latin-1").translate(letters)

        def resolve(pieces: list[str]) -> list[list[int]]:
            # All pieces are spelt in one go, apart by a character that no text should have.
            whole = _APART.join(pieces)
            own = spelt(whole).split(spelt(_APART)) if whole.count(_APART) == len(pieces) - 1 else [spelt(p) for p in pieces]
            tokenize = model.tokenize
            return [[t.id for t in tokenize(p)] for p in own]

        self.pieces = PieceEncoder(split, resolve) if split else None

    def _ready(self, text: str) -> str:
        # The library lower-cases each character by itself, so that no sigma is a final one.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower() if self.lower else text

    def batches(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if self.pieces:
            yield from self.pieces.batches([self._ready(t) for t in texts])
            return
        for row, found in enumerate(self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            yield row, np.array(found.ids, np.int32), np.array([0, len(found.ids)])


@lru_cache(maxsize=2)
def text_encoder(prepared: tuple[str, str, bool]) -> TextEncoder:
    """The encoder of a worker process: reading a vocabulary takes a good part of a second, so its later tasks use it again."""
    return TextEncoder(prepared)
