"""Token counts of whole texts under a public tokenizer file.

Method: batch encoding inside Arrow functions that return lengths only. Texts are cut at
boundaries that no token can cross, the cut pieces that were not met before are encoded in
batches of bounded bytes, and their lengths are summed per text.

**Safe boundaries.** A byte-level tokenizer first splits a text by a pattern in which a
space can only begin a match, never end or continue one, when it stands between two
characters that are not white space. Cutting in front of such a space therefore changes no
token, however long the text. Texts that hold a string of a special token are cut around
it first, as the library does. Tokenizers of another kind get every text whole.

Defined results: null and empty texts have 0 bytes and 0 tokens; a text without any safe
boundary is encoded as one piece; repeated rows give repeated rows; an empty table gives an
empty table; only the two named columns are read, so further columns and their names do
not matter.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Marks a piece that may not be cut at its ends; far above any count.
_UNSAFE = 1 << 60
_COUNTERS: dict[tuple, TokenCounter] = {}


class TokenCounter:
    """Counts tokens of texts; lives within one Python worker.

    batch_bytes: text encoded by one call. cache: pieces whose length is remembered.
    window: characters of a text that are cut into pieces at a time.
    """

    def __init__(self, path: str, batch_bytes: int = 1 << 18, cache: int = 400_000, window: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        split = config.get("pre_tokenizer") or {}
        self.byte_level = (
            split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
            and not config.get("normalizer")
        )
        added = [t for t in config.get("added_tokens") or [] if t["content"]]
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in added)
        self.byte_level = self.byte_level and plain
        self.special = [t["content"] for t in added]
        self.around = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if added else None
        self.batch_bytes, self.cache, self.window = batch_bytes, cache, window
        self.spaced: dict[str, int] = {}
        self.whole: dict[str, int] = {}

    def lengths(self, texts: list[str]) -> list[int]:
        """Token counts, encoded in batches of at most ``batch_bytes`` or one text."""
        out: list[int] = []
        batch: list[str] = []
        size = 0
        for text in texts:
            if batch and size + len(text) > self.batch_bytes:
                out += map(len, self.encoder.encode_batch_fast(batch, add_special_tokens=False))
                batch, size = [], 0
            batch.append(text)
            size += len(text)
        if batch:
            out += map(len, self.encoder.encode_batch_fast(batch, add_special_tokens=False))
        return out

    def count(self, texts: list[str]) -> list[int]:
        """Token counts of whole texts."""
        if not self.byte_level:
            return self.lengths(texts)
        totals = [0] * len(texts)
        group: list[tuple[int, str]] = []
        size = 0
        for n, text in enumerate(texts):
            for part, special in self._parts(text):
                totals[n] += special
                if part:
                    group.append((n, part))
                    size += len(part)
                if size > self.window:
                    self._add(group, totals)
                    group, size = [], 0
        self._add(group, totals)
        return totals

    def _parts(self, text: str) -> Iterator[tuple[str, int]]:
        """Stretches of a text and the special tokens in front of them, cut to the window."""
        if self.special and any(s in text for s in self.special):
            stretches = [(s, int(n > 0)) for n, s in enumerate(self.around.split(text))]
        else:
            stretches = [(text, 0)]
        for stretch, special in stretches:
            at = 0
            while len(stretch) - at > self.window:
                cut = _CUT.search(stretch, at + self.window)
                if not cut:
                    break
                yield stretch[at : cut.start()], special
                at, special = cut.start(), 0
            yield stretch[at:], special

    def _add(self, group: list[tuple[int, str]], totals: list[int]) -> None:
        """Add the lengths of some stretches to the totals of their texts."""
        if len(self.spaced) > self.cache:
            self.spaced.clear()
        if len(self.whole) > self.cache:
            self.whole.clear()
        pieces = [part.split(" ") for _, part in group]
        unmet: set[str] = set()
        first: set[str] = set()
        for piece in pieces:
            head = piece[0]
            piece[0] = ""
            unmet.update(set(piece).difference(self.spaced))
            piece[0] = head
            first.add(head)
        for piece in list(unmet):
            if not piece or piece[0].isspace() or piece[-1].isspace():
                self.spaced[piece] = _UNSAFE
                unmet.discard(piece)
        new = list(unmet)
        self.spaced.update(zip(new, self.lengths([" " + p for p in new])))
        self._learn(first)
        length = self.spaced.__getitem__
        for (n, part), piece in zip(group, pieces):
            head = piece.pop(0)
            total = sum(map(length, piece))
            if total >= _UNSAFE or (piece and head and head[-1].isspace()):
                cut = _CUT.split(part)
                self._learn(set(cut))
                totals[n] += sum(map(self.whole.__getitem__, cut))
            else:
                totals[n] += total + self.whole[head]

    def _learn(self, pieces: set[str]) -> None:
        new = list(pieces.difference(self.whole))
        self.whole.update(zip(new, self.lengths(new)))


def token_counts(text: Column, path: str, **limits: int) -> Column:
    """A struct of ``n_bytes`` and ``n_tokens`` of a text under the tokenizer file at ``path``.

    The file has to be at that path on every executor.
    """

    @F.arrow_udf("struct<n_bytes:bigint,n_tokens:bigint>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        key = (path, *sorted(limits.items()))
        if key not in _COUNTERS:  # later tasks of a Python worker find its memory filled
            _COUNTERS[key] = TokenCounter(path, **limits)
        counter = _COUNTERS[key]
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            n_bytes = [len(t.encode()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array(n_bytes, pa.int64()), pa.array(counter.count(texts), pa.int64())],
                ["n_bytes", "n_tokens"],
            )

    return count(text.cast("string"))


def count_tokens(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, **limits: int
) -> DataFrame:
    """One row per input row: the id, ``n_bytes``, ``n_tokens``, ``over_limit``. No shuffle."""
    counted = df.select(
        F.col(id_col).alias(id_col), token_counts(F.col(text_col), path, **limits).alias("_c")
    )
    return counted.select(
        id_col, "_c.n_bytes", "_c.n_tokens", (F.col("_c.n_tokens") > limit).alias("over_limit")
    )
