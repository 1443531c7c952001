"""Byte-level BPE encoding and decoding from a table of ranks.

Method: bytes stand as Latin-1 characters in a pyahocorasick automaton of all tokens. At a
position the longest token is tried first; it may follow the previous token only if merging
the bytes of the two gives the two tokens again, which is remembered per pair. When no token
fits, the previous one is replaced by its next shorter one, and the position is marked so
that it is not tried twice. A sequence all of whose neighbours fit is the one that merging
by rank gives, so the result is exact, in time linear in the length.

Texts are split by the public pattern and every match is encoded on its own. A space
between two characters that are not white space can only begin a match, so texts are first
cut in front of such spaces and the ids of a cut piece are remembered.

Defined results: null and empty texts have no ids; a byte without a rank raises an error
(the public tables have all 256); white-space-only texts, very long texts and texts
without a boundary are encoded whole; repeated rows give repeated rows; only the named
columns are read, so further columns and their names do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CUT = re.compile(r"(?<=\S)(?= \S)")
_NEVER = float("inf")
_CODECS: dict[tuple, "BytePairCodec"] = {}


class BytePairCodec:
    """Encodes and decodes by ranks; lives within one Python worker.

    cache: pieces (and pairs of tokens) whose result is remembered. window: characters that
    are cut into pieces at a time.
    """

    def __init__(self, path: str, pattern: str, cache: int = 400_000, window: int = 1 << 20):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as file:
            for line in file:
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.bytes_of: dict[int, bytes] = {rank: token for token, rank in self.ranks.items()}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.longest = max(map(len, self.ranks), default=0)
        self.pattern = regex.compile(pattern)
        self.cache, self.window = cache, window
        #: Whether a space and letters are one match, as they are under the public pattern.
        self.one_match = self.pattern.findall(" ab") == [" ab"]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, bool], list[tuple[bytes, float]]] = {}
        self.regulars: dict[int, bool] = {}
        self.spaced: dict[str, bytes | None] = {}

    def merge(self, piece: bytes, least: int = 1) -> list[int]:
        """Ids by merging the neighbours of the lowest rank, leftmost first, until ``least``
        are left. For short pieces."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > least:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def spine(self, token: int, right: bool) -> list[tuple[bytes, float]]:
        """The parts of a token at its right (or left) edge, from the byte to the token, each
        with the rank of the merge that ends it (infinity for the token itself)."""
        known = self.spines.get((token, right))
        if known is None:
            piece = self.bytes_of[token]
            if len(piece) == 1:
                known = [(piece, _NEVER)]
            else:
                left, other = self.merge(piece, 2)
                inner = self.spine(other if right else left, right)
                known = [*inner[:-1], (inner[-1][0], token), (piece, _NEVER)]
            self.spines[token, right] = known
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether merging lets the two tokens stand next to each other.

        Merges inside either token happen in order of rank, so the parts at the border change
        in that order; the tokens stay apart if no pair of parts that meet there merges first.
        """
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > 4 * self.cache:
                self.pairs.clear()
            known = self._apart(left, right)
            self.pairs[left, right] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        if not (self.regular(left) and self.regular(right)):
            return self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        a, b, i, j = self.spine(left, True), self.spine(right, False), 0, 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            rank = self.ranks.get(x + y)
            if rank is not None and rank < x_ends and rank <= y_ends:
                return False
            if x_ends == y_ends == _NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def regular(self, token: int) -> bool:
        """Whether merging the token's bytes gives the token, by ranks that rise."""
        known = self.regulars.get(token)
        if known is None:
            piece = self.bytes_of[token]
            known = len(piece) == 1 or (
                self.merge(piece) == [token]
                and all(p < token and self.regular(p) for p in self.merge(piece, 2) if len(self.bytes_of[p]) > 1)
            )
            self.regulars[token] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        rank_of, pairs = self.ranks.get, self.pairs
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        text, end = piece.decode("latin-1"), len(piece)
        prefix, step = self.automaton.longest_prefix, self.longest
        ids: list[int] = []
        lengths: list[int] = []
        failed: set[int] = set()
        at, size, last = 0, prefix(text[:step]), None
        while at < end:
            while size:
                token = rank_of(piece[at : at + size])
                if token is not None and at + size not in failed:
                    if last is None:
                        break
                    fit = pairs.get((last, token))
                    if fit or fit is None and self.fits(last, token):
                        break
                size -= 1
            if size:
                ids.append(token)
                lengths.append(size)
                last = token
                at += size
                size = prefix(text[at : at + step]) if at < end else 0
            elif ids:
                failed.add(at)
                ids.pop()
                size = lengths.pop()
                at -= size
                size -= 1
                last = ids[-1] if ids else None
            else:
                raise ValueError("the ranks have no token for some byte")
        return ids

    def _segment(self, text: str) -> bytes:
        ids: list[int] = []
        for match in self.pattern.findall(text):
            ids += self.encode_piece(match.encode())
        return array("i", ids).tobytes()

    def _spaced(self, piece: str) -> bytes | None:
        """Packed ids of a piece with its leading space, None if it may not be cut there."""
        if self.one_match and piece.isalpha():
            packed = array("i", self.encode_piece(b" " + piece.encode())).tobytes()
        elif not piece or piece[0].isspace() or piece[-1].isspace():
            packed = None
        else:
            packed = self._segment(" " + piece)
        self.spaced[piece] = packed
        return packed

    def _stretch(self, text: str) -> bytes:
        """Packed ids of a stretch of a text."""
        if len(self.spaced) > self.cache:
            self.spaced.clear()
        head, *pieces = text.split(" ")
        if not (pieces and head and head[-1].isspace()):
            for piece in set(pieces).difference(self.spaced):
                self._spaced(piece)
            packed = list(map(self.spaced.__getitem__, pieces))
            if None not in packed:
                return self._segment(head) + b"".join(packed)
        return b"".join(map(self._segment, _CUT.split(text)))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, int32."""
        parts, at = [], 0
        while len(text) - at > self.window:
            cut = _CUT.search(text, at + self.window)
            if not cut:
                break
            parts.append(self._stretch(text[at : cut.start()]))
            at = cut.start()
        parts.append(self._stretch(text[at:]))
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def codec(path: str, pattern: str, **limits: int) -> BytePairCodec:
    """The codec of this Python worker; later tasks of the worker find its memory filled."""
    key = (path, pattern, *sorted(limits.items()))
    if key not in _CODECS:
        _CODECS[key] = BytePairCodec(path, pattern, **limits)
    return _CODECS[key]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    offsets[1:] = np.cumsum([len(a) for a in arrays])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode(text: Column, path: str, pattern: str, **limits: int) -> Column:
    """The ids of a text as an array of int."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern, **limits)
        for batch in batches:
            yield _lists([own.encode(t or "") for t in batch.to_pylist()])

    return run(text.cast("string"))


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of an array of ids; null for null."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for batch in batches:
            yield pa.array(
                [None if i is None else own.decode(np.array(i, np.int32)) for i in batch.to_pylist()], pa.binary()
            )

    return run(ids)


def round_trip(text: Column, path: str, pattern: str, with_ids: bool = False, **limits: int) -> Column:
    """A struct of the ids' number, the digest of the decimal ids joined by commas, and the
    digest of the bytes that the ids decode to; the ids themselves if ``with_ids``."""

    @F.arrow_udf(
        "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string" + ",ids:array<int>" * with_ids + ">"
    )
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern, **limits)
        decimal = {rank: str(rank) for rank in own.bytes_of}
        for batch in batches:
            counts, ids_sha, decoded_sha, all_ids = [], [], [], []
            for text in batch:
                ids = own.encode(text.as_py() or "")
                counts.append(len(ids))
                if with_ids:
                    all_ids.append(ids)
                joined = ",".join(map(decimal.__getitem__, ids.tolist()))
                ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
                + [_lists(all_ids)] * with_ids,
                ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids,
            )

    return run(text.cast("string"))


def round_trip_digests(
    df: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    **limits: int,
) -> DataFrame:
    """One row per input row: the id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and
    ``ids`` if ``with_ids``. No shuffle."""
    done = df.select(
        F.col(id_col).alias(id_col), round_trip(F.col(text_col), path, pattern, with_ids, **limits).alias("_r")
    )
    return done.select(id_col, "_r.*")
