"""Byte-level BPE encoding and decoding with an automaton over the vocabulary (operator 11).

The vocabulary's byte strings, mapped to Latin-1, form one Aho-Corasick
automaton.  A piece of text is scanned once, which gives the longest token from
each byte on.  Encoding walks from the left: it takes the longest token that is
compatible with the token before it, tries the next shorter one otherwise, and
where none is left goes back one token and marks that place as a dead end.  Each
place becomes a dead end at most once, so the walk takes linear time.

Two neighbours are compatible if merging the bytes of both by rank gives these
two tokens again; an encoding whose neighbours are all compatible is the one
that the merges give.  Whether a pair is compatible follows from the merges
that made its tokens (:meth:`BytePairs._separate`) and is memoised.  This holds
for vocabularies in which the merges below a token's rank leave two tokens of
its bytes.  Tokens that no merge gives (:attr:`BytePairs.unreachable`) can only be
whole pieces; they and every other whole piece in the vocabulary are one token.

Texts are split by ``pattern`` first and pieces are encoded once while they
stay in the task's table of the ``memo`` pieces last seen, so cost follows the text's length.
There is no shuffle.

Defined cases: null and empty texts have no ids and decode to no bytes; strings
that look like special tokens are ordinary text; a piece or text may be of any
length; repeated rows give the same result each; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Pieces longer than this are encoded where they stand and not kept.
KEEP = 64


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class _Recent(dict):
    """A table of the values last asked for: when it is full, what was not asked for since the last time goes."""

    def __init__(self, make: Callable, room: int, keep: Callable = lambda key: True):
        self._make, self._half, self._keep, self._old = make, max(1, room // 2), keep, {}

    def __missing__(self, key):
        got = self._old.get(key)
        if got is None:
            got = self._make(key)
            if not self._keep(key):
                return got
        if len(self) >= self._half:
            self._old = dict(self)
            self.clear()
        self[key] = got
        return got


class BytePairs:
    """Encoder and decoder of a vocabulary (bytes to rank, all single bytes among them).

    ``tables`` of another instance, plain values that can be sent to executors, save working them out again.
    """

    def __init__(self, ranks: dict[bytes, int], *, pattern: str = PATTERN, memo: int = 500_000, tables: tuple | None = None):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self._split = regex.compile(pattern).findall
        self._memo = _Recent(lambda p: self._packed(self.encode_piece(p.encode())), memo, lambda p: len(p) <= KEEP)
        self._compatible = _Recent(lambda pair: pair[1] not in self.unreachable and self._separate(*pair), 4 * memo)
        if tables is None:
            self._trie()
            self._merges()
        else:
            self._automaton, self._shorter, self._pair, self._halves, self.unreachable = tables

    @property
    def tables(self) -> tuple:
        return self._automaton, self._shorter, self._pair, self._halves, self.unreachable

    def _trie(self) -> None:
        self._automaton = ahocorasick.Automaton()
        for b, r in self.ranks.items():
            self._automaton.add_word(b.decode("latin-1"), (len(b), r))
        self._automaton.make_automaton()
        #: the longest proper prefix of each token that is a token
        self._shorter: dict[int, int | None] = {}
        for b, r in self.ranks.items():
            self._shorter[r] = next((self.ranks[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in self.ranks), None)

    def _merges(self) -> None:
        """The two tokens whose merge gives each token, found from the lowest rank on."""
        self._pair: dict[tuple[int, int], int] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        self.unreachable: set[int] = set()
        for r in sorted(self.bytes_of):
            b = self.bytes_of[r]
            if len(b) > 1:
                left = self._shorter[r]
                while left is not None:
                    right = self.ranks.get(b[len(self.bytes_of[left]):])
                    if right is not None and left < r and right < r and left not in self.unreachable \
                            and right not in self.unreachable and self._separate(left, right):
                        self._pair[left, right] = r
                        self._halves[r] = (left, right)
                        break
                    left = self._shorter[left]
                else:
                    self.unreachable.add(r)

    def _separate(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two neighbouring tokens before both are whole.

        Undoes the later of the two merges next to the border again and again: if
        what then meets there merges at a rank below the one just undone, that
        merge would have come first.
        """
        limit = None
        while True:
            both = self._pair.get((left, right))
            if both is not None and (limit is None or both < limit):
                return False
            # the later merge goes; equal ranks: the right one was made second
            for side in ((0, 1) if left > right else (1, 0)):
                token = right if side else left
                if token in self._halves:
                    limit = token + side
                    if side:
                        right = self._halves[token][0]
                    else:
                        left = self._halves[token][1]
                    break
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        return self._compatible[left, right]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [0] * n
        for end, (k, r) in self._automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - k] = r                        # ends ascend, so the longest comes last
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        bytes_of, shorter, compatible = self.bytes_of, self._shorter, self._compatible
        while at < n:
            while token is not None:
                end = at + len(bytes_of[token])
                if not dead[end] and (compatible[out[-1], token] if out else token not in self.unreachable):
                    break
                token = shorter[token]
            if token is None:
                dead[at] = 1
                token = out.pop()
                at -= len(bytes_of[token])
                token = shorter[token]
            else:
                out.append(token)
                at = end
                token = longest[at] if at < n else None
        return out

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._memo.__getitem__, self._split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_texts(docs: DataFrame, *, vocabulary: str = VOCABULARY, pattern: str = PATTERN, digests: bool = False,
                 text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ids (binary, unsigned 32-bit little-endian) for every row; with ``digests``, also decoded back.

    ``digests`` gives n_tokens, ids_sha256 and decoded_sha256 in place of the ids.
    """
    ranks = load_ranks(vocabulary)
    # one vocabulary file and what follows from it
    shared = docs.sparkSession.sparkContext.broadcast((ranks, BytePairs(ranks, pattern=pattern).tables))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs(shared.value[0], pattern=pattern, tables=shared.value[1])
        for b in batches:
            ids = [pairs.encode(t.as_py() or "") for t in b.column("text")]
            if digests:
                sha = [pa.array([hashlib.sha256(x).hexdigest() for x in xs]) for xs in (ids, map(pairs.decode, ids))]
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([len(x) // 4 for x in ids], pa.int64()), *sha],
                                                 names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(ids, pa.binary())], names=["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids binary"
    return (docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(fn, f"key {kind}, {columns}").withColumnRenamed("key", key))


def decode_ids(encoded: DataFrame, *, vocabulary: str = VOCABULARY, key: str = "doc_id") -> DataFrame:
    """``key`` and the decoded bytes of ``ids``; null ids decode to no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {r: b for b, r in shared.value.items()}
        for b in batches:
            out = [b"".join(map(bytes_of.__getitem__, np.frombuffer(x.as_py() or b"", "<u4").tolist()))
                   for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, pa.binary())], names=["key", "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return (encoded.select(F.col(f"`{key}`").alias("key"), "ids")
            .mapInArrow(fn, f"key {kind}, decoded binary").withColumnRenamed("key", key))


def bytepair_digest(docs: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    return encode_texts(docs, vocabulary=vocabulary, digests=True)
