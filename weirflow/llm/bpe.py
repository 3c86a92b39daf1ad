"""Byte-level BPE encoding and decoding with a segment tree over pair ranks.

A pre-token starts as its bytes. The leaves of a segment tree hold the merge rank of each
adjacent pair, inner nodes the least rank below, so that the root names the next merge and
one descent (left first) finds its leftmost place. A merge changes three leaves, each with
a logarithmic update, until no pair can merge: n log n for a pre-token of any length.

Texts are cut into white-space-led chunks that no pre-token crosses; encodings of chunks
are remembered per worker, in a table of bounded size. Rows are independent: no shuffle,
nothing kept but the vocabulary (its size is fixed by the file, which the driver reads).

Defined results: a null text counts as empty and has no ids; repeated rows are encoded
alike; an empty table gives no rows; other input columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from weirflow.llm.common import id_and_text

#: Unicode white space, as regular expressions of the tokenizer files mean it.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]")
# Fixed value: the pre-token pattern of byte-level vocabularies, with white space spelt out.
_PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+"
)

_NO_RANK = 1 << 60
_REMEMBERED = 1 << 19


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merges and the bytes of ids, from the JSON text of a byte-level BPE file."""

    def __init__(self, source: str) -> None:
        file = json.loads(source)
        ids: dict[str, int] = file["model"]["vocab"]
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens") or []}
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(file["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(ids[left] << 32 | ids[right], rank)
            self.merged.append(ids[left + right])
        self.bytes_of = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.bytes_of[i] = bytes(letters[x] for x in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None


def merge_pairs(symbols: list[int], ranks: dict[int, int], merged: list[int]) -> list[int]:
    """``symbols`` after all merges: always the lowest rank, leftmost first."""
    n = len(symbols)
    pairs = [ranks.get(a << 32 | b, _NO_RANK) for a, b in zip(symbols, symbols[1:], strict=False)]
    if not pairs or min(pairs) == _NO_RANK:
        return symbols
    size = 1 << (len(pairs) - 1).bit_length()
    tree = [_NO_RANK] * size + pairs + [_NO_RANK] * (size - len(pairs))
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i: int, rank: int) -> None:
        i += size
        tree[i] = rank
        while i > 1:
            other = tree[i ^ 1]
            if other < rank:
                rank = other
            i >>= 1
            if tree[i] == rank:
                return
            tree[i] = rank

    while (low := tree[1]) != _NO_RANK:
        i = 1
        while i < size:
            i *= 2
            if tree[i] != low:
                i += 1
        i -= size
        gone = after[i]
        symbols[i] = new = merged[low]
        symbols[gone] = -1
        after[i] = end = after[gone]
        if gone < len(pairs):
            put(gone, _NO_RANK)
        if end < n:
            before[end] = i
            put(i, ranks.get(new << 32 | symbols[end], _NO_RANK))
        else:
            put(i, _NO_RANK)
        if (start := before[i]) >= 0:
            put(start, ranks.get(symbols[start] << 32 | new, _NO_RANK))
    return [s for s in symbols if s >= 0]


class Coder:
    """Encodes and decodes texts; remembers a bounded number of pre-tokens and chunks."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.chunks = _Remember(self._chunk)
        self.words = _Remember(self._word)

    def _word(self, word: str) -> bytes:
        byte_ids = self.v.byte_ids
        ids = merge_pairs([byte_ids[b] for b in word.encode()], self.v.ranks, self.v.merged)
        return np.array(ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join([self.words[w] for w in _PRE_TOKEN.findall(chunk)])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        special, find, known = self.v.special, _CHUNK.findall, self.chunks.__getitem__
        if self.v.special_at is None or not any(s in text for s in special):
            return b"".join(map(known, find(text)))
        out = []
        for part in self.v.special_at.split(text):
            if part in special:
                out.append(np.array([special[part]], "<u4").tobytes())
            else:
                out.extend(map(known, find(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        pieces = map(self.v.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(pieces).decode("utf-8", "replace")


class _Remember(dict):
    """Results by argument; starts anew when full, so that memory stays bounded."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= _REMEMBERED:
            self.clear()
        value = self[key] = self.make(key)
        return value


_CODERS: dict[int, Coder] = {}


def _coder(source: str) -> Coder:
    """One coder for each vocabulary and worker process."""
    key = hash(source)
    if key not in _CODERS:
        _CODERS[key] = Coder(Vocabulary(source))
    return _CODERS[key]


def bpe_round_trip(docs: DataFrame, vocabulary_path: str, with_ids: bool = False) -> DataFrame:
    """Each document's ids, as a count and a digest, and the digest of its decoded text.

    ``ids`` (array of bigint) and ``decoded`` come with ``with_ids``.
    """
    source = docs.sparkSession.sparkContext.broadcast(Path(vocabulary_path).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(source.value)
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in names}
            for text in batch.column("text"):
                ids = coder.encode(text.as_py())
                decoded = coder.decode(ids)
                rows["n_tokens"].append(len(ids) // 4)
                rows["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    rows["ids"].append(np.frombuffer(ids, "<u4").astype("i8"))
                    rows["decoded"].append(decoded)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.string()]
            arrays = [pa.array(rows[k], kind) for k, kind in zip(names, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<bigint>, decoded string"
    return id_and_text(docs).mapInArrow(run, schema)
