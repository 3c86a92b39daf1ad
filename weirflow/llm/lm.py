"""Language-model scores by a weighted backoff automaton.

States are word histories seen in training, from the empty one (the root) up to
``order - 1`` words; an n-gram seen after a history is an arc with its smoothed
log-probability, and every history has a failure arc, weighted with what its unseen words
share, to the history without its first word. A text is read once from left to right: the
state is carried, failure arcs are followed until an arc for the word is found, weights add
up. Smoothing: P(w | h) = (c(hw) + m P(w | h')) / (c(h) + m), from the add-one unigram up;
it sums to one over the vocabulary and one unknown word.

The model is never in one place. Documents are gathered in blocks; a block sends the
distinct n-gram keys of its texts, with its training counts, to the tasks that own the key
ranges, sorted and delta-coded; a task adds up the counts of all blocks and answers each
block with the totals of its own keys, in their order. So a key crosses the network once
for each block, however often it occurs in it, and a block's automaton holds the part of
the model that its texts can reach. Nothing but three sums goes to the driver.

N-grams are compared by 64-bit hashes.

Defined results: a null or empty text has only the end token; rows without an id count as
training texts; repeated rows count each; with an empty training set every token has
probability 1 / (N + V + 1) = 1; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import id_and_text, release, stored

BLOCK_WORDS = 1_000_000
PART_KEYS = 1_000_000
_END = np.uint64(xxhash.xxh64_intdigest(b" end"))
_START = np.uint64(xxhash.xxh64_intdigest(b" start"))

BLOCKS = "block bigint, ids binary, lengths binary, held binary, vocabulary binary, tokens binary"
SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


@dataclass(frozen=True)
class Model:
    """``order`` words make the longest n-gram; ``mass`` is what a history gives to shorter ones."""

    order: int = 2
    mass: float = 4.0

    def __post_init__(self) -> None:
        if self.order < 1 or not self.mass > 0:
            raise ValueError("order: at least 1; mass: above 0")


# -- packing of numbers --------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: a plane of equal bytes takes almost nothing."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True) + len(planes).to_bytes(8, "little")


def unpack(blob: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(blob[-8:], "little")
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob[:-8], size, codec="zstd", asbytes=True), np.uint8)
    return planes.reshape(width, -1).T.copy().view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, "<u8"), dtype=np.uint64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in order."""
    x = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


# -- blocks --------------------------------------------------------------------


def _make_block(number: int, docs: list[tuple], hashes: list[np.ndarray]) -> tuple:
    vocabulary, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
    ids, lengths, held = zip(*docs, strict=True)
    missing = np.iinfo(np.int64).min
    return (
        number,
        pack(np.array([missing if i is None else i for i in ids], np.int64)),
        pack(np.array(lengths, np.int64)),
        pack(np.array(held, np.uint8)),
        pack_sorted(vocabulary),
        pack(tokens.astype("<u4")),
    )


def blocks(docs: DataFrame) -> DataFrame:
    """Documents as rows of packed token numbers, ``BLOCK_WORDS`` words or a longer text each."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] + [pa.binary()] * 5
        columns = list(zip(*rows, strict=True)) or [()] * 6
        names = [part.split()[0] for part in BLOCKS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        docs, hashes, words = [], [], 0
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = text.as_py().encode().lower().split()
                own = np.empty(len(found) + 1, np.uint64)
                own[:-1] = np.fromiter(map(digest, found), np.uint64, len(found))
                own[-1] = _END
                held = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2
                docs.append((doc, len(own), held))
                hashes.append(own)
                words += len(own)
                if words >= BLOCK_WORDS:
                    yield batch_of([_make_block(number, docs, hashes)])
                    number, docs, hashes, words = number + 1, [], [], 0
        if docs:
            yield batch_of([_make_block(number, docs, hashes)])
        release()

    return id_and_text(docs).mapInArrow(run, BLOCKS)


class Grams:
    """The distinct n-grams of a block, order by order.

    Order k has, for each distinct gram: its hash, its prefix (a gram of order k - 1), its
    suffix likewise, and the training count in this block. ``at[k]`` names the gram that ends
    at each token, -1 where the text has no k words yet; a text is preceded by a start mark.
    """

    def __init__(self, row: dict, order: int) -> None:
        self.ids = unpack(row["ids"], "<i8")
        self.lengths = unpack(row["lengths"], "<i8")
        self.held = unpack(row["held"], "u1").astype(bool)
        vocabulary = unpack_sorted(row["vocabulary"])
        tokens = unpack(row["tokens"], "<u4").astype(np.int64)
        first = np.zeros(len(tokens), bool)
        first[np.cumsum(self.lengths) - self.lengths] = True
        trained = np.repeat(~self.held, self.lengths)
        starts = int((~self.held).sum())
        # The start mark is the last gram of order 1. It is a history, but never a token.
        self.hashes = [None, np.append(vocabulary, _START)]
        self.trained = [None, np.append(np.bincount(tokens[trained], minlength=len(vocabulary)), starts)]
        self.prefix, self.suffix = [None, None], [None, None]
        self.at = [None, tokens]
        n_words = len(vocabulary) + 1
        before = np.where(first, n_words - 1, np.concatenate([[0], tokens[:-1]]))
        for k in range(2, order + 1):
            known = before >= 0
            code = before[known] * n_words + tokens[known]
            grams, gram_at = np.unique(code, return_inverse=True)
            at = np.full(len(tokens), -1)
            at[known] = gram_at
            prefix, last = np.divmod(grams, n_words)
            suffix = np.zeros(len(grams), np.int64)
            suffix[gram_at] = self.at[k - 1][known]
            self.hashes.append(_mix(self.hashes[k - 1][prefix], self.hashes[1][last] + np.uint64(k)))
            self.trained.append(np.bincount(gram_at[trained[known]], minlength=len(grams)))
            self.prefix.append(prefix)
            self.suffix.append(suffix)
            self.at.append(at)
            before = np.where(first, -1, np.concatenate([[0], at[:-1]]))

    def keys(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of order k in ascending order, and the order that sorts them."""
        by = np.argsort(self.hashes[k], kind="stable")
        return self.hashes[k][by], by


def _bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the keys of each part begin and end; a part is a range of hashes."""
    edges = (np.arange(1, parts, dtype=np.uint64)) << np.uint64(64 - (parts - 1).bit_length()) if parts > 1 else []
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]).astype(int)


# -- totals --------------------------------------------------------------------


def _total_of_part(k: int, rows: list[tuple]) -> tuple[list[bytes], int, int]:
    """Answers for the blocks' key lists, and tokens and distinct words of order 1."""
    keys = [unpack_sorted(key_blob) for _, key_blob, _ in rows]
    counts = np.concatenate([unpack(c, "<u4") for _, _, c in rows])
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, weights=counts, minlength=len(distinct)).astype("<u8")
    answers, at = [], 0
    for own in keys:
        answers.append(pack(total[where[at : at + len(own)]]))
        at += len(own)
    words = (total > 0) & (distinct != _START) if k == 1 else np.zeros(len(total), bool)
    return answers, int(total[words].sum()), int(words.sum())


def totals(held: DataFrame, order: int, parts: int) -> DataFrame:
    """For each block, order and key range: the corpus counts of the block's keys, in key order."""
    names = ["block", "k", "part", "keys", "counts"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams = Grams(row, order)
                out = []
                for k in range(1, order + 1):
                    keys, by = grams.keys(k)
                    counts = grams.trained[k][by].astype("<u4")
                    at = _bounds(keys, parts)
                    out += [
                        (row["block"], k, p, pack_sorted(keys[a:b]), pack(counts[a:b]))
                        for p, (a, b) in enumerate(zip(at, at[1:], strict=False))
                        if a < b
                    ]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, rows = None, []

        def answer() -> pa.RecordBatch:
            k, part = owner
            answers, tokens, words = _total_of_part(k, rows)
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([k] * n, pa.int32()),
                    pa.array([part] * n, pa.int32()),
                    pa.array(answers, pa.binary()),
                    pa.array([tokens] + [0] * (n - 1), pa.int64()),
                    pa.array([words] + [0] * (n - 1), pa.int64()),
                ],
                ["block", "k", "part", "totals", "n_tokens", "n_words"],
            )

        for batch in batches:
            for b, k, p, keys, counts in zip(*(batch.column(c) for c in names), strict=True):
                if (k.as_py(), p.as_py()) != owner:
                    if rows:
                        yield answer()
                    owner, rows = (k.as_py(), p.as_py()), []
                rows.append((b.as_py(), keys.as_py(), counts.as_py()))
        if rows:
            yield answer()
        release()

    sent = held.select(*[c.split()[0] for c in BLOCKS.split(", ")]).mapInArrow(
        send, "block bigint, k int, part int, keys binary, counts binary"
    )
    owned = sent.repartition(parts, "k", "part").sortWithinPartitions("k", "part", "block")
    return owned.mapInArrow(
        add, "block bigint, k int, part int, totals binary, n_tokens bigint, n_words bigint"
    )


# -- the automaton -------------------------------------------------------------


class Automaton:
    """The arcs and failure arcs that a block's texts can use."""

    def __init__(self, grams: Grams, totals: list, model: Model, n_tokens: int, n_words: int) -> None:
        self.grams, self.order = grams, model.order
        space = n_tokens + n_words + 1
        seen = [None, totals[1][:-1] > 0]
        chance = [None, (totals[1] + 1.0) / space]
        self.weight, self.fail = [None], [None]
        for k in range(2, model.order + 1):
            history = totals[k - 1][grams.prefix[k]]
            lower = chance[k - 1][grams.suffix[k]]
            chance.append((totals[k] + model.mass * lower) / (history + model.mass))
            seen.append(totals[k] > 0)
        for k in range(1, model.order + 1):
            self.weight.append(np.log10(chance[k]))
            with np.errstate(divide="ignore"):
                self.fail.append(np.log10(model.mass / (totals[k] + model.mass)))
        self.seen = seen
        self.state_seen = [None] + [totals[k] > 0 for k in range(1, model.order + 1)]
        self.base = np.log10(chance[1][:-1])

    def _arcs(self, k: int, a: int, b: int) -> list[float]:
        """Weights of the arcs of order k that tokens a to b would take; NaN where there is none."""
        at = self.grams.at[k][a:b]
        weight = self.weight[k][at]
        if k > 1:
            weight = np.where((at >= 0) & self.seen[k][at], weight, np.nan)
        return weight.tolist()

    def traverse(self) -> np.ndarray:
        """log10 probability of each text, each read once from left to right."""
        orders = range(1, self.order + 1)
        start_seen = bool(self.state_seen[1][-1])
        start_fail = float(self.fail[1][-1]) if start_seen else 0.0
        order, longest = self.order, self.order - 1
        out, end = np.zeros(len(self.grams.lengths)), 0
        for d, n in enumerate(self.grams.lengths.tolist()):
            begin, end = end, end + n
            at = [None] + [self.grams.at[k][begin:end] for k in orders]
            arcs = [None] + [self._arcs(k, begin, end) for k in orders]
            fails = [None] + [self.fail[k][at[k]].tolist() for k in orders]
            known = [None] + [self.state_seen[k][at[k]].tolist() for k in orders]
            total = 0.0
            # The state is the history before token i: its number of words (a start mark counts).
            state = min(int(start_seen), longest)
            for i in range(n):
                k = state + 1
                while k > 1 and (weight := arcs[k][i]) != weight:  # NaN: no such arc
                    total += fails[k - 1][i - 1] if i else start_fail
                    k -= 1
                total += arcs[k][i]
                # The next history is the longest known one that ends here, of order - 1 at most.
                state = k if k < order else longest
                while state and not known[state][i]:
                    state -= 1
            out[d] = total
        return out


def _by_key_order(grams: Grams, k: int, answers: list[tuple[int, bytes]]) -> np.ndarray:
    """Totals of order k in the block's own gram order."""
    _, by = grams.keys(k)
    out = np.zeros(len(by))
    if answers:
        out[by] = np.concatenate([unpack(blob, "<u8") for _, blob in sorted(answers, key=lambda x: x[0])])
    return out


def score_texts(docs: DataFrame, model: Model = Model()) -> DataFrame:
    """Token counts, the add-one unigram score and the model's score of every document."""
    held = stored(blocks(docs), "lm-blocks")
    words = held.agg(F.coalesce(F.sum(F.length("tokens")), F.lit(0))).first()[0]
    # A packed token takes two bytes or so; parts are ranges of hashes, a power of two of them.
    parts = 1 << max(0, (int(words) // (2 * PART_KEYS)).bit_length())
    answers = stored(totals(held, model.order, parts), "lm-totals")
    n = answers.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    n_tokens, n_words = int(n[0]), int(n[1])
    for_block = answers.groupBy("block").agg(F.collect_list(F.struct("k", "part", "totals")).alias("answers"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams = Grams(row, model.order)
                found = [None] + [
                    _by_key_order(grams, k, [(a["part"], a["totals"]) for a in row["answers"] if a["k"] == k])
                    for k in range(1, model.order + 1)
                ]
                machine = Automaton(grams, found, model, n_tokens, n_words)
                tokens = grams.at[1]
                first = np.cumsum(grams.lengths) - grams.lengths
                known = np.add.reduceat((found[1][tokens] > 0).astype(np.int64), first)
                ids = grams.ids
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).min),
                        pa.array(grams.held),
                        pa.array(grams.lengths),
                        pa.array(known),
                        pa.array(np.full(len(ids), n_tokens, np.int64)),
                        pa.array(np.add.reduceat(machine.base[tokens], first)),
                        pa.array(machine.traverse()),
                    ],
                    [c.split()[0] for c in SCORES.split(", ")],
                )
        release()

    return held.join(for_block, "block").mapInArrow(score, SCORES)
