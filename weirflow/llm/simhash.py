"""SimHash near-duplicates: vantage-point trees over fingerprints.

A document's fingerprint is the bitwise majority of its shingle hashes. Equal fingerprints
are one node, so copies are never expanded. A vantage-point tree, fitted on a bounded
sample, cuts the space into shards: at each node a point goes left if its Hamming distance
to the pivot is within the node's radius. By the triangle inequality a neighbour within
``t`` bits can be on the other side only if the distance is within ``t`` of the radius;
such points are also sent, as queries, to the shards they overlap. Inside a shard the tree
goes on down to small cells, where distances are compared exactly. So every link between
different fingerprints is found, whatever the sample.

A cell gives a spanning set of its links (each node to its component's first node), never
all pairs of a dense group; Spark rounds of star contraction make global components.

Defined results: a null or empty text has fingerprint zero and links like any other; a row
without an id is fingerprinted but has no component; repeated rows each get their group's
component; an empty table gives no rows. Other input columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm.common import id_and_text, release, stored
from weirflow.llm.graph import components

SEED = 42
#: Fingerprints that fit the tree's upper levels: about one to two times as many; all points are indexed.
SAMPLE = 65_536
SHARD_POINTS = 4_096
#: For near copies: how many word fingerprints are searched, and 64-bit parts of the shingle sketch.
WORD_PRINTS = 3
SKETCH_PARTS = 4
#: Texts whose shingles tell the frequent ones, and how many of these are known to all tasks.
OFTEN_TEXTS = 16_384
OFTEN = 1 << 18
_CELL = 512
_SLICE = 65_536
_MARKS = 1 << 22
#: Shingles that more nodes have in their prefix are crowds, whose pairs are not made.
LONG_RUN = 64
#: How often a crowd is linked through leaders before what is left apart is compared.
STARS = 2
#: Nodes of a crowd that one task compares with as many others, and how fine their parities are.
CROWD_BLOCK = 4_096
CROWD_FINER = 8
_NONE = np.zeros((0, 2), np.uint64)  # no links


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Hashes of runs of ``size`` words joined by a space; of all words if there are fewer."""
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    if n <= 1:
        return np.array([digest(line, SEED)], "<u8")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), "<u8", n)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SLICE):
        bits = np.unpackbits(hashes[at : at + _SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str, words_per_shingle: int) -> int:
    """The 64-bit majority fingerprint of a text's word shingles; zero without words."""
    words = text.encode().lower().split()
    return majority(shingle_hashes(words, words_per_shingle)) if words else 0


def _again(hashes: np.ndarray, k: int) -> np.ndarray:
    """Other hashes of the same things, independent for each k."""
    x = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str, words_per_shingle: int) -> np.ndarray:
    """The distinct hashes of a text's word shingles, in order; none without words."""
    words = text.encode().lower().split()
    return np.unique(shingle_hashes(words, words_per_shingle)) if words else np.zeros(0, "<u8")


def sketch(text: str, runs: np.ndarray) -> list[int]:
    """``WORD_PRINTS`` fingerprints of single words, then a sketch of the shingle set, 64 bits each."""
    words = text.encode().lower().split()
    if not words:
        return [0] * (WORD_PRINTS + SKETCH_PARTS)
    single = shingle_hashes(words, 1)
    return [majority(_again(single, k)) for k in range(WORD_PRINTS)] + [
        majority(_again(runs, 100 + k)) for k in range(SKETCH_PARTS)
    ]


def fingerprints(
    docs: DataFrame, words_per_shingle: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ``print``: the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), words_per_shingle) for t in batch.column("text")]
            prints = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], ["doc_id", "print"])
        release()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, print bigint")


def _distance(points: np.ndarray, pivot: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ pivot).astype(np.int16)


def fit_tree(sample: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Pivots and radii of a complete tree, in heap order from 1; the leaves are shards.

    The radius at a node is the median distance of the sample that reaches it.
    """
    levels = max(0, (shards - 1).bit_length())
    pivots, radii = np.zeros(1 << levels, np.uint64), np.full(1 << levels, 32, np.int16)
    rng = np.random.default_rng(SEED)

    def fit(node: int, part: np.ndarray) -> None:
        if node >= 1 << levels:
            return
        if len(part):
            pivots[node] = part[rng.integers(len(part))]
            radii[node] = np.median(_distance(part, pivots[node]))
        near = _distance(part, pivots[node]) <= radii[node]
        fit(2 * node, part[near])
        fit(2 * node + 1, part[~near])

    fit(1, sample)
    return pivots, radii


def route(points: np.ndarray, tree: tuple[np.ndarray, np.ndarray], bits: int) -> Iterator[tuple]:
    """For each shard: which points live there, and which only come as queries.

    A pair in two shards is met once, in the shard with the larger number.
    """
    pivots, radii = tree

    def down(node: int, at: np.ndarray, home: np.ndarray) -> Iterator[tuple]:
        if not len(at):
            return
        if node >= len(pivots):
            yield node - len(pivots), at[home], at[~home]
            return
        far = _distance(points[at], pivots[node]) - radii[node]
        left = (far <= bits) & ((far <= 0) | ~home)
        # Queries go rightwards only: what lives on the right never asks on the left.
        yield from down(2 * node, at[left], home[left])
        right = far > -bits
        yield from down(2 * node + 1, at[right], home[right] & (far[right] > 0))

    yield from down(1, np.arange(len(points)), np.ones(len(points), bool))


@dataclass(frozen=True)
class Near:
    """When two points are linked: fingerprints within ``bits``, sketches within ``sketch_bits``.

    A point is a row (fingerprint, node, sketch parts ...); without parts there is no second test.
    """

    bits: int
    sketch_bits: int = 0

    def close(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which rows of ``a`` are linked with which of ``b``."""
        near = np.bitwise_count(a[:, 0][:, None] ^ b[:, 0][None, :]) <= self.bits
        if a.shape[1] > 2:
            x, y = np.nonzero(near)
            apart = np.bitwise_count(a[x, 2:] ^ b[y, 2:]).sum(axis=1, dtype=np.int64)
            near[x, y] = apart <= self.sketch_bits
        return near


def _link_cell(own: np.ndarray, asks: np.ndarray, near: Near, inner: bool) -> list[np.ndarray]:
    """Links of one small cell: rows (node, node)."""
    nodes, out = own[:, 1], []
    label = np.arange(len(own))
    close = near.close(own, own)
    for i in np.flatnonzero(close.sum(axis=1) > 1):
        groups = np.unique(label[close[i]])
        if len(groups) > 1:
            label[np.isin(label, groups)] = groups[0]
    if inner:
        moved = np.flatnonzero(label != np.arange(len(own)))
        out.append(np.stack([nodes[moved], nodes[label[moved]]], axis=1))
    for at in range(0, len(asks), _CELL * 16):
        part = asks[at : at + _CELL * 16]
        who, what = np.nonzero(near.close(part, own))
        if len(who):
            pairs = np.unique(np.stack([who, label[what]], axis=1), axis=0)
            out.append(np.stack([part[pairs[:, 0], 1], nodes[pairs[:, 1]]], axis=1))
    return out


def _link_crowd(own: np.ndarray, asks: np.ndarray, near: Near, inner: bool) -> list[np.ndarray]:
    """Links among many points of one fingerprint, which only their sketches tell apart.

    Leaders are points linked to no earlier leader; every point is linked to all leaders near
    it. Then points that are in different groups still are compared, unless the triangle
    inequality rules them out: a member of a leader at distance d has links only to what is
    within d and the threshold of that leader.
    """
    most, label, out = near.sketch_bits, np.arange(len(own)), []
    asks = asks[np.bitwise_count(asks[:, 0] ^ own[0, 0]) <= near.bits]
    home, away = np.full(len(own), -1), np.zeros(len(own), np.int64)

    def apart(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
        return np.bitwise_count(points[:, 2:] ^ pivot[2:]).sum(axis=1, dtype=np.int64)

    def join(groups: np.ndarray) -> None:
        if (groups != groups[0]).any():
            label[np.isin(label, groups)] = groups.min()

    def links(points: np.ndarray, node: np.uint64) -> None:
        if len(points):
            out.append(np.stack([points[:, 1], np.full(len(points), node)], axis=1))

    def met(points: np.ndarray, far: np.ndarray, members: np.ndarray) -> Iterator[tuple[int, int]]:
        """Those of the points that are near a member, with one such member."""
        for at in range(0, len(points), _CELL):
            part, open_ = points[at : at + _CELL], np.ones(len(points[at : at + _CELL]), bool)
            low = far[at : at + _CELL].min() - most
            able = members[away[members] >= low]
            for to in range(0, len(able), _CELL):
                some = np.flatnonzero(open_)
                if not len(some):
                    break
                close = near.close(part[some], own[able[to : to + _CELL]])
                hit = close.any(axis=1)
                open_[some[hit]] = False
                for i, j in zip(some[hit], close[hit].argmax(axis=1), strict=True):
                    yield at + int(i), int(able[to + j])

    leaders = []
    while len(rest := np.flatnonzero(home < 0)):
        lead = int(rest[0])
        far = apart(own, own[lead])
        by = far <= most
        fresh = by & (home < 0)
        home[fresh], away[fresh] = len(leaders), far[fresh]
        leaders.append(lead)
        join(np.unique(label[by]))
        if inner:
            links(own[by & (np.arange(len(own)) != lead)], own[lead, 1])
    order = np.argsort(home, kind="stable")
    members = np.split(order, np.cumsum(np.bincount(home))[:-1])
    for lead, mine in zip(leaders, members, strict=True):
        far = apart(own, own[lead])
        others = np.flatnonzero((far > most) & (far <= most + away[mine].max()) & (label != label[lead]))
        for at in range(0, len(others), _CELL):
            part = others[at : at + _CELL]
            part = part[label[part] != label[lead]]
            for i, j in met(own[part], far[part], mine) if len(part) else ():
                if label[part[i]] != label[j]:
                    join(label[[part[i], j]])
                    if inner:
                        links(own[part[i]][None], own[j, 1])
    if len(asks):
        done = np.zeros(0, np.int64)  # (ask, group) pairs that are linked
        for lead in leaders:
            by = np.flatnonzero(apart(asks, own[lead]) <= most)
            links(asks[by], own[lead, 1])
            done = np.union1d(done, by * len(own) + label[lead])
        for lead, mine in zip(leaders, members, strict=True):
            far = apart(asks, own[lead])
            open_ = np.flatnonzero((far > most) & (far <= most + away[mine].max()))
            open_ = open_[~np.isin(open_ * len(own) + label[lead], done)]
            hits = [(open_[i], j) for i, j in met(asks[open_], far[open_], mine)] if len(open_) else []
            for i, j in hits:
                links(asks[i][None], own[j, 1])
            done = np.union1d(done, np.array([i * len(own) + label[lead] for i, _ in hits], np.int64))
    return out


def link(own: np.ndarray, asks: np.ndarray, near: Near, inner: bool = True) -> list[np.ndarray]:
    """Spanning links from ``asks`` to ``own``, with ``inner`` also among ``own``.

    This is the tree inside a shard. A point near a cell's border asks on its other side.
    """
    if not len(own) or not (inner or len(asks)):
        return []
    if len(own) <= _CELL:
        return _link_cell(own, asks, near, inner)
    pivot = own[np.random.default_rng([SEED, len(own)]).integers(len(own)), 0]
    far = _distance(own[:, 0], pivot)
    radius = int(np.median(far))
    inside = far <= radius
    if inside.all():
        radius -= 1
        inside = far <= radius
    if not inside.any():  # one fingerprint only
        return _link_crowd(own, asks, near, inner)
    bits = near.bits
    asked = _distance(asks[:, 0], pivot)
    out = link(own[inside], asks[asked <= radius + bits], near, inner)
    asks = asks[asked > radius - bits]
    out += link(own[~inside], asks, near, inner)
    if inner:
        out += link(own[~inside], own[inside & (far > radius - bits)], near, False)
    return out


def _pack(rows: np.ndarray) -> bytes:
    return np.ascontiguousarray(rows, np.uint64).tobytes()


def near_links(nodes: DataFrame, near: Near) -> DataFrame:
    """Links (a, b) that connect all linked nodes. ``nodes``: print, node, then sketch parts."""
    spark: SparkSession = nodes.sparkSession
    width = len(nodes.columns)
    bits, none = near.bits, np.zeros((0, width), np.uint64)
    total = nodes.count()
    # About SAMPLE points, drawn by hash where they are: nothing else travels, however many partitions there are.
    every = max(1, total // SAMPLE)
    sample = nodes.select("print").where(F.pmod(F.xxhash64("print"), F.lit(every)) == 0).toPandas()["print"]
    shards = min(max(1, -(-total // SHARD_POINTS)), SAMPLE // 4)
    tree = spark.sparkContext.broadcast(fit_tree(sample.to_numpy(np.int64).view(np.uint64), shards))

    def points_of(blob) -> np.ndarray:
        return np.frombuffer(blob.as_buffer(), np.uint64).reshape(-1, width)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.stack([c.to_numpy().view(np.uint64) for c in batch.columns], axis=1)
            rows = []
            for shard, home, asks in route(own[:, 0], tree.value, bits):
                rows += [(shard, kind, _pack(own[at])) for kind, at in ((0, home), (1, asks)) if len(at)]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            kinds = [pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["shard", "kind", "points"]
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shard after shard: the points that live there are gathered, then queries stream past."""
        shard, held, own = None, [], None
        for batch in batches:
            found: list[np.ndarray] = []
            asks: list[np.ndarray] = []

            def ask() -> None:
                if asks:
                    found.extend(link(own, np.concatenate(asks), near, inner=False))
                    asks.clear()

            def settle() -> None:
                nonlocal own
                if own is None:
                    own = np.concatenate([none, *held])
                    held.clear()
                    found.extend(link(own, none, near))

            for s, kind, blob in zip(*(batch.column(c) for c in ("shard", "kind", "points")), strict=True):
                if s.as_py() != shard:
                    settle()
                    ask()
                    shard, own = s.as_py(), None
                if kind.as_py() == 0:
                    held.append(points_of(blob))
                else:
                    settle()
                    asks.append(points_of(blob))
            ask()
            yield _edges(found)
        yield _edges(link(np.concatenate([none, *held]), none, near) if held else [])
        release()

    # Points travel in packed rows; a shard's own points come before its queries.
    dealt = nodes.mapInArrow(deal, "shard int, kind int, points binary")
    ready = dealt.repartition("shard").sortWithinPartitions("shard", "kind")
    return ready.mapInArrow(search, "a bigint, b bigint").distinct()


def _edges(found: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate([_NONE, *found]).view(np.int64)
    rows = np.unique(rows, axis=0)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["a", "b"])


def near_duplicates(
    docs: DataFrame, words_per_shingle: int = 5, bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ``fingerprint`` (16 hex digits) and ``component_id`` for every row."""
    prints = stored(fingerprints(docs, words_per_shingle, id_col, text_col), "prints")
    named = prints.where("doc_id IS NOT NULL")
    nodes = stored(named.groupBy("print").agg(F.min("doc_id").alias("node")), "nodes")
    labels = components(near_links(nodes.select("print", "node"), Near(bits)))
    grouped = nodes.join(labels, "node", "left").select(
        "print", F.coalesce("component", "node").alias("component_id")
    )
    joined = prints.join(grouped, "print", "left")
    return joined.select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def _least_common(size, similarity: float):
    """How many shingles a set of ``size`` has in common with any that is as similar, at least."""
    return np.ceil(np.asarray(size) * similarity - 1e-9).astype(np.int64)


def prefix(runs: np.ndarray, similarity: float, often: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The first shingles of a set, rare ones first: two sets as similar share one of these.

    Any order that is the same for all sets has that property; ``often`` (sorted hashes) and
    ``times`` only make the shared ones few.
    """
    if not len(runs):
        return runs
    at = np.minimum(np.searchsorted(often, runs), max(len(often) - 1, 0))
    count = np.where(often[at] == runs, times[at], 0) if len(often) else np.zeros(len(runs), np.int64)
    return runs[np.lexsort((runs, count))][: len(runs) - int(_least_common(len(runs), similarity)) + 1]


def parities(runs: np.ndarray, finer: int = 1) -> np.ndarray:
    """A bit for each of about as many parts of the hashes: whether a set has an odd number there.

    Two sets differ in at least as many hashes as their bits differ in, and hardly in more where
    the parts are ``finer`` (a power of two).
    """
    bits = finer << max(6, int(len(runs) - 1).bit_length())
    odd = np.bincount((runs % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def may_be_similar(x: np.ndarray, y: np.ndarray, total: int, similarity: float) -> bool:
    """Whether the parities of two sets with ``total`` hashes together allow the similarity."""
    while len(x) != len(y):  # the longer one is folded: of two parts together it tells the same
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum()) <= total * (1 - similarity) / (1 + similarity) + 1e-6


def _frequent(texts: DataFrame, words_per_shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles that several texts of a bounded sample have, sorted, and in how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("_text"):
                runs = shingle_set(t.as_py(), words_per_shingle)
                yield pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64))], ["token"])
        release()

    every = max(1, texts.count() // OFTEN_TEXTS)
    some = texts.where(F.pmod(F.xxhash64("_row"), F.lit(every)) == 0).select("_text")
    counts = some.mapInArrow(run, "token bigint").groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    counts = stored(counts, "often")
    # The least count that at most OFTEN tokens reach, from a row for each count.
    spread = sorted(((r.n, r.m) for r in counts.groupBy("n").agg(F.count("*").alias("m")).collect()), reverse=True)
    total, least = 0, 2
    for n, m in spread:
        total += m
        if total > OFTEN:
            least = n + 1
            break
    top = counts.where(F.col("n") >= least).toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["n"].to_numpy(np.int64)[order]


def _possible(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs of nodes from rows of a shared token, where its places allow the similarity.

    Common shingles before the token are as many as the lesser place at most, those after
    it as many as the shorter rest.
    """
    most = np.minimum(x[:, 4], y[:, 4]) + np.minimum(x[:, 3] - x[:, 4], y[:, 3] - y[:, 4])
    asked = (x[:, 3] + y[:, 3]) * (similarity / (1 + similarity)) - 1e-6
    ok = (x[:, 2] != y[:, 2]) & (most >= asked)
    a, b = x[ok, 1], y[ok, 1]
    return np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)


def _posts(nodes: DataFrame) -> DataFrame:
    """(token, node, group, size, place): a row for each shingle of a node's prefix."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, group, size = (batch.column(c).to_numpy() for c in ("node", "group", "_size"))
            tokens = [np.frombuffer(b.as_buffer(), np.int64) for b in batch.column("_prefix")]
            for at in range(0, len(tokens), _CELL):
                part = tokens[at : at + _CELL]
                n = np.fromiter(map(len, part), np.int64, len(part))
                columns = [np.concatenate(part)]
                columns += [np.repeat(c[at : at + _CELL], n) for c in (node, group, size)]
                columns.append(np.concatenate([np.arange(k) for k in n]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "node", "group", "size", "place"])
        release()

    return nodes.select("node", "group", "_size", "_prefix").mapInArrow(
        spread, "token bigint, node bigint, group bigint, size bigint, place bigint"
    )


def prefix_pairs(posts: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of different groups that share a token and can be similar.

    For tokens of at most ``LONG_RUN`` posts: a post has a bounded number of partners. Pairs
    within a group, as those of copies that are linked already, are neither made nor looked at.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: np.ndarray) -> Iterator[np.ndarray]:
            """Pairs of whole runs of one token each, all runs at once, by distance."""
            for d in range(1, LONG_RUN):
                x, y = rows[:-d], rows[d:]
                same = x[:, 0] == y[:, 0]
                if not same.any():
                    break
                yield _possible(x[same], y[same], similarity)

        waiting = np.zeros((0, 5), np.int64)
        for batch in batches:
            rows = np.concatenate([waiting, np.stack([c.to_numpy() for c in batch.columns], axis=1)])
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0])) if len(rows) else 0
            pairs = [p.view(np.uint64) for p in found(rows[:last]) if len(p)]
            if pairs:
                yield _edges(pairs)
            waiting = rows[last:]
        pairs = [p.view(np.uint64) for p in found(waiting) if len(p)]
        if pairs:
            yield _edges(pairs)
        release()

    ready = posts.repartition("token").sortWithinPartitions("token", "group", "node")
    return ready.mapInArrow(meet, "a bigint, b bigint").distinct()


def _leaders(crowd: DataFrame, turn: int) -> DataFrame:
    """(token, lead): the node with the least hash of those that have the token, the same one for many tokens.

    Leaders change with each ``turn``.
    """
    lot = F.xxhash64("node", F.lit(turn))
    return crowd.groupBy("token").agg(F.min_by(F.struct("node", "group"), F.struct(lot, "node")).alias("lead"))


def _stars(crowd: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each post of a crowd with its token's leader, where their groups differ.

    A node gets at most one partner for each of its tokens.
    """
    met = crowd.join(_leaders(crowd, turn), "token").where("group != lead.group")
    return met.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct()


def _folded(rows: np.ndarray, width: int) -> np.ndarray:
    """Parities of half the width tell the same of two parts together."""
    while rows.shape[1] > width:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def crowd_pairs(crowd: DataFrame, odd: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of different groups of a crowd that their sizes and parities allow.

    ``crowd``: posts; ``odd``: node and its fine parities. Tokens of one leader are one run, in
    which a node is once, so pairs that share many tokens meet a few times. Once a crowd is linked
    through leaders nearly all of a run is one group. Only nodes outside its largest group ask,
    and they ask all of the run; both are dealt in blocks, so a task compares a bounded number of
    them, and no pair that the parities rule out becomes a row.
    """
    runs = crowd.join(_leaders(crowd, STARS), "token").select(
        F.col("lead.node").alias("run"), "node", "group", "size", F.lit(0).cast("bigint").alias("place")
    )
    crowd = runs.distinct().join(odd, "node")
    of_group = crowd.groupBy("run", "group").agg(F.count(F.lit(1)).alias("n"))
    sizes = of_group.groupBy("run").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("group", F.struct("n", "group")).alias("main")
    )
    blocks = sizes.where("n > most").select(
        "run", "main", F.ceil(F.col("n") / CROWD_BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("n") - F.col("most")) / CROWD_BLOCK).cast("int").alias("sides"),
    )
    open_ = crowd.join(blocks, "run")
    lot = F.xxhash64("node")
    columns = ["run", "node", "group", "size", "place", "odd"]
    every = open_.select(
        *columns, F.pmod(lot, F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("sides") - 1)).alias("side")
    )
    asking = open_.where("group != main").select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(lot, F.col("sides")).cast("int").alias("side")
    )
    asking = asking.select(*[F.col(c).alias(c) for c in asking.columns])

    def rows_of(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
        return np.stack([table[c].to_numpy() for c in columns[:5]], axis=1), table["odd"].to_pylist()

    def compare(_: tuple, mine: pa.Table, theirs: pa.Table) -> pa.Table:
        found = [np.zeros((0, 2), np.int64)]
        if len(mine) and len(theirs):
            (x, odd_x), (y, odd_y) = rows_of(mine), rows_of(theirs)
            widths = np.fromiter(map(len, odd_y), np.int64, len(odd_y))
            classes = {}
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                classes[int(width)] = at, np.frombuffer(b"".join(odd_y[i] for i in at), np.uint64).reshape(len(at), -1)
            for i, raw in enumerate(odd_x):
                one = np.frombuffer(raw, np.uint64)[None, :]
                for at, parity in classes.values():
                    width = min(one.shape[1], parity.shape[1])
                    apart = np.bitwise_count(_folded(parity, width) ^ _folded(one, width)).sum(axis=1, dtype=np.int64)
                    near = apart <= (y[at, 3] + x[i, 3]) * ((1 - similarity) / (1 + similarity)) + 1e-6
                    if near.any():
                        some = y[at[near]]
                        found.append(_possible(np.broadcast_to(x[i], some.shape), some, similarity))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    keys = ["run", "block", "side"]
    return asking.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(compare, "a bigint, b bigint").distinct()


def _of_texts(texts: DataFrame, asked: DataFrame, words_per_shingle: int, make: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(row, runs): what ``make`` makes of the shingle sets of the texts ``asked`` for (_row), and of a few others.

    A bounded table of marks tells most others; shingles are made again for the rest.
    """
    mark = F.pmod(F.xxhash64("_row"), F.lit(_MARKS)).cast("int").alias("_mark")
    marks = np.zeros(_MARKS, bool)
    marks[asked.select(mark).distinct().toPandas()["_mark"].to_numpy(np.int64)] = True
    packed = texts.sparkSession.sparkContext.broadcast(np.packbits(marks))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(packed.value).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(wanted[batch.column("_mark").to_numpy()]))
            for row, text in zip(batch.column("_row"), batch.column("_text"), strict=True):
                runs = make(shingle_set(text.as_py(), words_per_shingle)).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([row.as_py()]), pa.array([runs], pa.binary())], ["row", "runs"])
        release()

    return texts.select("_row", "_text", mark).mapInArrow(sets, "row bigint, runs binary")


def similar_pairs(
    texts: DataFrame, nodes: DataFrame, pairs: DataFrame, words_per_shingle: int, similarity: float
) -> DataFrame:
    """Those of the ``pairs`` (a, b) whose shingle sets have that Jaccard similarity, exactly.

    Parities (``nodes``: node, _size, _odd) rule out most pairs that are not, and no other.
    Then sets meet. ``texts``: _row and _text. Shingles are made again for the texts in
    question: a bounded table of marks tells most others, the join all.
    """

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = batch.column("total").to_numpy()
            ok = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                bits = (np.frombuffer(b.as_buffer(), np.uint8) for b in (x, y))
                ok[i] = may_be_similar(*bits, int(totals[i]), similarity)
            yield batch.select(["a", "b"]).filter(pa.array(ok))
        release()

    first = nodes.select(F.col("node").alias("a"), F.col("_odd").alias("x"), F.col("_size").alias("n"))
    other = nodes.select(F.col("node").alias("b"), F.col("_odd").alias("y"), F.col("_size").alias("m"))
    light = pairs.join(first, "a").join(other, "b").select("a", "b", "x", "y", (F.col("n") + F.col("m")).alias("total"))
    pairs = stored(light.mapInArrow(sift, "a bigint, b bigint"), "sifted")
    asked = pairs.select(F.col("a").alias("_row")).union(pairs.select("b")).distinct()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                same = len(np.intersect1d(p, q, assume_unique=True))
                ok[i] = same * (1 + similarity) >= similarity * (len(p) + len(q)) - 1e-6
            yield batch.select(["a", "b"]).filter(pa.array(ok))
        release()

    of = stored(_of_texts(texts, asked, words_per_shingle, lambda runs: runs), "sets")
    both = pairs.join(of.select(F.col("row").alias("a"), F.col("runs").alias("x")), "a")
    both = both.join(of.select(F.col("row").alias("b"), F.col("runs").alias("y")), "b")
    return stored(both.select("a", "b", "x", "y").mapInArrow(judge, "a bigint, b bigint"), "similar")


def near_copies(
    docs: DataFrame,
    words_per_shingle: int = 5,
    similarity: float = 0.8,
    bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each group of near copies, with all columns: that with the least id.

    Two texts are near copies if their shingle sets have a Jaccard similarity of
    ``similarity`` or more; groups are the connected components of all such pairs, whatever
    was added, cut or edited. Pairs are found in two steps, and both check them by the sets:

    Trees find most pairs, so that large groups hang together: they search ``WORD_PRINTS``
    fingerprints of single words, within ``bits``, and ask for a near sketch of the shingles.

    A prefix filter finds all the others: of two sets as similar, the first fifth (at 0.8) in
    a common order share a shingle. The order has rare shingles first, by a sample. Pairs
    inside a group of the first step are left out, as they change nothing. A shingle that many
    have in their prefix makes a crowd: its nodes are linked through a leader, in turns, and
    only those that are in none of the crowd's largest group then are compared with the others.

    Rows without an id all stay. Of repeated rows one stays. An id joins nothing: different
    texts that share one are different rows, and of a group's rows with the least id the
    first one stays.
    """
    cosine = 2 * similarity / (1 + similarity)
    apart = float(np.arccos(min(1.0, cosine)) / np.pi)
    n_bits = 64 * SKETCH_PARTS
    near = Near(bits, int(n_bits * apart + np.sqrt(n_bits * apart * (1 - apart))))
    names = [f"_print{k}" for k in range(WORD_PRINTS)] + [f"_part{k}" for k in range(SKETCH_PARTS)]
    longs = [*names, "_set0", "_set1", "_size"]
    docs = docs.drop("_row", "_prefix", "_odd", *longs)

    # Rows are numbered once, in a stored table: numbers then stay what they are.
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    light = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("_id"), "_row", F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text")
    )
    often = rows.sparkSession.sparkContext.broadcast(_frequent(light.where("_id IS NOT NULL"), words_per_shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, firsts, odd = [], [], []
            for t in batch.column("_text").to_pylist():
                runs = shingle_set(t, words_per_shingle)
                whole = xxhash.xxh3_128_intdigest(runs.tobytes(), SEED)
                values.append([*sketch(t, runs), whole >> 64, whole % 2**64, len(runs)])
                firsts.append(prefix(runs, similarity, *often.value).tobytes())
                odd.append(parities(runs).tobytes())
            values = np.array(values, np.uint64).reshape(len(firsts), len(longs))
            columns = [pa.array(values[:, k].copy().view(np.int64)) for k in range(len(longs))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_row"), *columns, pa.array(firsts, pa.binary()), pa.array(odd, pa.binary())],
                ["_id", "_row", *longs, "_prefix", "_odd"],
            )
        release()

    schema = "_id bigint, _row bigint, " + ", ".join(f"{n} bigint" for n in longs) + ", _prefix binary, _odd binary"
    prints = stored(light.mapInArrow(run, schema), "sketches")
    # Equal sets are one node, named by a row: ids can repeat among different texts.
    named = prints.where("_id IS NOT NULL")
    sets = named.groupBy("_set0", "_set1").agg(F.min(F.struct("_row", "_id", *longs, "_prefix", "_odd")).alias("of"))
    nodes = stored(sets.select(F.col("of._row").alias("node"), "of.*").drop("_row", "_id"), "nodes")
    found = None
    for k in range(WORD_PRINTS):
        points = nodes.select(F.col(f"_print{k}").alias("print"), "node", *names[WORD_PRINTS:])
        links = near_links(points, near)
        found = links if found is None else found.unionByName(links)
    first = similar_pairs(light, nodes, stored(found.distinct(), "found"), words_per_shingle, similarity)

    def grouped(labels: DataFrame) -> DataFrame:
        return nodes.join(labels, "node", "left").withColumn("group", F.coalesce("component", "node"))

    posts = _posts(grouped(components(first)))
    long = stored(posts.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LONG_RUN).select("token"), "long-runs")
    crowd = stored(posts.join(long, "token", "left_semi"), "crowds")
    more = prefix_pairs(posts.join(long, "token", "left_anti"), similarity)
    links = first
    if crowd.isEmpty():
        links = links.unionByName(similar_pairs(light, nodes, stored(more, "prefix-pairs"), words_per_shingle, similarity))
    else:

        def regrouped() -> DataFrame:
            groups = grouped(components(links)).select("node", "group")
            return crowd.drop("group").join(groups, "node").select(*crowd.columns)

        now = crowd
        for turn in range(STARS):
            stars = _stars(now, turn)
            pairs = stars if turn else stars.unionByName(more).distinct()
            links = links.unionByName(similar_pairs(light, nodes, stored(pairs, f"stars-{turn}"), words_per_shingle, similarity))
            now = stored(regrouped(), f"crowds-{turn}")
        asked = now.select(F.col("node").alias("_row")).distinct()
        fine = _of_texts(light, asked, words_per_shingle, lambda runs: parities(runs, CROWD_FINER))
        odd = stored(fine.select(F.col("row").alias("node"), F.col("runs").alias("odd")), "crowd-parities")
        rest = crowd_pairs(now, odd, similarity)
        links = links.unionByName(similar_pairs(light, nodes, stored(rest, "crowd-pairs"), words_per_shingle, similarity))
    of_set = grouped(components(links)).select("_set0", "_set1", "group")
    of_row = named.select("_id", "_row", "_set0", "_set1").join(of_set, ["_set0", "_set1"])
    least = of_row.groupBy("group").agg(F.min(F.struct("_id", "_row")).alias("row")).select("row._row")
    kept = least.unionByName(prints.where("_id IS NULL").select("_row"))
    return rows.join(kept, "_row", "left_semi").drop("_row")
