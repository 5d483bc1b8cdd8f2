"""Word n-gram Jaccard join with signature trees.

A document's set holds the distinct shingles of ``width`` words (A-Z lower-cased; fewer
words make one shingle). Two documents link when ``den * |x & y| >= num * |x | y|``; the
result names each document's connected component by its smallest id.

Stages, each a Spark job over whole tables:

1. Texts become shingle sets; equal sets (exact copies) share one dense id. The same scan
   keeps each set's signature and fills two frequency sketches of fixed width (2**20
   counters each), of shingles and of words.
2. Two linked sets share one of their rarest ``n - ceil(t n) + 1`` shingles, and the first
   one they share is among the ``n - ceil(2t/(1+t) n) + 1`` rarest of the smaller set.
   Rarest is by the words of a shingle, as most shingles of a large corpus are too rare for
   any sketch; those that the sketch shows to be frequent come after. Rare shingles travel
   packed, 17 bytes each, and meet in buckets. Sets that share one, of sizes that can link,
   form a group; groups with the same members are kept once, and only members of groups
   meet their signatures.
3. In each group a signature tree (nodes with OR-combined bitmaps and size ranges) is
   traversed against itself. Node pairs that cannot reach the needed overlap are pruned;
   the pairs left over give a spanning forest, so a group of m members yields fewer than
   m rows. No true link is lost, as the bounds only overestimate.
4. The components of those forests are small blocks that no true link leaves. Each block
   gets its texts once (where they are few, no others are shuffled), and the same traversal, now with exact intersections, links them.
   A block or group above its budget is dealt out as pairs of sub-blocks, so that no task
   holds more than two of them.

Defined results: null and empty texts and texts of white space have size 0 and link with
nothing; rows with a null id are linked like others but never name a component unless
nothing else does; repeated rows give repeated result rows; an empty table gives an empty
result. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import (
    MOST_KEYS,
    Links,
    components,
    in_groups,
    key_lists,
    mixed,
    plain_bytes,
    ranked,
    shingle_runs,
    shingle_set,
    small,
    word_hashes,
)
from meterline.session import stored

SKETCH = 1 << 20
_BLOCK = 1 << 16
LEAF = 32
#: Rare shingles that a task holds before it writes them, and that a task reads, about.
_HELD = 1 << 20
_READ = 500_000
#: Members in a row of a group.
_PART = 1024


# --- sets and their digests -----------------------------------------------------------


def _digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: a sum and an xor of mixed hashes."""
    a = np.add.reduce(mixed(s + np.uint64(0x51ED270B)), dtype=np.uint64)
    b = np.bitwise_xor.reduce(mixed(s ^ np.uint64(0xB5026F5AA96619E9))) if len(s) else np.uint64(0)
    return int(np.int64(a.view(np.int64))), int(np.int64(b.view(np.int64)))


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Some texts at a time: their keys, the hashes of their words, where each text's begin and end."""
    for batch in batches:
        texts = zip(batch["key"].tolist(), map(plain_bytes, batch["text"].tolist()))
        for group in in_groups(texts, lambda text: len(text[1])):
            hashes, counts, _, _ = word_hashes([text for _, text in group])
            ends = np.cumsum(counts)
            keys = [None if pd.isna(key) else int(key) for key, _ in group]
            yield keys, hashes, (ends - counts).tolist(), ends.tolist()


def _sets(texts: list, width: int) -> Iterator[np.ndarray]:
    """The shingle set of each text."""
    for group in in_groups(map(plain_bytes, texts), len):
        hashes, counts, _, _ = word_hashes(group)
        ends = np.cumsum(counts)
        for end, n in zip(ends.tolist(), counts.tolist()):
            yield shingle_set(hashes[end - n : end], width)


def _first_pass(width: int) -> Callable:
    def run(batches):
        # Shingles, then words.
        counts = np.zeros(2 * SKETCH, dtype=np.int64)
        rows: list = []

        def frame():
            return pd.DataFrame(rows, columns=["key", "n", "d1", "d2", "sig", "block", "counts"]).astype(
                {"key": "Int64", "block": "Int32"}
            )

        pending: list = []
        for keys, hashes, starts, ends in _words(batches):
            counts[SKETCH:] += np.bincount(_slots(hashes), minlength=SKETCH)
            for key, start, end in zip(keys, starts, ends):
                s = shingle_set(hashes[start:end], width)
                rows.append((key, len(s), *_digest(s), signature(s).tobytes() if len(s) else None, None, None))
                pending.append(s)
                if len(pending) == 256:
                    counts[:SKETCH] += np.bincount(_slots(np.concatenate(pending)), minlength=SKETCH)
                    pending = []
                if len(rows) >= 5000:
                    yield frame()
                    rows = []
        if pending:
            counts[:SKETCH] += np.bincount(_slots(np.concatenate(pending)), minlength=SKETCH)
        if rows:
            yield frame()
        for block in range(len(counts) // _BLOCK):
            part = counts[block * _BLOCK : (block + 1) * _BLOCK]
            if part.any():
                rows = [(None, 0, 0, 0, None, block, _counters(part))]
                yield frame()

    return run


def _slots(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64(SKETCH - 1)).astype(np.int64)


def _planes(a: np.ndarray) -> np.ndarray:
    """All lowest bytes of the numbers, then all second ones, and so on."""
    return a.view(np.uint8).reshape(len(a), -1).T


def _counters(part: np.ndarray) -> bytes:
    return zlib.compress(_planes(np.minimum(part, 2**32 - 1).astype("<u4")).tobytes(), 1)


def _counted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _add_counts(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch["block"].tolist(), batch["counts"].tolist()):
            part = _counted(counts).astype(np.int64)
            sums[block] = sums[block] + part if block in sums else part
    for block, total in sums.items():
        yield pd.DataFrame({"block": [block], "counts": [_counters(total)]})


def _sketch(first: DataFrame) -> np.ndarray:
    """The summed counters; the driver gets the fixed 8 MB of them, nothing that grows."""
    rows = first.where("block is not null").select("block", "counts")
    # Two steps, so that no task reads the blocks of all others.
    part = rows.withColumn("salt", F.pmod(F.xxhash64("counts"), F.lit(16)))
    part = part.repartition("block", "salt").select("block", "counts")
    part = part.mapInPandas(_add_counts, "block int, counts binary")
    total = part.repartition("block").mapInPandas(_add_counts, "block int, counts binary")
    sketch = np.zeros(2 * SKETCH, dtype=np.uint32)
    for r in total.collect():
        at = r["block"] * _BLOCK
        sketch[at : at + _BLOCK] = _counted(r["counts"])
    return sketch


def _rarity(sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Sixteenths of powers of two: of the shingles that a counter shows beyond its chance
    share (the least number where it shows none), of each word's count, of all words."""
    shingles, words = sketch[:SKETCH].astype(np.float64), sketch[SKETCH:].astype(np.float64)
    chance = shingles.sum() / SKETCH
    frequent = np.full(SKETCH, -(1 << 15), dtype=np.int16)
    shown = shingles > chance + 4 * np.sqrt(chance) + 1
    frequent[shown] = np.round(16 * np.log2(shingles[shown] - chance))
    counts = np.round(16 * np.log2(np.maximum(words, 1))).astype(np.int16)
    return frequent, counts, round(16 * float(np.log2(max(words.sum(), 1))))


# --- signatures and trees -------------------------------------------------------------


def signature(s: np.ndarray, most: int = 1 << 14) -> np.ndarray:
    """A bitmap of two to four bits a shingle (a power of two, 256 to ``most``)."""
    bits = 256
    while bits < min(2 * len(s), most):
        bits *= 2
    flags = np.zeros(bits, dtype=np.uint8)
    flags[(mixed(s) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def _fold(sig: np.ndarray, words: int) -> np.ndarray:
    """The same bitmap with fewer bits: halves are OR-combined."""
    return np.bitwise_or.reduce(sig.reshape(-1, words), axis=0) if len(sig) > words else sig


def _pop(x: np.ndarray, axis: int = -1) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=axis, dtype=np.int64)


class _Node:
    __slots__ = ("start", "end", "parts", "bits", "low", "high", "excess")

    def __init__(self, start, end, parts, bits, low, high, excess):
        self.start, self.end, self.parts = start, end, parts
        self.bits, self.low, self.high, self.excess = bits, low, high, excess


def _build(sizes: np.ndarray, sigs: np.ndarray, excess: np.ndarray, fan: int = 4) -> _Node:
    level = []
    for a in range(0, len(sizes), LEAF):
        b = min(a + LEAF, len(sizes))
        bits = np.bitwise_or.reduce(sigs[a:b], axis=0)
        level.append(_Node(a, b, None, bits, sizes[a:b].min(), sizes[a:b].max(), excess[a:b].max()))
    while len(level) > 1:
        up = []
        for i in range(0, len(level), fan):
            kids = level[i : i + fan]
            bits = np.bitwise_or.reduce([k.bits for k in kids], axis=0)
            low, high = min(k.low for k in kids), max(k.high for k in kids)
            up.append(_Node(kids[0].start, kids[-1].end, kids, bits, low, high, max(k.excess for k in kids)))
        level = up
    return level[0]


def tree_links(
    sizes: np.ndarray,
    sigs: list[np.ndarray],
    num: int,
    den: int,
    same: Callable[[int, int], bool] | None = None,
    sides: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Spanning links (root, member) of the pairs that may, or with ``same`` do, link.

    Dual traversal of a signature tree with itself. For x in X and y in Y the overlap is at
    most the common bits of the two OR-bitmaps plus the smaller of the largest numbers of
    shingles hidden behind shared bits; the needed overlap is at least that of the two
    smallest sizes. Pairs that are connected already are not looked at again. With
    ``sides``, one or more rows of marks, only pairs that differ in every row count.
    """
    m = len(sizes)
    words = min(len(s) for s in sigs)
    order = np.lexsort((np.arange(m), sizes))
    size = np.asarray(sizes, dtype=np.int64)[order]
    sig = np.stack([_fold(sigs[i], words) for i in order])
    own = _pop(sig)
    excess = size - own
    side = None if sides is None else np.atleast_2d(sides)[:, order]
    links = Links(m)
    root = _build(size, sig, excess)

    def leaves(x: _Node, y: _Node) -> None:
        xs, ys = range(x.start, x.end), range(y.start, y.end)
        first = links.root(x.start)
        if all(links.root(i) == first for i in xs) and all(links.root(j) == first for j in ys):
            return
        a, b = sig[x.start : x.end], sig[y.start : y.end]
        common = _pop(a[:, None, :] & b[None, :, :])
        most = np.minimum(
            size[x.start : x.end, None] - (own[x.start : x.end, None] - common),
            size[None, y.start : y.end] - (own[None, y.start : y.end] - common),
        )
        total = size[x.start : x.end, None] + size[None, y.start : y.end]
        # overlap / (total - overlap) >= num / den
        fits = most * (num + den) >= num * total
        for row in () if side is None else side:
            fits &= row[x.start : x.end, None] != row[None, y.start : y.end]
        for i, j in zip(*np.nonzero(fits)):
            i, j = int(i) + x.start, int(j) + y.start
            if i < j and links.root(i) != links.root(j) and (same is None or same(int(order[i]), int(order[j]))):
                links.join(i, j)

    todo = [(root, root)]
    while todo:
        x, y = todo.pop()
        if x.start > y.start:
            x, y = y, x
        if min(x.high, y.high) * den < num * max(x.low, y.low):
            continue
        if x is not y:
            most = int(np.bitwise_count(x.bits & y.bits).sum()) + min(x.excess, y.excess)
            if most * (num + den) < num * (x.low + y.low):
                continue
        if x.parts is None and y.parts is None:
            leaves(x, y)
        elif x is y:
            kids = x.parts
            # Neighbours last, so that they are taken first from the stack.
            for gap in range(len(kids) - 1, -1, -1):
                todo.extend((kids[i], kids[i + gap]) for i in range(len(kids) - gap))
        elif y.parts is None or (x.parts is not None and x.end - x.start >= y.end - y.start):
            todo.extend((k, y) for k in x.parts)
        else:
            todo.extend((x, k) for k in y.parts)
    out = []
    for i in range(m):
        r = links.root(i)
        if r != i:
            out.append((int(order[r]), int(order[i])))
    return out


def sized_links(
    sizes: np.ndarray,
    sigs: list[np.ndarray],
    num: int,
    den: int,
    same: Callable[[int, int], bool] | None = None,
    sides: list | None = None,
) -> list[tuple[int, int]]:
    """Links like those of ``tree_links``, over bitmaps that are folded to half at most as a rule.

    A tree needs bitmaps of one length, and those of large sets that are folded to the
    length of a small one are full, so that any two would pass. Sets whose bitmaps have the
    same length get a tree, and so do those of two lengths whose sizes can link.
    """
    lengths = np.array([len(s) for s in sigs])
    classes = [np.flatnonzero(lengths == n) for n in np.unique(lengths)]
    out: list[tuple[int, int]] = []
    for i, a in enumerate(classes):
        for b in classes[i:]:
            if b is a:
                at, marks = a, []
            elif sizes[a].max() * den < num * sizes[b].min():
                continue
            else:
                at, marks = np.concatenate([a, b]), [np.repeat([0, 1], [len(a), len(b)])]
            if len(at) < 2:
                continue
            if sides is not None:
                marks = [*marks, np.asarray(sides)[at]]
            found = tree_links(
                sizes[at],
                [sigs[k] for k in at],
                num,
                den,
                same and (lambda x, y, at=at: same(int(at[x]), int(at[y]))),
                np.array(marks) if marks else None,
            )
            out.extend((int(at[x]), int(at[y])) for x, y in found)
    return out


# --- the join -------------------------------------------------------------------------


def _second_pass(width: int, num: int, den: int, buckets: int, rarity) -> Callable:
    """The rarest shingles of each set, packed by bucket.

    The order is that of expected counts, were words independent, or of the sketch where it
    shows more; equal ones go by hash. It depends on the shingle alone, so all sets agree.
    """

    def run(batches):
        frequent, counts, whole = rarity.value
        held: list[tuple] = []
        total = 0
        for _, hashes, starts, ends in _words(batches):
            weights = counts[_slots(hashes)].astype(np.int64)
            for start, end in zip(starts, ends):
                if start == end:
                    continue
                s, at = np.unique(shingle_runs(hashes[start:end], width), return_index=True)
                n, take = len(s), min(width, end - start)
                sums = np.cumsum(weights[start:end])
                sums[take:] -= sums[:-take].copy()
                rank = np.maximum(frequent[_slots(s)], sums[take - 1 :][at] - (take - 1) * whole)
                rarest = np.lexsort((s, rank))[: n - -(-num * n // den) + 1]
                held.append((s[rarest], _digest(s)[0], n, n - -(-2 * num * n // (num + den)) + 1))
                total += len(rarest)
                if total >= _HELD:
                    yield _packed(held, buckets)
                    held, total = [], 0
        if held:
            yield _packed(held, buckets)

    return run


def _packed(held: list[tuple], buckets: int) -> pd.DataFrame:
    """A row for each bucket: 40 bits of each shingle (others gave the bucket), the set's name,
    twice its size, plus one where the shingle is too late for the smaller of two sets."""
    lengths = np.array([len(s) for s, *_ in held])
    shingles = np.concatenate([s for s, *_ in held])
    names = np.repeat(np.array([name for _, name, _, _ in held], dtype=np.int64), lengths)
    early = np.repeat(np.array([e for *_, e in held]), lengths)
    place = np.arange(len(shingles)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sizes = np.repeat(np.array([n for _, _, n, _ in held], dtype=np.int64), lengths)
    marks = (2 * sizes + (place >= early)).astype("<u4")
    bucket = ((shingles >> np.uint64(40)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    shingles, names, marks = shingles[order].astype("<u8"), names[order].astype("<i8"), marks[order]
    found, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    data = [
        _planes(shingles[a:b])[:5].tobytes() + names[a:b].tobytes() + _planes(marks[a:b]).tobytes()
        for a, b in zip(starts.tolist(), ends.tolist())
    ]
    return pd.DataFrame({"bucket": found.astype(np.int32), "data": data})


def _unpacked(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shingles, names, marks = [], [], []
    for data in rows:
        m = len(data) // 17
        a = np.zeros((m, 8), dtype=np.uint8)
        a[:, :5] = np.frombuffer(data, dtype=np.uint8, count=5 * m).reshape(5, m).T
        shingles.append(a.view("<u8").ravel())
        names.append(np.frombuffer(data, dtype="<i8", count=m, offset=5 * m))
        b = np.frombuffer(data, dtype=np.uint8, offset=13 * m).reshape(4, m).T
        marks.append(np.ascontiguousarray(b).view("<u4").ravel())
    return np.concatenate(shingles), np.concatenate(names), np.concatenate(marks)


def _groups(num: int, den: int) -> Callable:
    """Sets that share a shingle of a bucket and may link, by the name of the group."""

    def run(batches):
        seen: set = set()
        for rows in key_lists(batches, ("bucket",), ("data",)):
            found = list(_bucket_groups(*_unpacked([r[0] for r in rows]), num, den))
            found = [r for r in found if r[:3] not in seen]
            seen.update(r[:3] for r in found)
            if len(seen) > 200_000:
                seen.clear()
            if found:
                yield pd.DataFrame(found, columns=["g1", "g2", "part", "members", "sets"])

    return run


def _bucket_groups(
    shingles: np.ndarray, names: np.ndarray, marks: np.ndarray, num: int, den: int
) -> Iterator[tuple]:
    """(g1, g2, part, members, sets) of each shingle; equal members give equal rows.

    A larger set stays if a smaller one that it can link with has the shingle early enough,
    a smaller one if it has it early and a larger one that it can link with has it.
    """
    order = np.argsort(shingles)
    ordered = shingles[order]
    again = ordered[1:] == ordered[:-1]
    order = order[np.append(again, False) | np.append(False, again)]
    shingles, names, marks = shingles[order], names[order], marks[order]
    order = np.lexsort((marks & 1, names, marks >> 1, shingles))
    shingles, names, marks = shingles[order], names[order], marks[order]
    sizes, early = (marks >> 1).astype(np.int64), marks & 1 == 0
    if len(shingles) < 2:
        return
    # Exact copies are one set.
    other = (shingles[1:] != shingles[:-1]) | (names[1:] != names[:-1]) | (sizes[1:] != sizes[:-1])
    once = np.append(True, other)
    shingles, names, sizes, early = shingles[once], names[once], sizes[once], early[once]
    first = np.append(True, shingles[1:] != shingles[:-1])
    at = np.arange(len(shingles))
    before = np.append(-1, np.maximum.accumulate(np.where(early, at, -1))[:-1])
    has_smaller = (before >= np.maximum.accumulate(np.where(first, at, 0))) & (den * sizes[before] >= num * sizes)
    has_larger = early & np.append(~first[1:] & (den * sizes[:-1] >= num * sizes[1:]), False)
    stays = has_smaller | has_larger
    shingles, names = shingles[stays], names[stays]
    if not len(shingles):
        return
    starts = np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1]))
    ends = np.append(starts[1:], len(shingles))
    u = names.view(np.uint64)
    g1 = np.add.reduceat(mixed(u + np.uint64(0x51ED270B)), starts).view(np.int64)
    g2 = np.bitwise_xor.reduceat(mixed(u ^ np.uint64(0xB5026F5AA96619E9)), starts).view(np.int64)
    for a, b, x, y in zip(starts.tolist(), ends.tolist(), g1.tolist(), g2.tolist()):
        for part, c in enumerate(range(a, b, _PART)):
            yield x, y, part, b - a, names[c : min(c + _PART, b)].tobytes()


def _members(batches):
    """A row for each set of each group, from rows sorted by group."""
    columns = ["g1", "g2", "members", "d1"]
    frames: list = []
    held = 0
    for rows in key_lists(batches, ("g1", "g2", "part"), ("g1", "g2", "members", "sets")):
        x, y, members, sets = rows[0]
        names = np.frombuffer(sets, dtype="<i8")
        frames.append((np.full(len(names), x), np.full(len(names), y), np.full(len(names), members), names))
        held += len(names)
        if held >= 10_000:
            yield pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*frames)))))
            frames, held = [], 0
    if frames:
        yield pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*frames)))))


def _edges(found: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _forests(num: int, den: int) -> Callable:
    def run(batches):
        out: list = []
        seen: set = set()
        columns = ("id", "n", "sig", "i", "j", "side")
        for rows in key_lists(batches, ("g1", "g2", "i", "j"), columns):
            if len(rows) < 2:
                continue
            ids = [r[0] for r in rows]
            cross = rows[0][3] != rows[0][4]
            for a, b in sized_links(
                np.array([r[1] for r in rows], dtype=np.int64),
                [np.frombuffer(r[2], dtype=np.uint64) for r in rows],
                num,
                den,
                sides=[r[5] for r in rows] if cross else None,
            ):
                pair = (min(ids[a], ids[b]), max(ids[a], ids[b]))
                if pair not in seen:
                    seen.add(pair)
                    out.append(pair)
            if len(seen) > 200_000:
                seen.clear()
            if len(out) >= 10_000:
                yield _edges(out)
                out = []
        yield _edges(out)

    return run


def _exact(width: int, num: int, den: int) -> Callable:
    def run(batches):
        out: list = []
        columns = ("id", "d1", "d2", "text", "i", "j", "side")
        # Texts turn into sets at once, so that a block's memory is that of its sets.
        def sets():
            for batch in batches:
                shingles = list(_sets(batch["text"].tolist(), width))
                yield batch.assign(text=pd.Series(shingles, index=batch.index, dtype=object))

        for rows in key_lists(sets(), ("comp", "i", "j"), columns):
            kept, ids = [], set()
            for r in rows:
                # An id stands for the set with its digest, once.
                if r[0] not in ids and _digest(r[3]) == (r[1], r[2]):
                    ids.add(r[0])
                    kept.append(r)
            if len(kept) < 2:
                continue
            members = [r[3] for r in kept]

            def same(i: int, j: int) -> bool:
                x, y = members[i], members[j]
                both = len(np.intersect1d(x, y, assume_unique=True))
                return den * both >= num * (len(x) + len(y) - both)

            cross = kept[0][4] != kept[0][5]
            found = sized_links(
                np.array([len(s) for s in members], dtype=np.int64),
                [signature(s) for s in members],
                num,
                den,
                same,
                [r[6] for r in kept] if cross else None,
            )
            out.extend((kept[a][0], kept[b][0]) for a, b in found)
            if len(out) >= 10_000:
                yield _edges(out)
                out = []
        yield _edges(out)

    return run


def _dealt(df: DataFrame, blocks: str) -> DataFrame:
    """Each row once for every pair of sub-blocks its own one is part of (one pair as a rule)."""
    side = F.pmod(F.xxhash64("id"), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")))
    return (
        df.withColumn("side", side)
        .withColumn("_other", other)
        .withColumn("i", F.least("side", "_other"))
        .withColumn("j", F.greatest("side", "_other"))
        .drop("_other", blocks)
    )


def jaccard_components(
    docs: DataFrame,
    *,
    width: int = 5,
    num: int = 80,
    den: int = 100,
    key: str = "doc_id",
    text: str = "text",
    group_rows: int = 4096,
    block_shingles: int = 2_000_000,
) -> DataFrame:
    """key, n_shingles and component_id of every row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    first = stored(
        texts.mapInPandas(
            _first_pass(width), "key long, n long, d1 long, d2 long, sig binary, block int, counts binary"
        ),
        "jaccard-sets",
    )
    rows = first.where("block is null").select("key", "n", "d1", "d2")
    distinct = ranked(
        rows.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("key").alias("least")),
        "d1", "d2", "n", name="jaccard-ids", column="id",
    )
    distinct = stored(distinct, "jaccard-distinct")

    # Distinct sets only; a name of two sets, should there be one, has the rows of both.
    signatures = (
        first.where("block is null and n > 0")
        .groupBy("d1")
        .agg(F.collect_set(F.struct("n", "sig")).alias("sets"))
        .select("d1", F.explode("sets").alias("set"))
        .select("d1", "set.n", "set.sig")
    )
    rarity = spark.sparkContext.broadcast(_rarity(_sketch(first)))
    rare = rows.where("n > 0").agg(F.sum(F.expr(f"n - ({num} * n + {den - 1}) div {den} + 1"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rare // _READ))
    shared = (
        texts.mapInPandas(_second_pass(width, num, den, 4 * parts, rarity), "bucket int, data binary")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket")
        .mapInPandas(_groups(num, den), "g1 long, g2 long, part int, members int, sets binary")
    )
    members = (
        shared.repartition("g1", "g2")
        .sortWithinPartitions("g1", "g2", "part")
        .mapInPandas(_members, "g1 long, g2 long, members int, d1 long")
    )
    members = members.join(signatures, "d1").select(
        F.col("d1").alias("id"), "g1", "g2", "n", "sig", F.ceil(F.col("members") / group_rows).alias("blocks")
    )
    forests = (
        _dealt(members, "blocks")
        .repartition("g1", "g2", "i", "j")
        .sortWithinPartitions("g1", "g2", "i", "j")
        .mapInPandas(_forests(num, den), "a long, b long")
    )
    near = stored(components(forests, "jaccard-near"), "jaccard-blocks")

    sized = near.select(F.col("id").alias("d1"), F.col("component").alias("comp")).join(distinct, "d1")
    blocks = sized.groupBy("comp").agg(F.ceil(F.sum("n") / block_shingles).alias("blocks"))
    work = stored(sized.join(blocks, "comp"), "jaccard-work").alias("w")
    if work.count() <= MOST_KEYS:
        # One number for null and -1; the join below tells them apart.
        wanted = work.select(F.coalesce("least", F.lit(-1)).alias("_wanted"))
        texts = texts.join(F.broadcast(wanted), F.coalesce("key", F.lit(-1)) == F.col("_wanted"), "left_semi")
    held = work.join(texts.alias("t"), F.col("w.least").eqNullSafe(F.col("t.key"))).select("w.*", "t.text")
    edges = (
        _dealt(held.select("id", "comp", "d1", "d2", "text", "blocks"), "blocks")
        .repartition("comp", "i", "j")
        .sortWithinPartitions("comp", "i", "j")
        .mapInPandas(_exact(width, num, den), "a long, b long")
    )
    linked = components(edges, "jaccard-links")
    named = distinct.join(linked, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("d1", "d2", "n", "component_id")
    return (
        rows.alias("r")
        .join(named.alias("m"), ["d1", "d2", "n"], "left")
        .select(
            F.col("key").alias(key),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("m.component_id")).otherwise(F.col("key")).alias("component_id"),
        )
    )


def first_of_groups(docs: DataFrame, groups: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that name their component; of repeated rows one, null ids all."""
    others = groups.where(f"component_id <> {key}").select(key).distinct()
    again = groups.where(f"{key} is not null").groupBy(key).count().where("count > 1").select(key)
    again = stored(again, "jaccard-again")
    kept = docs.join(others, key, "left_anti").select(*docs.columns)
    if again.isEmpty():
        return kept
    twice = kept.join(again, key, "left_semi").select(*docs.columns).dropDuplicates([key, text])
    return kept.join(again, key, "left_anti").select(*docs.columns).unionByName(twice)


def one_of_each(docs: DataFrame, groups: DataFrame, *, row: str, key: str = "doc_id") -> DataFrame:
    """One document of each component: that of the smallest id, null ones last.

    ``groups`` is a result of ``jaccard_components`` over ``docs`` with ``row``, a number of
    its own for every row, as the key. So repeated and null ids are documents like others,
    and every component keeps exactly one.
    """
    rank = F.struct(F.col(key).isNull(), F.col(key), F.col(row))
    ranked_rows = docs.select(row, rank.alias("_rank")).join(groups.select(row, "component_id"), row)
    kept = ranked_rows.groupBy("component_id").agg(F.min_by(row, "_rank").alias("_kept"), F.count("*").alias("_rows"))
    kept = kept.where("_rows > 1")
    dropped = stored(ranked_rows.join(kept, "component_id").where(f"{row} <> _kept").select(row), "jaccard-dropped")
    return docs.join(small(dropped), row, "left_anti").select(*docs.columns)
