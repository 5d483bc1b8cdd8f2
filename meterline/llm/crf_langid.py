"""Language of every word with a linear-chain conditional random field.

Features of a word are its affixes (character n-grams with its start or end), its inner
n-grams and the word itself (the lexicon), hashed into two tables of fixed size. Emission
weights, transitions and start weights are learned together by maximum likelihood on a
bounded sample of labelled texts, cut into pieces that are strung together so that the
language changes inside sequences. Forward-backward gives every word of a text a
probability for each language; the text's language has the largest sum, and the score is
its share of all words.

Long texts are exact too: transfer matrices of blocks of words are chained first, then
all blocks run forward and backward at once. Each task needs the model (two tables of
2**16 rows) and a batch of texts.

Defined results: a text that is null or has no letter is ``und`` with score 0. Words are
runs of ASCII letters and of bytes beyond ASCII, in lower case. Ties go to the label that
is first by name. Without any labelled text everything is ``und``. Repeated rows are
labelled alike. Id, language and source are not inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.session import stored

UNKNOWN = "und"
TABLE = 1 << 16
BLOCK = 32
_KEEP = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PLACES = np.random.default_rng(11).integers(0, 2**63, size=(256, 32), dtype=np.uint64)


def letters(text: str) -> bytes:
    """Lower-case words between single separators, as UTF-8."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_KEEP)


def has_letter(text) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def word_features(buffer: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First the start of each word (its leading blank) and its lexicon slot, then for every
    n-gram length the positions and slots of the n-grams."""
    a = np.frombuffer(buffer, dtype=np.uint8)
    blank = a == 32
    start = np.flatnonzero(blank[:-1] & ~blank[1:])
    if not len(start):
        yield start, start
        return
    begun = np.zeros(len(a), dtype=np.int64)
    begun[start] = start
    place = np.arange(len(a)) - np.maximum.accumulate(begun)
    parts = np.where(blank, np.uint64(0), _PLACES[a, np.minimum(place, 31)])
    whole = np.add.reduceat(parts, start)
    yield start, ((whole >> np.uint64(40)) & np.uint64(TABLE - 1)).astype(np.int64)
    wide = a.astype(np.uint32)
    for n in (1, 2, 3, 4):
        if len(a) < n:
            return
        size = len(a) - n + 1
        h = np.full(size, n, dtype=np.uint32)
        good = np.ones(size, dtype=bool)
        for k in range(n):
            h = h * np.uint32(0x01000193) + wide[k : k + size]
            if 0 < k < n - 1:
                good &= ~blank[k : k + size]
        if n < 3:
            good &= ~(blank[:size] & blank[n - 1 :])
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        at = np.flatnonzero(good & (np.arange(size) >= start[0]))
        yield at, ((h[at] >> np.uint32(12)) & np.uint32(TABLE - 1)).astype(np.int64)


@dataclass
class Model:
    labels: list[str]
    grams: np.ndarray
    lexicon: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def emissions(self, buffer: bytes, window: int = 1 << 20) -> np.ndarray:
        """Scores of the words of a buffer that starts and ends with a blank."""
        out, at = [], 0
        while at < len(buffer) - 1:
            end = len(buffer)
            if end - at > window + 1:
                # Windows end at a blank, which also begins the next one.
                end = buffer.find(b" ", at + window) + 1
            out.append(self._window(buffer[at:end]))
            at = end - 1 if end < len(buffer) else end
        return np.concatenate(out) if out else np.zeros((0, len(self.labels)), dtype=np.float32)

    def _window(self, buffer: bytes) -> np.ndarray:
        parts = word_features(buffer)
        start, slots = next(parts)
        scores = self.lexicon[slots]
        if len(start):
            sums = np.zeros((len(buffer), len(self.labels)), dtype=np.float32)
            for at, slots in parts:
                sums[at] += self.grams[slots]
            scores = scores + np.add.reduceat(sums, start, axis=0)
        return scores


def posteriors(model: Model, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Word probabilities by forward-backward; ``sizes`` are the words of each text."""
    labels = len(model.labels)
    blocks = -(-sizes // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    total = int(blocks.sum())
    if not total:
        return np.zeros((0, labels))
    text = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(scores)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row, col = first_block[text] + inside // BLOCK, inside % BLOCK
    emit = np.ones((total, BLOCK, labels))
    raw = scores.astype(np.float64)
    emit[row, col] = np.exp(np.maximum(raw - raw.max(axis=1, keepdims=True), -30.0))
    real = np.zeros((total, BLOCK), dtype=bool)
    real[row, col] = True
    move = np.exp(model.moves - model.moves.max())
    begin = np.exp(model.first - model.first.max())

    # What a whole block does to a forward vector.
    whole = np.broadcast_to(np.eye(labels), (total, labels, labels)).copy()
    for k in range(BLOCK):
        new = (whole @ move) * emit[:, k, None, :]
        new /= new.sum(axis=(1, 2), keepdims=True)
        whole = np.where(real[:, k, None, None], new, whole)
    # The vector before the first word is chosen so that one move gives the start weights.
    enter = np.ones((total, labels))
    leave = np.ones((total, labels))
    start = np.zeros(total, dtype=bool)
    start[first_block[blocks > 0]] = True
    deepest = int(blocks.max())
    vector = np.broadcast_to(begin, (len(sizes), labels)).copy()
    for step in range(deepest):
        live = np.flatnonzero(blocks > step)
        at = first_block[live] + step
        enter[at] = vector[live]
        if step == 0:
            f = vector[live] * emit[at, 0]
            for k in range(1, BLOCK):
                g = (f @ move) * emit[at, k]
                f = np.where(real[at, k, None], g / g.sum(axis=1, keepdims=True), f)
            vector[live] = f
        else:
            v = np.einsum("bi,bij->bj", vector[live], whole[at])
            vector[live] = v / v.sum(axis=1, keepdims=True)
    back = np.ones((len(sizes), labels))
    for step in range(deepest - 1, -1, -1):
        live = np.flatnonzero(blocks > step)
        at = first_block[live] + step
        leave[at] = back[live]
        v = np.einsum("bij,bj->bi", whole[at], back[live])
        back[live] = v / v.sum(axis=1, keepdims=True)

    ahead = np.empty((total, BLOCK, labels))
    f = enter
    for k in range(BLOCK):
        g = f @ move if k else np.where(start[:, None], f, f @ move)
        g = g * emit[:, k]
        f = np.where(real[:, k, None], g / g.sum(axis=1, keepdims=True), f)
        ahead[:, k] = f
    b = leave
    for k in range(BLOCK - 1, -1, -1):
        both = ahead[:, k] * b
        ahead[:, k] = both / both.sum(axis=1, keepdims=True)
        g = (emit[:, k] * b) @ move.T
        b = np.where(real[:, k, None], g / g.sum(axis=1, keepdims=True), b)
    return ahead[row, col]


def fit(
    texts: list[str],
    langs: list[str],
    *,
    words: int = 50_000,
    length: int = 48,
    rounds: int = 30,
    rate: float = 0.3,
    decay: float = 1e-3,
    seed: int = 5,
) -> Model:
    """Learns from whole-text labels; at most ``words`` words, spread over the texts, are used."""
    labels = sorted(set(langs))
    count = len(labels)
    model = Model(labels, *(np.zeros((TABLE, count), np.float32) for _ in range(2)), np.zeros((count, count)), np.zeros(count))
    if not labels:
        return model
    rng = np.random.default_rng(seed)
    pieces: list[tuple[list[bytes], int]] = []
    for text, lang in zip(texts, langs):
        own = letters(text).split()
        at = 0
        while at < len(own):
            size = int(rng.integers(6, 40))
            pieces.append((own[at : at + size], labels.index(lang)))
            at += size
    picked, taken = [], 0
    for i in rng.permutation(len(pieces)):
        if taken >= words:
            break
        picked.append(pieces[i])
        taken += len(pieces[i][0])
    stream = [w for piece, _ in picked for w in piece]
    gold = np.array([y for piece, y in picked for _ in piece], dtype=np.int64)
    if len(stream) < length:
        times = -(-length // max(1, len(stream)))
        stream, gold = stream * times, np.tile(gold, times)
    use = len(stream) // length * length
    if not use:
        return model
    stream, gold = stream[:use], gold[:use]
    parts = word_features(b" " + b" ".join(stream) + b" ")
    start, lexicon = next(parts)
    owners, slots = [], []
    for at, s in parts:
        owners.append(np.searchsorted(start, at, "right") - 1)
        slots.append(s)
    owner, slot = (np.concatenate(x).astype(np.int32) for x in (owners, slots))
    order = np.argsort(owner, kind="stable")
    owner, slot = owner[order], slot[order]
    del owners, slots, order
    begin = np.searchsorted(owner, np.arange(use))

    y = gold.reshape(-1, length)
    hot = np.eye(count)[y]
    gold_moves = np.zeros((count, count))
    np.add.at(gold_moves, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    past = [np.full_like(x, 1e-6, dtype=np.float64) for x in (model.grams, model.lexicon, model.moves, model.first)]
    for _ in range(rounds):
        scores = np.add.reduceat(model.grams[slot], begin, axis=0) + model.lexicon[lexicon]
        emit = scores.reshape(-1, length, count).astype(np.float64)
        emit = np.exp(np.maximum(emit - emit.max(axis=2, keepdims=True), -30.0))
        move = np.exp(model.moves - model.moves.max())
        ahead = np.empty_like(emit)
        f = np.exp(model.first - model.first.max()) * emit[:, 0]
        ahead[:, 0] = f / f.sum(axis=1, keepdims=True)
        for k in range(1, length):
            f = (ahead[:, k - 1] @ move) * emit[:, k]
            ahead[:, k] = f / f.sum(axis=1, keepdims=True)
        b = np.ones((len(emit), count))
        moves = np.zeros((count, count))
        marginal = np.empty_like(emit)
        for k in range(length - 1, -1, -1):
            m = ahead[:, k] * b
            marginal[:, k] = m / m.sum(axis=1, keepdims=True)
            if k:
                eb = emit[:, k] * b
                pair = ahead[:, k - 1, :, None] * move[None] * eb[:, None, :]
                moves += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                b = eb @ move.T
                b /= b.sum(axis=1, keepdims=True)
        rest = (marginal - hot).reshape(-1, count)
        gradients = [
            np.stack([np.bincount(slot, rest[owner, c], TABLE) for c in range(count)], axis=1),
            np.stack([np.bincount(lexicon, rest[:, c], TABLE) for c in range(count)], axis=1),
            moves - gold_moves,
            (marginal[:, 0] - hot[:, 0]).sum(axis=0),
        ]
        for weights, gradient, seen in zip((model.grams, model.lexicon, model.moves, model.first), gradients, past):
            gradient = gradient / use + decay / use * weights
            seen += gradient**2
            weights -= rate * gradient / np.sqrt(seen)
    return model


def labelled_sample(
    docs: DataFrame, *, text: str, lang: str, key: str, per_label: int, most_texts: int, most_chars: int
) -> tuple[list[str], list[str]]:
    """Up to ``per_label`` texts of every label, those of the smallest hashes of id and text.

    None is longer than ``most_chars``, and with very many labels each has fewer, one at
    least, so that about ``most_texts`` reach the driver: the documented bound. The same
    documents give the same sample on any cluster. Hashes are ranked without the texts, and
    only the smallest parts of them.
    """
    usable = docs.where(F.col(lang).isNotNull() & (F.length(text) <= most_chars) & (F.length(text) > 0))
    rows = usable.select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.col(text), F.lit(3)).alias("hash")
    )
    counts = stored(rows.groupBy("lang").count(), "label-counts")
    take = max(1, min(per_label, most_texts // max(counts.count(), 1)))
    # Only hashes so small that they can be among the first are ranked: about eight times
    # as many as are taken, however many texts a label has.
    few = F.pmod("hash", F.lit(1_000_000_007)) * F.col("count") < F.lit(8.0 * take * 1_000_000_007)
    small = rows.join(counts, "lang").where(few).select("lang", "hash").distinct()
    order = Window.partitionBy("lang").orderBy(F.pmod("hash", F.lit(1_000_000_007)), "hash")
    placed = small.withColumn("place", F.row_number().over(order))
    chosen = placed.where(F.col("place") <= take).select("lang", "hash")
    # At most ``most_texts`` pairs, or one for each label.
    kept = rows.join(F.broadcast(chosen), ["lang", "hash"]).dropDuplicates(["lang", "hash"])
    found = sorted((r.lang, r.hash, r.text) for r in kept.collect())
    return [text for _, _, text in found], [lang for lang, _, _ in found]


def train(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_label: int = 200,
    most_texts: int = 12_800,
    most_chars: int = 20_000,
) -> Model:
    """A model from a bounded sample of ``docs``, whose ``lang`` holds the labels."""
    sample = labelled_sample(
        docs, text=text, lang=lang, key=key, per_label=per_label, most_texts=most_texts, most_chars=most_chars
    )
    return fit(*sample)


def _batches(batch: pd.DataFrame, most: int = 1 << 21) -> Iterator[pd.DataFrame]:
    held = np.cumsum(batch["text"].str.len().fillna(0).to_numpy()) // most
    for _, part in batch.groupby(held, sort=True):
        yield part


def label_texts(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score, n_words and runs (label, words) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for part in _batches(batch):
                yield _labelled(part, m)

    pairs = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    out = pairs.mapInPandas(
        run,
        "key long, lang_pred string, score double, n_words int, runs array<struct<lang: string, words: int>>",
    )
    return out.withColumnRenamed("key", key)


def keep_languages(docs: DataFrame, model: Model, *, least: float, text: str = "text") -> DataFrame:
    """The rows whose text has a language that holds at least ``least`` of its words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        frame = pd.DataFrame({"key": 0, "text": texts.reset_index(drop=True)})
        parts = [_labelled(p, shared.value) for p in _batches(frame)]
        found = pd.concat(parts) if parts else pd.DataFrame({"lang_pred": [], "score": []})
        return (found["lang_pred"] != UNKNOWN) & (found["score"] >= least)

    return docs.where(good(F.col(text)))


def _labelled(part: pd.DataFrame, model: Model) -> pd.DataFrame:
    buffers, sizes = [], []
    for text in part["text"].tolist():
        good = bool(model.labels) and has_letter(text)
        buffers.append(letters(text) if good else b"")
        sizes.append(len(buffers[-1].split()))
    sizes = np.array(sizes)
    scores = model.emissions(b" " + b" ".join(buffers) + b" ")
    chance = posteriors(model, scores, sizes)
    ends = np.cumsum(sizes)
    best = chance.argmax(axis=1) if len(chance) else np.zeros(0, dtype=np.int64)
    langs, shares, runs = [], [], []
    for end, size in zip(ends.tolist(), sizes.tolist()):
        if not size:
            langs.append(UNKNOWN)
            shares.append(0.0)
            runs.append([])
            continue
        total = chance[end - size : end].sum(axis=0)
        winner = int(total.argmax())
        langs.append(model.labels[winner])
        shares.append(min(1.0, float(total[winner]) / size))
        own = best[end - size : end]
        cuts = np.flatnonzero(np.diff(own)) + 1
        edges = [0, *cuts.tolist(), size]
        runs.append([{"lang": model.labels[int(own[a])], "words": b - a} for a, b in zip(edges, edges[1:])])
    return pd.DataFrame(
        {
            "key": part["key"].astype("Int64"),
            "lang_pred": langs,
            "score": shares,
            "n_words": sizes.astype(np.int32),
            "runs": runs,
        }
    )
