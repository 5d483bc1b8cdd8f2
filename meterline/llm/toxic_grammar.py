"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read the words of a clause. Three only remember: that a target (a
second person, people) stood near, that a negation did, that speech is reported, which
ends with a conjunction. Two have output: an insult and a threat each write a weight on
their arc, or wait a few words for the target that makes them aimed. Their composition is
one transducer whose arcs are built as they are needed: a state and a word's role give
the next state and the weights that the arc adds to the sums of a clause. An insult is
reported, negated, aimed or plain; a threat counts where it is aimed, before or after its
target, and neither negated nor reported.

A clause yields these sums; a text yields their totals and the largest clause; a logistic
function turns them into the score.

Insult stems are learned, with the calibration, from a bounded sample of labelled texts: a
stem (a word or the first letters of several) is kept when it is far likelier in toxic
texts and stands in several toxic texts that are no copies of each other. Word lists for
the other roles are fixed values below and can be replaced.

Defined results: null and empty texts, very long ones as a whole like others, and texts without a match, get the score of no
evidence. Without labelled texts of both kinds the score is 0 everywhere. Repeated rows
score alike. Labels, language, source and id are not inputs of a score.
Columns beside id, text and label are not read, so they may have any name; an empty table
gives an empty one.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words of four languages for the roles that are not learned.
NEGATIONS = ("not", "never", "no", "isn", "aren", "nicht", "kein", "keine", "pas", "jamais", "nunca", "jamás")
REPORTS = ("said", "says", "told", "quoted", "called", "wrote", "sagte", "sagt", "dit", "disait", "dijo", "dice")
TARGETS = ("you", "your", "they", "them", "he", "she", "people", "du", "dich", "ihr", "tu", "toi", "vous", "usted", "ustedes")
THREATS = ("kill", "hurt", "destroy", "beat", "stab", "töten", "umbringen", "tuer", "frapper", "matar", "golpear")

CONJUNCTIONS = ("and", "but", "or", "und", "aber", "oder", "et", "mais", "ou", "y", "pero", "o")
# Endings under which a threat is still one.
ENDINGS = ("s", "es", "ed", "d", "ing")

INSULT, THREAT, TARGET, NEGATION, REPORT, CONJUNCTION, OTHER = range(7)
FEATURES = ("plain", "aimed", "negated", "reported", "threat", "largest")
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;\n]+")


PLAIN, AIMED, NEGATED, REPORTED, THREATENED = range(5)
# Where the weight of an arc comes from: the word read, the insult that waits, or one.
OF_WORD, OF_WAITING, ONE = range(3)


class Near:
    """Remembers a symbol for ``reach`` words (0: until ``until``, at most to the clause's end)."""

    def __init__(self, symbol: int, reach: int, until: int | None = None):
        self.symbol, self.reach, self.until, self.start = symbol, reach, until, 0

    def step(self, state: int, symbol: int) -> int:
        if symbol == self.symbol:
            return self.reach or 1
        if symbol == self.until:
            return 0
        return max(0, state - 1) if self.reach else state


class Waiting:
    """Waits ``reach`` words for a target, if its own symbol came without one."""

    def __init__(self, symbol: int, reach: int):
        self.symbol, self.reach, self.start = symbol, reach, 0

    def step(self, state: int, symbol: int, free: bool) -> int:
        if symbol == self.symbol:
            return self.reach if free else 0
        return 0 if symbol == TARGET else max(0, state - 1)


Arc = tuple[int, float, int]  # which sum, factor, where the weight comes from


class Composition:
    """The five transducers run as one: (state, symbol) gives the next state and an arc's weights."""

    def __init__(self, target: int = 5, negation: int = 3):
        self.memory = [Near(TARGET, target), Near(NEGATION, negation), Near(REPORT, 0, CONJUNCTION)]
        self.insult, self.threat = Waiting(INSULT, target), Waiting(THREAT, target)
        self.numbers = {(0, 0, 0, 0, 0): 0}
        self.states = [(0, 0, 0, 0, 0)]
        self.table: dict[tuple[int, int], tuple[int, tuple[Arc, ...]]] = {}

    def step(self, state: int, symbol: int) -> tuple[int, tuple[Arc, ...]]:
        found = self.table.get((state, symbol))
        if found is None:
            new, arcs = self._arc(self.states[state], symbol)
            if new not in self.numbers:
                self.numbers[new] = len(self.states)
                self.states.append(new)
            found = self.table[state, symbol] = self.numbers[new], arcs
        return found

    def _arc(self, state: tuple[int, ...], symbol: int) -> tuple[tuple[int, ...], tuple[Arc, ...]]:
        remembered = [part.step(s, symbol) for part, s in zip(self.memory, state)]
        aimed, negated, reported = (s > 0 for s in remembered)
        free = not (aimed or negated or reported)
        new = (*remembered, self.insult.step(state[3], symbol, free), self.threat.step(state[4], symbol, free))
        arcs: list[Arc] = []
        if symbol == INSULT:
            kind = REPORTED if reported else NEGATED if negated else AIMED if aimed else PLAIN
            arcs.append((kind, 1.0, OF_WORD))
        elif symbol == THREAT and aimed and not (negated or reported):
            arcs.append((THREATENED, 1.0, ONE))
        elif symbol == TARGET:
            if state[3]:
                arcs += [(PLAIN, -1.0, OF_WAITING), (AIMED, 1.0, OF_WAITING)]
            if state[4]:
                arcs.append((THREATENED, 1.0, ONE))
        return new, tuple(arcs)


@dataclass
class Grammar:
    """Stems with weights, the roles of words, and the calibration."""

    stems: dict[str, float]
    roles: dict[str, int]
    weights: np.ndarray
    bias: float
    means: np.ndarray
    composition: Composition = field(default_factory=Composition)

    def __post_init__(self):
        anchors = sorted([*self.stems, *(w for w, r in self.roles.items() if r == THREAT)])
        by_first = defaultdict(list)
        for a in anchors:
            by_first[a[0]].append(re.escape(a[1:]))
        body = "|".join(f"{re.escape(k)}(?:{'|'.join(v)})" for k, v in sorted(by_first.items()))
        self.anchor = re.compile(rf"(?<![^\W\d_])(?:{body})") if body else None
        self.sizes = sorted({len(s) for s in self.stems})

    def insult(self, word: str) -> float:
        return max((self.stems.get(word[:n], 0.0) for n in self.sizes if n <= len(word)), default=0.0)

    def role(self, word: str) -> int:
        found = self.roles.get(word)
        if found is None:
            roots = (self.roles.get(word.removesuffix(e)) for e in ENDINGS if word.endswith(e))
            found = THREAT if THREAT in roots else OTHER
        return found

    def clause(self, words: list[str]) -> np.ndarray:
        """plain, aimed, negated, reported and threat weight of a clause."""
        out = [0.0] * 5
        state, waiting = 0, 0.0
        for word in words:
            weight = self.insult(word)
            state, arcs = self.composition.step(state, INSULT if weight else self.role(word))
            for kind, factor, source in arcs:
                out[kind] += factor * (weight, waiting, 1.0)[source]
            waiting = weight or waiting
        return np.array(out)

    def features(self, text) -> np.ndarray:
        total = np.zeros(len(FEATURES))
        if self.anchor is None or not isinstance(text, str):
            return total
        text = text.lower()
        end = -1
        for m in self.anchor.finditer(text):
            if m.start() < end:
                continue
            a = 1 + max(text.rfind(c, 0, m.start()) for c in ".!?;\n")
            after = _CLAUSE.search(text, m.end())
            end = after.start() if after else len(text)
            found = self.clause(_WORD.findall(text, a, end))
            total[:5] += found
            total[5] = max(total[5], found.sum())
        return total

    def score(self, features: np.ndarray) -> np.ndarray:
        x = np.log1p(np.maximum(features, 0.0)) - self.means
        return 1.0 / (1.0 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def _families(words: list[set[str]]) -> np.ndarray:
    """A number for each text; texts that share many words (copies) share a number."""
    up = list(range(len(words)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    seen: dict = {}
    for i, own in enumerate(words):
        if not own:
            continue
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in own], dtype=np.uint64)
        signs = [int((hashes * np.uint64(2 * s + 1) ^ (hashes >> np.uint64(s + 7))).min()) for s in range(12)]
        for band in range(0, 12, 3):
            j = seen.setdefault((band, *signs[band : band + 3]), i)
            a, b = root(i), root(j)
            up[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(len(words))])


def learn_stems(
    texts: list[str], labels: list[int], *, shortest: int = 4, longest: int = 9, least: int = 3, odds: float = 3.0
) -> dict[str, float]:
    """Stems far likelier in toxic texts, with the logarithm of their odds as weight."""
    words = [set(_WORD.findall(t.lower())) for t in texts]
    family = _families(words)
    toxic, clean = defaultdict(set), Counter()
    for own, kin, label in zip(words, family.tolist(), labels):
        stems = {w[:n] for w in own for n in range(shortest, min(longest, len(w)) + 1)}
        if label:
            for s in stems:
                toxic[s].add(kin)
        else:
            clean.update(stems)
    kinds = len({k for k, y in zip(family.tolist(), labels) if y})
    others = len(labels) - sum(labels)
    weights = {}
    for stem, kin in toxic.items():
        if len(kin) >= least:
            weight = np.log((len(kin) + 0.5) / (kinds + 1)) - np.log((clean[stem] + 0.5) / (others + 1))
            if weight >= odds and len(kin) >= 3 * clean[stem]:
                weights[stem] = (len(kin), float(weight))
    kept: dict[str, float] = {}
    # The longest stem with the same support says the same more exactly.
    for stem in sorted(weights, key=lambda s: (-weights[s][0], -len(s), s)):
        if not any(stem.startswith(k) or k.startswith(stem) for k in kept):
            kept[stem] = weights[stem][1]
    return kept


def fit(texts: list[str], labels: list[int], shares: tuple[float, float] = (1.0, 1.0)) -> Grammar:
    """Stems and calibration; ``shares`` are the sampled parts of the clean and the toxic texts."""
    roles = {
        **dict.fromkeys(THREATS, THREAT),
        **dict.fromkeys(TARGETS, TARGET),
        **dict.fromkeys(NEGATIONS, NEGATION),
        **dict.fromkeys(REPORTS, REPORT),
        **dict.fromkeys(CONJUNCTIONS, CONJUNCTION),
    }
    size = len(FEATURES)
    if len(set(labels)) < 2:
        return Grammar({}, roles, np.zeros(size), -30.0, np.zeros(size))
    grammar = Grammar(learn_stems(texts, labels), roles, np.zeros(size), 0.0, np.zeros(size))
    x = np.log1p(np.array([grammar.features(t) for t in texts]))
    y = np.asarray(labels, dtype=float)
    means = x.mean(axis=0)
    design = np.hstack([x - means, np.ones((len(x), 1))])
    case = np.where(y == 1, 1 / shares[1], 1 / shares[0])
    case /= case.mean()
    w = np.zeros(size + 1)
    ridge = np.diag([1e-1] * size + [1e-6])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (case * (p - y)) + ridge @ w
        curve = (design * (case * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design + ridge
        move = np.linalg.solve(curve, gradient)
        w -= move * min(1.0, 4.0 / (np.abs(move).max() + 1e-12))
    return Grammar(grammar.stems, roles, w[:-1], float(w[-1]), means)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_label: int = 2_500,
    most_chars: int = 20_000,
) -> Grammar:
    """A grammar from at most ``per_label`` texts of either label, none above ``most_chars``.

    The ids are chosen first (a bounded list, by hash); only their texts are fetched. An id
    with several labels has the largest; null labels and ids are ignored.
    """
    marked = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(F.col(label).cast("int")).alias("_label"))
    )
    counts = {r["_label"]: r["count"] for r in marked.groupBy("_label").count().collect()}
    unit = F.pmod(F.xxhash64("_key", F.lit(9)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    shares, chosen = [], None
    for y in (0, 1):
        share = min(1.0, per_label / counts[y]) if counts.get(y) else 1.0
        shares.append(share)
        # In total order, so that the same labels give the same sample on any cluster.
        part = marked.where((F.col("_label") == y) & (unit < share)).orderBy(unit, "_key").limit(per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(
        F.length("_text") <= most_chars
    )
    # At most 2 * per_label ids are broadcast.
    found = texts.join(F.broadcast(chosen), "_key").select("_key", "_text", "_label").distinct()
    ordered = found.orderBy(F.xxhash64("_key"), "_text", "_label").limit(2 * per_label)
    rows = sorted(ordered.select("_text", "_label").collect())
    return fit([r[0] for r in rows], [int(r[1] > 0) for r in rows], (shares[0], shares[1]))


def score_texts(docs: DataFrame, grammar: Grammar, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score, predicted and the clause sums of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches):
        g = shared.value
        for batch in batches:
            found = np.array([g.features(t) for t in batch["text"].tolist()]).reshape(-1, len(FEATURES))
            score = g.score(found)
            out = pd.DataFrame(dict(zip(FEATURES, found.T)))
            out.insert(0, "key", batch["key"].astype("Int64").to_numpy())
            out.insert(1, "score", score)
            out.insert(2, "predicted", (score >= 0.5).astype(np.int32))
            yield out

    pairs = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    schema = "key long, score double, predicted int, " + ", ".join(f"{f} double" for f in FEATURES)
    return pairs.mapInPandas(run, schema).withColumnRenamed("key", key)
