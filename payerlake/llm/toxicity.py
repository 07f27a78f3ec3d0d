"""Toxicity scores: a lexicon's trie intersected with Levenshtein automata, and context windows.

The lexicon is learned from a bounded sample of labelled texts (``TRAIN_ROWS``): terms, and stems
that begin a word, whose presence sets toxic texts apart, picked one after the other by what they
explain of the toxic texts that earlier ones left. The terms' trie and the Levenshtein automata of
all terms run as one deterministic automaton: a state is the set of (trie node, edits) pairs a
misspelled term may have reached, and its table has a few thousand states. Words take one table
look-up a character, all distinct words of a batch at a time, and most end after a few.

A hit counts by how it is found (exact or misspelled; each has its own weight, as some edits of
some terms are common words) and by the ``CONTEXT`` words around it: between quotation marks or
behind a verb of reporting it is a quotation, with a second person beside it an address. A
logistic regression on a text's hits, their density and their context, fitted on the same sample
from a prior that discounts quotations, gives the score. What is broadcast is the automaton and
the weights, bounded by ``TERMS``; there is no shuffle of texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import hash_sample, small_batches, text_or_empty

TRAIN_ROWS, TRAIN_CHARS = 5000, 20_000
TERMS, MIN_DOCS, MIN_LIFT, STRONG_LIFT = 64, 5, 8.0, 20.0
STEM = range(4, 9)
EDITS_FROM = 5  # terms of fewer letters must match exactly; longer ones may have one edit
CONTEXT = 8
LONGEST = 40  # a word's letters beyond these are read as one more letter

# Verbs of reporting and second persons in the languages of the corpus.
REPORTING = frozenset("""said says say wrote writes called calls quoted quote quotes quoting reported reports
sagte sagt schrieb nannte zitiert zitat dijo dice escribió llamó cita citó dit disait écrit appelé citait
""".split())
SECOND_PERSON = frozenset("""you your yours you're du dich dir dein deine ihr euch tu te toi ton vous votre vos
tú ti tus usted ustedes vosotros""".split())
QUOTES = "\"'«»“”„‘’‹›"
FEATURES = ("direct", "quoted", "address", "density", "terms")
# Where the sample says nothing, direct hits speak for and quoted ones do not.
PRIOR = np.array([1.0, 0.0, 0.3, 0.5, 0.5])

LETTERS = re.compile(r"[^\W_](?:.*[^\W_])?", re.DOTALL)


def bare(word: str) -> str:
    """The word in lower case without signs at its ends."""
    found = LETTERS.search(word)
    return found[0].lower() if found else ""


@dataclass
class Automaton:
    """Trie of (term, is stem) pairs times Levenshtein automata, as one table over character classes."""

    terms: list[tuple[str, bool]]
    classes: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | None = None
    accepts: np.ndarray | None = None  # term * 2 + edits at a word's end, or -1

    def __post_init__(self):
        self.classes = {c: i + 1 for i, c in enumerate(sorted({c for t, _ in self.terms for c in t}))}
        nodes: list[dict] = [{}]
        ends: dict[int, int] = {}
        edits: list[int] = [0]  # most edits of any term below a node
        for n, (term, _) in enumerate(self.terms):
            at, most = 0, int(len(term) >= EDITS_FROM)
            edits[0] = max(edits[0], most)
            for c in term:
                if c not in nodes[at]:
                    nodes[at][c] = len(nodes)
                    nodes.append({})
                    edits.append(0)
                at = nodes[at][c]
                edits[at] = max(edits[at], most)
            ends[at] = n

        def close(pairs: set[tuple[int, int]]) -> frozenset:
            """With letters of the term left out, and done stems marked (-1 - term)."""
            todo, out = list(pairs), set()
            while todo:
                at, e = todo.pop()
                if (at, e) in out or at >= 0 and e > edits[at]:
                    continue
                out.add((at, e))
                if at >= 0:
                    todo += [(kid, e + 1) for kid in nodes[at].values()]
                    if at in ends and self.terms[ends[at]][1]:
                        todo.append((-1 - ends[at], e))
            # Of one place only the fewest edits matter.
            least: dict[int, int] = {}
            for at, e in out:
                least[at] = min(e, least.get(at, e))
            return frozenset(least.items())

        def accepted(state: frozenset) -> int:
            done = [(e, -len(self.terms[n][0]), n) for at, e in state
                    for n in ([-1 - at] if at < 0 else [ends[at]] if at in ends else [])
                    if e <= int(len(self.terms[n][0]) >= EDITS_FROM)]
            return min(done)[2] * 2 + min(done)[0] if done else -1

        start = close({(0, 0)})
        number, todo, rows, accepts = {frozenset(): 0, start: 1}, [start], {0: [0] * (len(self.classes) + 1)}, {0: -1}
        while todo:
            state = todo.pop()
            row = []
            for c in ["", *self.classes]:
                nxt = set()
                for at, e in state:
                    if at < 0:
                        nxt.add((at, e))
                        continue
                    nxt.add((at, e + 1))  # one letter too many
                    for kid_char, kid in nodes[at].items():
                        nxt.add((kid, e + (kid_char != c)))
                nxt = close(nxt)
                if nxt not in number:
                    number[nxt] = len(number)
                    todo.append(nxt)
                row.append(number[nxt])
            rows[number[state]] = row
            accepts[number[state]] = accepted(state)
        self.table = np.array([rows[i] for i in range(len(rows))], np.int32)
        self.accepts = np.array([accepts[i] for i in range(len(rows))], np.int32)

    def find(self, words: list[str]) -> np.ndarray:
        """Each word's term * 2 + edits, or -1; all words advance together and leave when they can't match."""
        found = np.full(len(words), -1, np.int32)
        if not self.terms or not words:
            return found
        cut = [w[:LONGEST] for w in words]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        points = np.frombuffer("".join(cut).encode("utf-32-le", "replace"), np.uint32)
        low = np.zeros(max(map(ord, self.classes)) + 2, np.int32)
        for c, i in self.classes.items():
            low[ord(c)] = i
        kinds = low[np.minimum(points, len(low) - 1)]
        starts = np.cumsum(sizes) - sizes
        alive, state = np.arange(len(cut)), np.ones(len(cut), np.int32)
        place = 0
        while len(alive):
            ended = sizes[alive] == place
            found[alive[ended]] = self.accepts[state[ended]]
            alive, state = alive[~ended], state[~ended]
            state = self.table[state, kinds[starts[alive] + place]]
            alive, state = alive[state > 0], state[state > 0]
            place += 1
        return found


def terms_of(text: str) -> set[tuple[str, bool]]:
    """A text's words, and the stems that begin them."""
    words = {bare(w) for w in set(text.split())}
    own = {(w, False) for w in words if len(w) >= STEM[0]}
    return own | {(w[:n], True) for w, _ in own for n in STEM if len(w) > n}


def learn_terms(texts: list[str], toxic: np.ndarray) -> list[tuple[str, bool]]:
    """Words and stems by what each explains of the toxic texts not yet explained (log-likelihood gain)."""
    docs: dict[tuple[str, bool], list[int]] = defaultdict(list)
    toxic_terms: Counter = Counter()
    for text, t in zip(texts, toxic, strict=True):
        if t:
            toxic_terms.update(terms_of(text))
    candidates = {t for t, n in toxic_terms.items() if n >= MIN_DOCS}
    del toxic_terms
    for i, text in enumerate(texts):
        for t in terms_of(text) & candidates:
            docs[t].append(i)
    posting = {t: np.array(d) for t, d in docs.items()}
    left, chosen = np.ones(len(toxic), bool), []
    is_toxic = toxic.astype(bool)
    while len(chosen) < TERMS and (left & is_toxic).any():
        n_toxic, n_clean = (left & is_toxic).sum(), max((left & ~is_toxic).sum(), 1)
        best, gain = None, 0.0
        for t, d in list(posting.items()):
            d = d[left[d]]
            hits = int(is_toxic[d].sum())
            if hits < MIN_DOCS:
                del posting[t]
                continue
            lift = (hits / n_toxic) / ((len(d) - hits + 0.5) / n_clean)
            value = hits * math.log(lift) if lift >= MIN_LIFT else 0.0
            # Among equals the longest stem or the whole word.
            if (value, len(t[0]), t) > (gain, len(best[0]) if best else 0, best or ("", False)):
                best, gain = t, value
        if not gain:
            break
        chosen.append(best)
        left[posting[best][is_toxic[posting[best]]]] = False
        del posting[best]
    # Whole words that set toxic texts apart by themselves, also where others explained theirs.
    n_toxic, n_clean = max(is_toxic.sum(), 1), max((~is_toxic).sum(), 1)
    strong = []
    for t, found in docs.items():
        hits = int(is_toxic[found].sum())
        lift = (hits / n_toxic) / ((len(found) - hits + 0.5) / n_clean)
        if not t[1] and t not in chosen and hits >= 2 * MIN_DOCS and lift >= STRONG_LIFT \
                and not any(stem and t[0].startswith(c) for c, stem in chosen):
            strong.append((hits, t))
    return chosen + [t for _, t in sorted(strong, reverse=True)[:TERMS - len(chosen)]]


def context(words: list[str], at: int) -> tuple[bool, bool]:
    """Is word ``at`` quoted, and is somebody addressed beside it?"""
    lo, hi = max(0, at - CONTEXT), at + CONTEXT + 1
    before, after = words[lo:at + 1], words[at:hi]
    opened = sum(w[:1] in QUOTES for w in before if w) > sum(w[-1:] in QUOTES for w in before[:-1] if w)
    closed = any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in after if w.rstrip(".,;:!?"))
    around = {bare(w) for w in words[lo:hi]}
    return opened and closed or bool({bare(w) for w in before[:-1]} & REPORTING), bool(around & SECOND_PERSON)


@dataclass
class Scorer:
    automaton: Automaton
    weights: np.ndarray  # by term * 2 + edits
    coefficients: np.ndarray
    bias: float

    def features(self, words: list[str], hits: list[tuple[int, int]]) -> list[float]:
        """hits: (place, term * 2 + edits)."""
        direct = quoted = address = 0.0
        for at, what in hits:
            is_quoted, addressed = context(words, at)
            weight = self.weights[what]
            quoted += weight * is_quoted
            direct += weight * (not is_quoted)
            address += weight * (addressed and not is_quoted)
        total = direct + 0.25 * quoted
        terms = {what // 2 for _, what in hits if self.weights[what] > 0}
        return [math.log1p(direct), math.log1p(quoted), math.log1p(address),
                math.log1p(100 * total / max(len(words), 20)), math.log1p(len(terms))]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.coefficients + self.bias, -30, 30)))


def fit(texts: list[str], toxic: np.ndarray) -> Scorer:
    """Lexicon, hit weights and regression from labelled texts; with nothing to learn all score low."""
    terms = learn_terms(texts, toxic) if len(texts) else []
    automaton = Automaton(terms)
    hits = [h for lo in range(0, len(texts), 200) for h in find_hits(automaton, [t.split() for t in texts[lo:lo + 200]])]
    # Log odds of a text being toxic by its having a hit of this kind.
    n = 2 * max(len(terms), 1)
    seen = np.zeros((2, n))
    for own, t in zip(hits, toxic, strict=True):
        seen[int(t), sorted({w for _, w in own})] += 1
    n_toxic, n_clean = max(int(toxic.sum()), 1), max(int((1 - toxic).sum()), 1)
    lift = ((seen[1] + 0.1) / n_toxic) / ((seen[0] + 0.5) / n_clean)
    weights = np.where(lift >= 2, np.log(lift) / math.log(MIN_LIFT), 0.0)
    exact_only = seen.sum(axis=0) == 0  # a misspelling the sample lacks speaks like half of its term
    weights[1::2] = np.where(exact_only[1::2], weights[::2] / 2, weights[1::2])
    model = Scorer(automaton, weights, PRIOR.copy(), -3.0)
    if not len(texts):
        return model
    x = np.array([model.features(t.split() if h else [], h) for t, h in zip(texts, hits, strict=True)])
    model.coefficients, model.bias = regress(x, toxic.astype(float))
    return model


def regress(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, drawn to PRIOR."""
    x1 = np.column_stack([x, np.ones(len(x))])
    prior, pull = np.r_[PRIOR, -3.0], np.r_[np.ones(len(PRIOR)), 0.01]
    b = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x1 @ b, -30, 30)))
        grad = x1.T @ (p - y) + pull * (b - prior)
        step = np.linalg.solve((x1 * (p * (1 - p) + 1e-9)[:, None]).T @ x1 + np.diag(pull), grad)
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    return b[:-1], float(b[-1])


def find_hits(automaton: Automaton, texts: list[list[str]]) -> list[list[tuple[int, int]]]:
    flat = pa.array([w for ws in texts for w in ws], pa.string())
    return coded_hits(automaton, flat, np.cumsum([0, *map(len, texts)]))


def coded_hits(automaton: Automaton, words: pa.Array, offsets: np.ndarray) -> list[list[tuple[int, int]]]:
    """Hits of each text; words holds all texts' words, the automaton reads each distinct one once."""
    coded = words.dictionary_encode()
    kinds = automaton.find([bare(w) for w in coded.dictionary.to_pylist()])
    kinds = kinds[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int32)
    hits: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    places = np.flatnonzero(kinds >= 0)
    for of, at in zip(np.searchsorted(offsets, places, side="right") - 1, places, strict=True):
        hits[of].append((int(at - offsets[of]), int(kinds[at])))
    return hits


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          rows: int = TRAIN_ROWS) -> Scorer:
    """A scorer from at most ``rows`` labelled documents of at most TRAIN_CHARS characters.

    The sample is drawn from the labels by a hash of the key, so that only it meets the texts.
    Null keys, labels and texts are left out; of repeated labels the highest counts.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    sample = (hash_sample(known, key, rows).groupBy(key).agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64(key), key).limit(rows))
    short = docs.filter(F.length(text) <= TRAIN_CHARS).select(key, F.col(text).alias("text"))
    # At most ``rows`` keys and labels.
    found = short.join(F.broadcast(sample), key).orderBy(key, "text").limit(rows).select("text", "label").toArrow()
    return fit(found.column("text").to_pylist(), np.array(found.column("label").to_pylist(), np.int64))


def score_texts(docs: DataFrame, model: Scorer, key: str = "doc_id", text: str = "text",
                carry: Column | None = None, threshold: float = 0.7) -> DataFrame:
    """key, score (0 to 1), predicted (1 from the threshold on) and n_hits per row of ``docs``, and
    a boolean column ``carried`` if given.

    Null and empty texts score like texts without hits. Only key and text are read, whatever other
    columns are named; repeated rows stay repeated.
    """
    spark = docs.sparkSession
    small_batches(spark)
    table = spark.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = table.value
        for batch in batches:
            words = batch.column(2)
            flat, offsets = words.flatten(), words.offsets.to_numpy() - words.offsets[0].as_py()
            hits = coded_hits(scorer.automaton, flat, offsets)
            x = np.zeros((len(hits), len(FEATURES)))
            for i, own in enumerate(hits):
                if own:
                    x[i] = scorer.features(flat[offsets[i]:offsets[i + 1]].to_pylist(), own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scorer.score(x)),
                 pa.array([len(h) for h in hits], pa.int64())], ["key", "carried", "score", "n_hits"])

    words = F.array_remove(F.split(text_or_empty(text), r"[\x20\x09-\x0D]+"), "")
    out = (docs.select(F.col(key).alias("key"), (F.lit(False) if carry is None else carry).alias("carried"),
                       words.alias("words"))
           .mapInArrow(run, f"key {kind}, carried boolean, score double, n_hits long")
           .withColumnRenamed("key", key)
           .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
    return out if carry is not None else out.drop("carried")
