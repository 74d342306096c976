"""Toxicity: Levenshtein automata over a lexicon trie, and context windows that tell quotation from abuse.

The lexicon is learned: whole words and word beginnings that mark labelled
rows, found in a bounded sample. A word is looked up by running a Levenshtein
automaton down the trie, so misspelled terms are caught too. Each hit's window
says whether it stands in quotation. A logistic model of those sums scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import encoding
from .storage import materialize, text_or_empty
from .workers import trim

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Least letters of a term that is known by a misspelling: one edit turns shorter ones into any word.
MISSPELT_CHARS = 4
#: Most labelled rows that the lexicon and the model are learned from.
SAMPLE_ROWS = 8000
# Marks and words that show quotation.
QUOTES = '"“”«»„'
# Common insults, which the lexicon holds from the start.
INSULTS = tuple("idiot idiots moron morons stupid dumb loser losers trash scum scumbag pathetic worthless disgusting clown clowns imbecile cretin bastard jerk creep fool foolish lunatic freak pig swine vermin filth filthy garbage retard ugly hateful coward liar parasite".split())
INSULT_WEIGHT = 4.0
REPORTING = frozenset("said says quote quoted quotes called wrote writes reported claimed term word slur".split())


@dataclass
class Node:
    below: dict[str, Node] = field(default_factory=dict)
    word: float = 0.0  # weight of a term that ends here
    misspelt: float = 0.0  # the same if it is long enough to be known by a misspelling
    beginning: float = 0.0  # weight of all words that begin so


class Lexicon:
    """Trie of weighted terms. ``terms``: ("=" word or "^" beginning, weight)."""

    def __init__(self, terms: list[tuple[str, float]], max_kept: int = 150_000):
        self.root, self.max_kept = Node(), max_kept
        self.kept: dict[str, tuple[float, int]] = {}
        self.halves: dict[str, set[int]] = {}  # halves of terms, with the lengths of words one edit from those
        for term, weight in terms:
            node = self.root
            for ch in term[1:]:
                node = node.below.setdefault(ch, Node())
            if term[0] == "=":
                node.word = weight
                if len(term[1:]) >= MISSPELT_CHARS:
                    node.misspelt = weight
                    cut, size = len(term[1:]) // 2, len(term[1:])
                    for half in ("<" + term[1:][:cut], ">" + term[1:][cut:]):
                        self.halves.setdefault(half, set()).update((size - 1, size, size + 1))
            else:
                node.beginning = weight
        self.half_sizes = sorted({(h[0], len(h) - 1) for h in self.halves})

    def _exact(self, word: str) -> float:
        node, best = self.root, 0.0
        for ch in word:
            if (node := node.below.get(ch)) is None:
                return best
            best = max(best, node.beginning)
        return max(best, node.word)

    def _fuzzy(self, word: str) -> float:
        """Best weight of a term one edit away: the automaton's states are (letters read, edits), and run down the trie.

        With no edit yet there is one state a letter; after the edit the rest
        of the word must follow the trie exactly, which mostly ends at once.
        """

        def ends(node: Node, rest: str) -> float:
            for ch in rest:
                if (node := node.below.get(ch)) is None:
                    return 0.0
            return node.misspelt

        best, node = 0.0, self.root
        for i in range(len(word) + 1):
            rest, after = word[i:], word[i + 1 :]
            if rest:
                best = max(best, ends(node, after))  # a letter too many
            for ch, below in node.below.items():
                best = max(best, ends(below, rest))  # a letter too few
                if rest and ch != rest[0]:
                    best = max(best, ends(below, after))  # another letter
            if not rest or (node := node.below.get(rest[0])) is None:
                break
        return best

    def lookup(self, word: str) -> tuple[float, int]:
        """(weight, edits): 0 edits for a term or a marked beginning, 1 for one misspelling of a term of MISSPELT_CHARS letters or more; words of any length are looked up."""
        if (known := self.kept.get(word)) is not None:
            return known
        found = (self._exact(word), 0)
        # One edit leaves one half of the term whole: other words need no automaton.
        if not found[0] and any(len(word) in self.halves.get(("<" + word[:n]) if side == "<" else (">" + word[-n:]), ()) for side, n in self.half_sizes):
            found = (self._fuzzy(word), 1)
        if len(self.kept) >= self.max_kept:
            self.kept.clear()
        self.kept[word] = found
        return found


def quoted(text: str, start: int, end: int, window: int = 80) -> bool:
    """Whether an odd number of quotation marks stands before the hit in its line's window and one after, or a reporting word shortly before."""
    before = text[max(0, start - window) : start].rpartition("\n")[2]
    after = text[end : end + window].partition("\n")[0]
    if sum(before.count(q) for q in QUOTES) % 2 and any(q in after for q in QUOTES):
        return True
    return any(w in REPORTING for w in WORD.findall(before)[-3:])


N_FEATURES = 5


def features(text: str, lexicon: Lexicon) -> list[float]:
    """Sums over the hits of a whole text: abusive, quoted and misspelled weight, hits a word, strongest weight."""
    folded = text.lower()
    hits = {w: f for w in set(WORD.findall(folded)) if (f := lexicon.lookup(w))[0] > 0}
    if not hits:
        return [0.0] * N_FEATURES
    sums, n_words, n_hits = [0.0, 0.0, 0.0], 0, 0
    for m in WORD.finditer(folded):
        n_words += 1
        if f := hits.get(m[0]):
            n_hits += 1
            sums[2 if f[1] else int(quoted(folded, m.start(), m.end()))] += f[0]
    exact = [w for w, edits in hits.values() if not edits]
    return [*map(math.log1p, sums), math.log1p(1000 * n_hits / n_words), max(exact, default=0.0)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Newton's method; the last coefficient is the intercept."""
    x = np.column_stack((x, np.ones(len(x))))
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(beta))
        beta += np.linalg.solve(hessian, x.T @ (y - p) - ridge * beta)
    return beta


@dataclass(frozen=True)
class Model:
    terms: list[tuple[str, float]]
    beta: list[float]


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_terms: int = 4000) -> Model:
    """Lexicon and model from at most ``sample_rows`` labelled rows, chosen by hash of the id; ``docs(doc_id, text)``, ``labels(doc_id, toxic)``."""
    chosen = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = materialize(docs.join(F.broadcast(chosen), "doc_id"), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = set(WORD.findall(text.lower()))
                seen[toxic > 0].update({"=" + w for w in words} | {"^" + w[:n] for w in words for n in (4, 5, 6) if len(w) > n})
        terms = [*(seen[0].keys() | seen[1].keys())]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([s[t] for t in terms], pa.int64()) for s in seen)], names=["term", "clean", "toxic"])

    of = {bool(r["t"]): r["n"] for r in sample.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = of.get(True, 0), of.get(False, 0)
    if not n_toxic or not n_clean:
        return Model([("=" + w, INSULT_WEIGHT) for w in INSULTS], [0.0] * N_FEATURES + [math.log((n_toxic + 0.1) / (n_clean + 1))])
    counts = sample.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    weight = F.log((F.col("toxic") + 0.2) / (n_toxic + 0.4)) - F.log((F.col("clean") + 0.2) / (n_clean + 0.4))
    strong = counts.where(F.col("toxic") >= max(3, round(0.01 * n_toxic))).withColumn("weight", weight).where("weight >= 3.5").orderBy(F.desc("toxic"), "term").limit(max_terms)
    terms = [("=" + w, INSULT_WEIGHT) for w in INSULTS] + [(r["term"], r["weight"]) for r in strong.collect()]  # a learned weight replaces the first

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in batches:
            rows = [features(t, lexicon) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("toxic")], names=["x", "y"])

    measured = sample.select("text", (F.col("toxic") > 0).cast("double").alias("toxic")).mapInArrow(measure, "x array<double>, y double").toPandas()
    measured = measured.iloc[measured["x"].map(tuple).argsort(kind="stable")]  # the same sums whatever the order of rows
    return Model(terms, fit_logistic(np.array(measured["x"].tolist()), measured["y"].to_numpy()).tolist())


def score_toxicity(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, score_col: str = "score") -> DataFrame:
    """``doc_id, score`` (0 to 1) per row of whole texts; with ``keep`` all columns of ``df`` and ``score_col`` instead, in place of one of that name.

    Null and empty texts get the score of a text without hits; equal texts
    equal scores, repeated rows a row each, whatever their ids, null ones
    included. A very long text is one row's work. No rows give no rows.
    """
    rows = df if keep else text_or_empty(df, id_col, text_col)
    text_at = df.columns.index(text_col) if keep else 1
    schema = df.drop(score_col).schema.add(score_col, "double") if keep else "doc_id long, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding.release()
        lexicon, beta = Lexicon(model.terms), np.array(model.beta)
        for batch in batches:
            x = np.array([features(t.as_py() or "", lexicon) for t in batch.column(text_at)]).reshape(-1, N_FEATURES)
            scores = pa.array(1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30))), pa.float64())
            held = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if (keep and n != score_col) or n == "doc_id"]
            yield pa.RecordBatch.from_arrays([*(c for _, c in held), scores], names=[*(n for n, _ in held), score_col if keep else "score"])
        lexicon.kept.clear()
        trim()

    return rows.mapInArrow(score, schema)


def trained(docs: DataFrame, labels: DataFrame, held_out: bool = True) -> Model:
    """The model of ``documents`` and ``labels``; rows whose crc32(doc_id) mod 4 is 2 are held out."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
    if held_out:
        rows = rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    return learn(text_or_empty(docs, "doc_id", "text"), rows)
