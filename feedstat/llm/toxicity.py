"""Toxicity: Levenshtein automata over a learned lexicon, with context windows.

The lexicon is learned from labels: words, and stems with several endings, that stand in
toxic texts more often than chance allows, each with the log-odds it shows. It is held as a
trie. A Levenshtein automaton runs through the trie together with each distinct word of a
batch; its states are made as words need them. Every term of four letters or more may be
misspelled, and a misspelling counts the less the weaker its term is; words met in clean texts
are never taken for a misspelling. The words around each hit tell quotation from abuse; a
logistic function of the strongest and of all evidence, fitted on labelled rows that the
lexicon was not learned from, is the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedstat.llm.arrays import starts_of, text_batches
from feedstat.llm.quality_model import fold, score, words_of
from feedstat.session import materialize

#: Toxic labelled rows used at most, and three times as many clean ones: those first in hash order of their ids.
TRAIN_ROWS = 4000
MAX_TERMS = 400
STEM_LENGTHS = (4, 5, 6)
CONTEXT = 4
#: Evidence: least G statistic of a term, most log-odds of one, least of a stem.
LEAST_G, MOST_ODDS, LEAST_STEM = 24.0, 6.0, 2.0
#: Evidence of a misspelled term of six letters or more, of a shorter one, if the term has ``MOST_ODDS``; it falls
#: with a power of the term's odds, as weak terms lie near many ordinary words. Each fit picks one of these powers.
NEAR_LONG_ODDS, NEAR_SHORT_ODDS, NEAR_POWERS = 5.5, 5.0, (1, 2, 3, 5)
#: What a quotation leaves of any evidence.
QUOTED_SHARE = 0.25
QUOTES = "\"“”„«»‹›‘’"
#: Fixed words: they report or cite what others say.
REPORTING = {"said", "says", "wrote", "quote", "quoted", "called", "term", "word", "sagte", "schrieb", "dit", "écrit", "dijo", "escribió"}


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


def plain(word: str) -> str:
    """Lower case, without what is no letter or digit at either end."""
    word = word.lower()
    if word.isalnum():
        return word
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    return word[start:end]


class LexiconAutomaton:
    """Words within the allowed edits of a term, or that start with a stem.

    ``terms`` and ``stems`` give the log-odds of each; terms may be misspelled, stems not. A state is a set of (trie node, edits left). ``match`` gives the evidence of a word.
    """

    def __init__(self, terms: dict[str, float], stems: dict[str, float], power: float = 3):
        self.children: list[dict[str, int]] = []
        self.ends: list[list[tuple[float, float, bool]]] = []
        start: dict[int, int] = {}
        for text, odds, stem in [(t, o, False) for t, o in terms.items()] + [(s, o, True) for s, o in stems.items()]:
            # terms with different allowances have tries of their own under one root each
            allowed = 0 if stem else edits_allowed(text)
            if allowed not in start:
                start[allowed] = self._node()
            node = start[allowed]
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = self._node()
                node = self.children[node][letter]
            near = (NEAR_LONG_ODDS if len(text) >= 6 else NEAR_SHORT_ODDS) * (odds / MOST_ODDS) ** power
            self.ends[node].append((odds, near, stem))
        self.allowed = {}
        for allowed, root in start.items():
            stack = [root]
            while stack:
                node = stack.pop()
                self.allowed[node] = allowed
                stack.extend(self.children[node].values())
        self.states: dict[frozenset, int] = {}
        self.next: list[dict[str, int]] = []
        self.sets: list[frozenset] = []
        self.evidence: list[tuple[float, float, bool]] = []
        self.first = self._state({root: allowed for allowed, root in start.items()})

    def _node(self) -> int:
        self.children.append({})
        self.ends.append([])
        return len(self.children) - 1

    def _state(self, nodes: dict[int, int]) -> int:
        """The state of ``nodes`` and what a skipped letter of the term leads to."""
        todo = list(nodes.items())
        while todo:
            node, left = todo.pop()
            if left:
                for child in self.children[node].values():
                    if nodes.get(child, -1) < left - 1:
                        nodes[child] = left - 1
                        todo.append((child, left - 1))
        key = frozenset(nodes.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.next.append({})
            self.evidence.append(self._evidence(key))
        return self.states[key]

    def _evidence(self, key: frozenset) -> tuple[float, float, bool]:
        """Evidence of a word that ends here, of one that goes on, and whether the former is of a misspelling."""
        ending, going, near = 0.0, 0.0, False
        for node, left in key:
            for odds, misspelled, stem in self.ends[node]:
                own = odds if left == self.allowed[node] else misspelled
                if own > ending:
                    ending, near = own, left < self.allowed[node]
                if stem:
                    going = max(going, own)
        return ending, going, near

    def _step(self, state: int, letter: str) -> int:
        nodes: dict[int, int] = {}
        for node, left in self.sets[state]:
            if left:
                nodes[node] = max(nodes.get(node, -1), left - 1)
            for own, child in self.children[node].items():
                rest = left if own == letter else left - 1
                if rest >= 0:
                    nodes[child] = max(nodes.get(child, -1), rest)
        after = self._state(nodes)
        self.next[state][letter] = after
        return after

    def match(self, word: str) -> tuple[float, bool]:
        """The evidence of ``word``, and whether it is of a misspelling."""
        state, stem = self.first, 0.0
        for letter in word:
            after = self.next[state].get(letter)
            state = self._step(state, letter) if after is None else after
            if not self.sets[state]:
                return stem, False
            stem = max(stem, self.evidence[state][1])
        ending, _, near = self.evidence[state]
        return (ending, near) if ending > stem else (stem, False)


@dataclass
class Lexicon:
    terms: dict[str, float]
    stems: dict[str, float]
    ordinary: frozenset = frozenset()
    weights: tuple[float, float] = (0.0, 0.0)
    bias: float = -3.0
    power: float = 3

    def __post_init__(self):
        self.automaton = None

    def __getstate__(self):
        return {**self.__dict__, "automaton": None}

    def evidence(self, word: str) -> tuple[float, bool]:
        if self.automaton is None:
            self.automaton = LexiconAutomaton(self.terms, self.stems, self.power)
        word = plain(word)
        odds, near = self.automaton.match(word) if word else (0.0, False)
        return (0.0, False) if near and word in self.ordinary else (odds, near)

    def misspelled(self, text: str) -> str:
        """``text`` with one letter of each term that may be misspelled replaced."""
        words = []
        for word in text.split():
            own = plain(word)
            if own in self.terms and edits_allowed(own):
                at = 1 + sum(map(ord, own)) % (len(own) - 1)
                word = word.lower().replace(own, own[:at] + ("x" if own[at] != "x" else "z") + own[at + 1 :])
            words.append(word)
        return " ".join(words)

    def measures(self, texts: list[str]) -> np.ndarray:
        """Per text, the most evidence that a word gives in its context, and the logarithm of all evidence."""
        words, flat, counts = words_of(texts)
        odds = np.fromiter((self.evidence(w)[0] for w in words), float, len(words))
        own = odds[flat]
        at = np.flatnonzero(own)
        starts = starts_of(counts)
        doc = np.searchsorted(starts, at, side="right") - 1
        quotes = np.fromiter((any(q in w for q in QUOTES) for w in words), bool, len(words))[flat]
        reports = np.fromiter((plain(w) in REPORTING for w in words), bool, len(words))[flat]
        quote_sum, report_sum = starts_of(quotes), starts_of(reports)
        low, high = np.maximum(at - CONTEXT, starts[doc]), np.minimum(at + CONTEXT + 1, starts[doc + 1])
        # quotation marks on both sides (or on the word itself), or a reporting word near
        cited = (quote_sum[at + 1] > quote_sum[low]) & (quote_sum[high] > quote_sum[at])
        cited |= report_sum[high] > report_sum[low]
        found = own[at] * np.where(cited, QUOTED_SHARE, 1.0)
        most = np.zeros(len(texts))
        np.maximum.at(most, doc, found)
        return np.stack([most / MOST_ODDS, np.log1p(np.bincount(doc, found, minlength=len(texts)))], axis=1)

    def scores(self, texts: list[str]) -> np.ndarray:
        values = self.measures(texts) @ np.array(self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


def chosen_terms(counted: DataFrame, key: str, toxic: int, clean: int, most: int) -> dict[str, float]:
    """Keys whose ``toxic`` and ``clean`` counts differ by more than chance from those of all texts, with log-odds."""
    rate = toxic / (toxic + clean)
    own, other, total = F.col("toxic"), F.col("clean"), F.col("toxic") + F.col("clean")
    g = 2 * (own * F.log(own / (total * rate)) + F.when(other > 0, other * F.log(other / (total * (1 - rate)))).otherwise(0))
    odds = F.log((own + 0.5) / toxic / ((other + 0.5) / clean))
    found = (
        counted.where(own > 0).select(key, g.alias("g"), F.least(odds, F.lit(MOST_ODDS)).alias("odds"))
        .where((F.col("g") >= LEAST_G) & (F.col("odds") >= 1)).orderBy(F.desc("g"), key).limit(most)
    )
    return {r[key]: r.odds for r in found.collect()}


def learn_lexicon(texts: DataFrame) -> Lexicon:
    """Terms, stems and ordinary words from rows (``text``, ``label``).

    Only terms, stems and the ordinary words near them come to the driver, and all have limits:
    ``MAX_TERMS`` each, and what lies within two edits of those.
    """
    size = texts.agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = size.toxic or 0, size.n - (size.toxic or 0)
    if not toxic or not clean:
        return Lexicon({}, {})

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in text_batches(batches, "text"):
            found = [sorted({plain(w) for w in (t or "").split()} - {""}) for t in table["text"].to_pylist()]
            sizes = np.array([len(own) for own in found], np.int64)
            label = np.repeat(table["label"].to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for own in found for w in own], pa.string()), pa.array(label, pa.int32())], ["word", "label"]
            )

    counted = materialize(
        texts.select("text", "label").mapInArrow(words, "word string, label int").groupBy("word").agg(
            F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
        ),
        "word-labels",
    )
    terms = chosen_terms(counted.where(F.length("word") >= 3), "word", toxic, clean, MAX_TERMS)
    starts = F.array(*[F.substring("word", 1, n) for n in STEM_LENGTHS])
    grouped = (
        counted.where(F.length("word") > STEM_LENGTHS[0])
        .select("toxic", "clean", F.explode(F.array_distinct(starts)).alias("stem"))
        .groupBy("stem").agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum((F.col("toxic") > 0).cast("int")).alias("endings")
        )
        .where("endings >= 3")
    )
    found = chosen_terms(grouped, "stem", toxic, clean, MAX_TERMS)
    stems: dict[str, float] = {}
    for stem in sorted(found, key=lambda x: (len(x), x)):
        if found[stem] >= LEAST_STEM and not any(stem.startswith(shorter) for shorter in stems):
            stems[stem] = found[stem]
    lexicon = Lexicon(terms, stems)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([w for w in batch["word"].to_pylist() if lexicon.evidence(w)[1]], pa.string())
            yield pa.RecordBatch.from_arrays([own], ["word"])

    ordinary = counted.where("clean > 0").select("word").mapInArrow(near, "word string")
    lexicon.ordinary = frozenset(r.word for r in ordinary.collect())
    return lexicon


def fit_weights(measures: np.ndarray, labels: np.ndarray) -> tuple[tuple[float, float], float]:
    """Logistic regression with a small ridge and weights not below 0, by gradient descent.

    Both classes weigh the same, so the score does not depend on how many rows of each were taken.
    """
    weights, bias = np.zeros(2), 0.0
    if not len(labels) or labels.min() == labels.max():
        return (5.0, 0.5), -3.0
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    for _ in range(5000):
        chance = 1 / (1 + np.exp(-np.clip(measures @ weights + bias, -30, 30)))
        error = (chance - labels) * share
        weights = np.maximum(0, weights - measures.T @ error - 1e-4 * weights)
        bias -= error.sum()
    return (float(weights[0]), float(weights[1])), float(bias)


def balanced_loss(measures: np.ndarray, labels: np.ndarray, weights: tuple[float, float], bias: float) -> float:
    """Mean log loss with the same weight for both classes; 0 without rows."""
    chance = 1 / (1 + np.exp(-np.clip(measures @ np.array(weights) + bias, -30, 30)))
    loss = -np.log(np.where(labels == 1, chance, 1 - chance))
    return float(sum(loss[labels == label].mean() for label in (0, 1) if (labels == label).any()))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Lexicon:
    """A lexicon and its weights from at most ``most`` toxic and three times as many clean labelled rows.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``label`` (1 toxic, 0 not;
    null is left out). Equal texts count once. A quarter of the texts, by hash, fits the weights and is
    not used for the lexicon. Toxic texts of this quarter stand there twice, as they are and with
    their terms misspelled; the power of ``NEAR_POWERS`` with the least loss on it is taken.
    Without toxic rows nothing is evidence and all texts score low.
    """
    def first(label: int, rows: int) -> DataFrame:
        return labels.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    chosen = first(1, most).unionByName(first(0, 3 * most)).select("doc_id", F.col("label").cast("int"))
    chosen = materialize(chosen, "toxic-rows")
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("text").agg(F.max("label").alias("label"))
    texts = materialize(
        texts.withColumn("fits", F.pmod(F.xxhash64("text"), F.lit(4)) == 0), "toxic-texts"
    )
    lexicon = learn_lexicon(texts.where("NOT fits"))

    def measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in text_batches(batches, "text"):
            texts, labels = [t or "" for t in table["text"].to_pylist()], table["label"].to_numpy()
            texts += [lexicon.misspelled(t) for t, label in zip(texts, labels) if label == 1]
            labels = np.concatenate((labels, labels[labels == 1]))
            for power in NEAR_POWERS:
                found = replace(lexicon, power=power).measures(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(labels), float(power))), pa.array(labels, pa.int32()), pa.array(found[:, 0]), pa.array(found[:, 1])],
                    ["power", "label", "most", "all"],
                )

    fits = texts.where("fits").select("text", "label").mapInArrow(measures, "power double, label int, most double, all double")
    rows = np.array(sorted(tuple(r) for r in fits.collect())).reshape(-1, 4)
    least = np.inf
    for power in NEAR_POWERS:
        own = rows[rows[:, 0] == power]
        weights, bias = fit_weights(own[:, 2:], own[:, 1])
        if (loss := balanced_loss(own[:, 2:], own[:, 1], weights, bias)) < least:
            least = loss
            lexicon.power, lexicon.weights, lexicon.bias = power, weights, bias
    return lexicon


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learned from the labels outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 3) != 1)
    lexicon = fit(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    return score(docs, lexicon).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


QUERIES = {"op10_toxicity": op10_toxicity}
