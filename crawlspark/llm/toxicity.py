"""Toxicity scores from misspelling-tolerant lexicon matches and their context.

A lexicon of terms is learned from labelled documents and kept as a trie. Words
are matched by intersecting that trie with Levenshtein automata: a state is the
set of (trie node, errors so far) pairs that a word's letters have reached, so a
word is followed once through the lexicon, whatever its spelling mistakes. The
deterministic states are built the first time they are needed and then reused.
Each match is weighed by the words around it, which separates a quoted term from
one that is meant, and a logistic model turns the matches of a document into a
score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage
from crawlspark.llm.common import uniform

TOKEN = re.compile(r"[^\W\d_]+|[\"“”„«»‹›]")
QUOTES = frozenset("\"“”„«»‹›")
#: Letters a term needs before one or two edits are allowed.
ONE_EDIT, TWO_EDITS = 5, 11
#: States kept by one task; the cache starts anew beyond that.
MOST_STATES = 50_000
FEATURES = 8


def edits_allowed(term: str) -> int:
    return 2 if len(term) >= TWO_EDITS else 1 if len(term) >= ONE_EDIT else 0


class LexiconAutomaton:
    """Levenshtein automata of all terms at once, run over the lexicon's trie."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.allowance: list[int] = [0]  # edits that some term below the node allows
        for term in terms:
            node, edits = 0, edits_allowed(term)
            self.allowance[0] = max(self.allowance[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.allowance.append(0)
                node = self.children[node][letter]
                self.allowance[node] = max(self.allowance[node], edits)
            self.ends[node] = term
        self._forget()

    def _forget(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.members: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.start = self._state({0: 0})

    def _close(self, reached: dict[int, int]) -> dict[int, int]:
        """With the nodes that leaving out letters of a term leads to."""
        waiting = list(reached.items())
        while waiting:
            node, errors = waiting.pop()
            if errors > reached[node]:
                continue
            for child in self.children[node].values():
                if errors + 1 <= self.allowance[child] and errors + 1 < reached.get(child, 9):
                    reached[child] = errors + 1
                    waiting.append((child, errors + 1))
        return reached

    def _state(self, reached: dict[int, int]) -> int:
        closed = self._close(reached)
        key = frozenset(closed.items())
        if key not in self.states:
            self.states[key] = len(self.members)
            self.members.append(closed)
            self.moves.append({})
            matched = [(e, self.ends[n]) for n, e in closed.items() if self.ends[n] and e <= edits_allowed(self.ends[n])]
            self.found.append(min(matched)[::-1] if matched else None)
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def add(node: int, errors: int) -> None:
            if errors <= self.allowance[node] and errors < reached.get(node, 9):
                reached[node] = errors

        for node, errors in self.members[state].items():
            add(node, errors + 1)  # a letter too many
            for other, child in self.children[node].items():
                add(child, errors + (other != letter))
        return self._state(reached) if reached else -1

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its allowance and the edits it takes; ties by name."""
        if len(self.members) > MOST_STATES:
            self._forget()
        state = self.start
        for letter in word:
            moves = self.moves[state]
            target = moves.get(letter)
            if target is None:
                target = moves[letter] = self._step(state, letter)
            if target < 0:
                return None
            state = target
        return self.found[state]


@dataclass
class ToxicityModel:
    """Bounded by the parameters of ``fit``: terms, context words and eight weights.

    ``weights`` are log odds of a term as it is, ``misspelled`` those of words
    that were taken for it.
    """

    weights: dict[str, float] = field(default_factory=dict)
    misspelled: dict[str, float] = field(default_factory=dict)
    context: dict[str, float] = field(default_factory=dict)
    reach: int = 6
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    scale: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))


class Matcher:
    """Finds the matches of a text; one per task, as it remembers words."""

    MOST_WORDS = 200_000

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.automaton = LexiconAutomaton(sorted(model.weights))
        self.words: dict[str, tuple[str, int] | None] = {}

    def look(self, word: str) -> tuple[str, int] | None:
        try:
            return self.words[word]
        except KeyError:
            if len(self.words) >= self.MOST_WORDS:
                self.words.clear()
            found = self.words[word] = self.automaton.match(word)
            return found

    def hits(self, text: str) -> tuple[list[str], list[tuple[int, str, int]]]:
        """Tokens of the text, and (position, term, edits) of its matches."""
        tokens = TOKEN.findall(text.lower())
        look = self.look
        found = [(i, m) for i, m in enumerate(map(look, tokens)) if m]
        return tokens, [(i, m[0], m[1]) for i, m in found]

    def window(self, tokens: list[str], at: int) -> tuple[list[str], bool]:
        """Words around a match, and whether quotation marks stand on both sides."""
        before, after = tokens[max(0, at - self.model.reach) : at], tokens[at + 1 : at + 1 + self.model.reach]
        quoted = bool(QUOTES.intersection(before)) and bool(QUOTES.intersection(after))
        return before + after, quoted

    def features(self, text: str) -> list[float]:
        """Numbers about a document's distinct matched words, and its length."""
        tokens, hits = self.hits(text)
        if not hits:
            return [0.0] * (FEATURES - 1) + [math.log1p(len(tokens))]
        exact: dict[str, float] = {}
        fuzzy: dict[str, float] = {}
        best_meant, context_sum, quoted_hits = 0.0, 0.0, 0
        for at, term, edits in hits:
            words, quoted = self.window(tokens, at)
            weight = self.model.weights[term] if not edits else self.model.misspelled.get(term, 0.0)
            (fuzzy if edits else exact)[tokens[at]] = weight
            context_sum += sum(self.model.context.get(w, 0.0) for w in words) / math.sqrt(1 + len(words))
            quoted_hits += quoted
            best_meant = max(best_meant, 0.0 if quoted else weight)
        return [
            best_meant,
            math.log1p(sum(exact.values())),
            math.log1p(sum(fuzzy.values())),
            math.log1p(len(exact)),
            math.log1p(len(fuzzy)),
            context_sum / len(hits),
            quoted_hits / len(hits),
            math.log1p(len(tokens)),
        ]


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights (intercept first) of a ridge-penalised logistic model, by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * penalty
    ridge[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _counts(totals: DataFrame) -> tuple[DataFrame, int, int]:
    """Documents by word and class, and the sizes of both classes (the counts of the empty word)."""
    summed = totals.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    written = cut_lineage(summed, "toxicity-words")
    sizes = written.where("word = ''").collect()
    return written, *((sizes[0]["clean"], sizes[0]["toxic"]) if sizes else (0, 0))


def _counted(train: DataFrame, words_of: Callable[[], Callable[[str], Iterable[str]]]) -> DataFrame:
    """Per word the clean and toxic documents it is in, before the sum over tasks."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = words_of()
        for frame in frames:
            counts = {0: Counter(), 1: Counter()}
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                counts[toxic].update({"", *words(text)})
            yield pd.DataFrame(
                [(w, counts[0][w], counts[1][w]) for w in counts[0].keys() | counts[1].keys()],
                columns=["word", "clean", "toxic"],
            )

    return train.select("text", "toxic").mapInPandas(count, "word string, clean long, toxic long")


def _surprise(chance: float) -> float:
    """What a G statistic of one degree of freedom exceeds with about this chance."""
    twice = max(1.0, -2 * math.log(min(0.5, chance)))
    return max(3.0, twice - math.log(twice))


def _lexicon(
    train: DataFrame, terms: int, least_docs: int, by_chance: float, context_words: int
) -> ToxicityModel | None:
    """Terms, what their misspelled forms say, and context words; None without both classes."""
    totals, n_clean, n_toxic = _counts(_counted(train, lambda: lambda text: TOKEN.findall(text.lower())))
    if not n_clean or not n_toxic:
        return None
    share = n_toxic / (n_toxic + n_clean)
    clean, toxic = F.col("clean"), F.col("toxic")
    odds = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
    # The G statistic against equal shares in both classes.
    surprise = 2 * toxic * F.log(toxic / ((toxic + clean) * share)) + F.when(
        clean > 0, 2 * clean * F.log(clean / ((toxic + clean) * (1 - share)))
    ).otherwise(0.0)
    candidates = totals.where((toxic >= least_docs) & (F.length("word") > 2))
    chosen = (
        candidates.select("word", odds.alias("odds"), surprise.alias("surprise"))
        .where((F.col("odds") > math.log(6)) & (F.col("surprise") > _surprise(by_chance / max(1, candidates.count()))))
        .orderBy(F.desc("surprise"), "word")
        .limit(terms)
        .collect()
    )
    model = ToxicityModel(weights={r["word"]: float(r["odds"]) for r in chosen})
    shared = train.sparkSession.sparkContext.broadcast(model)

    def around() -> Callable[[str], Iterable[str]]:
        matcher = Matcher(shared.value)

        def words(text: str) -> Iterator[str]:
            tokens, hits = matcher.hits(text)
            for at, term, edits in hits:
                yield from ("=" + w for w in matcher.window(tokens, at)[0])
                yield "="
                if edits:
                    yield "~" + term

        return words

    windows, _, _ = _counts(_counted(train, around))
    kept = windows.orderBy(~F.col("word").startswith("~"), F.desc(clean + toxic), "word")
    found = {r["word"]: (r["clean"], r["toxic"]) for r in kept.limit(terms + context_words + 2).collect()}
    model.misspelled = {
        w[1:]: max(
            0.0,
            math.log((t + 2 * share) / (n_toxic + 1)) - math.log((c + 2 * (1 - share)) / (n_clean + 1)),
        )
        for w, (c, t) in found.items()
        if w.startswith("~")
    }
    w_clean, w_toxic = found.get("=", (0, 0))
    model.context = {
        w[1:]: math.log((t + 1) / (w_toxic + 2)) - math.log((c + 1) / (w_clean + 2))
        for w, (c, t) in found.items()
        if w.startswith("=") and len(w) > 1
    }
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train_docs: int = 30_000,
    terms: int = 600,
    least_docs: int = 3,
    by_chance: float = 1.0,
    context_words: int = 2_000,
) -> ToxicityModel:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    About ``train_docs`` labelled documents are used, taken by a hash of their
    id; all if there are fewer. They give the lexicon (words in ``least_docs``
    toxic documents that are far more frequent there, so clearly by the G
    statistic that ``by_chance`` words would be by chance), what misspelled forms of its terms say, and
    the context words. The final weights are fitted to matches with the lexicon
    of the other half of these documents, and so see terms as new documents show
    them. Rows with a NULL id, text or label teach nothing; of several labels of
    an id the higher one counts. Without both classes the model says what the
    one class there is says, and not toxic where there is none.
    """
    spark = docs.sparkSession
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, train_docs / max(1, marked.count()))
    sample = marked.where(uniform("doc_id", seed=7) < share)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    # The sample is bounded by train_docs, so its ids and labels may go to every task.
    train = cut_lineage(texts.join(F.broadcast(sample), "doc_id"), "toxicity-sample")
    options = (terms, least_docs, by_chance, context_words)
    model = _lexicon(train, *options)
    if model is None:
        only_toxic = train.where("toxic = 1").limit(1).count() > 0
        model = ToxicityModel()
        model.coefficients[0] = 30.0 if only_toxic else -30.0
        return model
    in_first = uniform("doc_id", seed=11) < 0.5
    rows = []
    for mine, other in ((in_first, ~in_first), (~in_first, in_first)):
        shared = spark.sparkContext.broadcast(_lexicon(train.where(other), *options) or ToxicityModel())

        def featured(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            matcher = Matcher(shared.value)
            for frame in frames:
                features = [matcher.features(t) for t in frame["text"]]
                yield pd.DataFrame({"features": features, "toxic": frame["toxic"].to_numpy()})

        half = train.where(mine).select("text", "toxic")
        rows.append(half.mapInPandas(featured, "features array<double>, toxic int").toPandas())
    sample = pd.concat(rows)
    x, y = np.array(sample["features"].tolist()), sample["toxic"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # the sums below then don't depend on the order of arrival
    x, y = x[order], y[order]
    model.mean, model.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    model.coefficients = _logistic((x - model.mean) / model.scale, y)
    return model


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); columns of these names are replaced.

    Whole texts are read. A NULL or empty text has no match and gets the score
    of such texts. Equal texts get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value)
        fitted = shared.value
        for batch in batches:
            rows = [matcher.features(t if isinstance(t, str) else "") for t in batch]
            x = (np.array(rows).reshape(-1, FEATURES) - fitted.mean) / fitted.scale
            z = fitted.coefficients[0] + x @ fitted.coefficients[1:]
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    rated = F.pandas_udf(rate, "double")
    return docs.withColumn("score", rated(F.col(text))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
