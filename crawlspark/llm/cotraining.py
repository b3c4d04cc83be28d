"""Quality scores by co-training a text view and a page-metadata view.

Two naive Bayes classifiers see different sides of a document: the byte
trigrams of its text, and its metadata (language, source, size and layout). In
each round both are fitted to the labelled documents and to those that the other
one is sure about; how sure it is comes from a calibration on labelled documents
that no classifier was fitted to. At the end a logistic model of both calibrated
views scores all documents.

The features of all documents are written once, in a compact form. A round is a
pass over that table: the tasks apply the last models, count features by class,
and the counts are summed. Models and calibrations have a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage
from crawlspark.llm.common import chunks_of, uniform

TEXT_BITS = 16
#: Metadata: so many slots of 256 values each.
SLOTS = 12
META_SIZE = SLOTS * 256
BLOCK = 1 << 20
#: Steps into which log odds are sorted for a calibration, from -LIMIT to LIMIT.
BINS, LIMIT = 41, 20.0
#: Share of the labelled documents that the calibration is fitted to.
CALIBRATION = 0.3

LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def text_features(texts: list[str]) -> list[np.ndarray]:
    """Hashed distinct byte trigrams of each text, A-Z lower-cased; none of a text under three bytes."""
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    out: list[np.ndarray] = []
    for start, stop in chunks_of([len(r) for r in raw], BLOCK):
        for r in raw[start:stop]:
            d = np.frombuffer(r, dtype=np.uint8).astype(np.uint32)
            present = np.zeros(1 << TEXT_BITS, dtype=bool)
            for s in range(0, max(0, len(d) - 2), BLOCK):
                part = d[s : s + BLOCK + 2]
                packed = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
                present[(packed * np.uint32(0x9E3779B1)) >> np.uint32(32 - TEXT_BITS)] = True
            out.append(np.flatnonzero(present).astype("<u2"))
    return out


def _step(value: float, scale: float) -> int:
    return int(min(255, max(0, round(value * scale))))


def meta_features(text: str, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """One value per slot: names are hashed, sizes and shares go in steps."""

    def name(value: str | None) -> int:
        if value is None:
            return 0
        return 1 + sum(b * (i + 7) for i, b in enumerate(value.encode("utf-8", "surrogatepass"))) % 255

    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    lines = text.split("\n")
    words = text.split()
    n = max(1, len(data))
    letters = int(LETTERS[data].sum())
    upper = int(((data >= 65) & (data <= 90)).sum())
    digits = int(((data >= 48) & (data <= 57)).sum())
    space = int((data <= 32).sum())
    values = [
        name(lang),
        name(source),
        _step(np.log2(1 + (n_chars or 0)), 2),
        _step(np.log2(1 + len(lines)), 2),
        _step(np.log2(1 + len(words) / max(1, len(lines))), 2),
        _step(letters / n, 40),
        _step(upper / n, 40),
        _step(digits / n, 60),
        _step(max(0, n - letters - digits - space) / n, 60),
        _step(len(set(lines)) / max(1, len(lines)), 20),
        _step(len(set(words)) / max(1, len(words)), 20),
        _step(n / max(1, len(words)), 2),
    ]
    return (np.array(values) + 256 * np.arange(SLOTS)).astype("<u2")


@dataclass
class View:
    """Log odds of the features of one view, and the line that calibrates their sum."""

    odds: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, features: list[bytes]) -> np.ndarray:
        """Mean log odds of each document's features that say anything; 0 for a document without any."""
        lengths = np.array([len(f) // 2 for f in features])
        flat = np.frombuffer(b"".join(features), dtype="<u2")
        owner = np.repeat(np.arange(len(features)), lengths)
        odds = self.odds[flat]
        told = np.bincount(owner, weights=odds != 0, minlength=len(features))
        total = np.bincount(owner, weights=odds, minlength=len(features))
        return 10 * total / np.sqrt(1 + told) / 3

    def logit(self, features: list[bytes]) -> np.ndarray:
        return self.slope * np.clip(self.raw(features), -LIMIT, LIMIT) + self.shift


@dataclass
class CoTrained:
    """Both views and the weights that combine them; of a fixed size."""

    text: View
    meta: View
    weights: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.5, 0.5]))

    def logits(self, frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.text.logit(list(frame["text_f"])), self.meta.logit(list(frame["meta_f"]))
        return a, b, self.weights[0] + self.weights[1] * a + self.weights[2] * b


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights (intercept first) of a ridge-penalised logistic model; row i counts n[i] times."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [penalty] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (n * (y - p)) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def featured(docs: DataFrame, labels: DataFrame, train_docs: int = 30_000) -> DataFrame:
    """Written table of doc_id, both views' features, label (NULL if there is none) and part.

    About ``train_docs`` labels are used, by a hash of the id, all if there are
    fewer; other documents count as unlabelled. ``part`` is ``fit`` or
    ``calibrate`` for a labelled document. Of several labels of an id the higher
    one counts.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(1, 5)]
            texts = [t or "" for t in columns[0]]
            meta = [meta_features(*row).tobytes() for row in zip(texts, *columns[1:], strict=True)]
            text = [f.tobytes() for f in text_features(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(text, pa.binary()), pa.array(meta, pa.binary())],
                names=["doc_id", "text_f", "meta_f"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars")
    described = rows.mapInArrow(describe, f"doc_id {kind}, text_f binary, meta_f binary")
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label"))
        .withColumn("part", F.when(uniform("doc_id", seed=23) < CALIBRATION, "calibrate").otherwise("fit"))
    )
    share = min(1.0, train_docs / max(1, marked.count()))
    # Bounded by train_docs, so the labels may go to every task, and no features are shuffled.
    sample = F.broadcast(marked.where(uniform("doc_id", seed=29) < share))
    return cut_lineage(described.join(sample, "doc_id", "left"), "quality-features")


def _fitted(rows: DataFrame, last: CoTrained | None, confidence: float, pseudo_weight: float) -> CoTrained:
    """Both views from the labelled rows and from what the other view was sure about."""
    shared = rows.sparkSession.sparkContext.broadcast(last)
    sure = float(np.log(confidence / (1 - confidence)))
    sizes = {"text": 1 << TEXT_BITS, "meta": META_SIZE}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        sums = {view: np.zeros((2, size + 1)) for view, size in sizes.items()}
        for frame in frames:
            label = frame["label"].to_numpy(dtype=float, na_value=np.nan)
            weight = np.where(np.isnan(label), pseudo_weight, 1.0)
            teachers = {"text": label, "meta": label}
            if model is not None:
                a, b, _ = model.logits(frame)
                for view, other in (("text", b), ("meta", a)):
                    pseudo = np.where(np.abs(other) >= sure, other > 0, np.nan)
                    teachers[view] = np.where(np.isnan(label), pseudo, label)
            for view, teacher in teachers.items():
                features = [np.frombuffer(f, dtype="<u2") for f in frame[f"{view}_f"]]
                for kind in (0, 1):
                    chosen = np.flatnonzero(teacher == kind)
                    if not len(chosen):
                        continue
                    flat = np.concatenate([features[i] for i in chosen])
                    each = np.repeat(weight[chosen], [len(features[i]) for i in chosen])
                    sums[view][kind, :-1] += np.bincount(flat, weights=each, minlength=sizes[view])
                    sums[view][kind, -1] += weight[chosen].sum()
        for view, total in sums.items():
            used = np.flatnonzero(total.sum(axis=0))
            yield pd.DataFrame({"view": view, "feature": used, "bad": total[0, used], "good": total[1, used]})

    counted = (
        rows.where("part is null or part = 'fit'")
        .select("text_f", "meta_f", "label")
        .mapInPandas(count, "view string, feature long, bad double, good double")
        .groupBy("view", "feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .toPandas()
    )
    views = {}
    for view, size in sizes.items():
        part = counted[counted["view"] == view]
        bad, good = np.zeros(size + 1), np.zeros(size + 1)
        bad[part["feature"]], good[part["feature"]] = part["bad"], part["good"]
        n_bad, n_good = bad[-1], good[-1]
        odds = np.zeros(size)
        if n_bad and n_good:
            b, g = bad[:-1], good[:-1]
            odds = np.log((g + 0.5) / (n_good + 1)) - np.log((b + 0.5) / (n_bad + 1))
            share = n_bad / (n_bad + n_good)
            n = np.maximum(b + g, 1e-9)
            # Features whose shares differ no more than by chance say nothing.
            surprise = (b - n * share) ** 2 / (n * share * (1 - share))
            odds[surprise < 12] = 0.0
        views[view] = View(odds)
    model = CoTrained(views["text"], views["meta"])
    return _calibrated(rows, model)


def _calibrated(rows: DataFrame, model: CoTrained) -> CoTrained:
    """Lines for both views and their combination, from counts of labelled rows by steps of log odds."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    width = 2 * LIMIT / (BINS - 1)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            a, b, _ = shared.value.logits(frame)
            steps = [np.clip(np.rint((x + LIMIT) / width), 0, BINS - 1).astype(int) for x in (a, b)]
            found = pd.DataFrame({"a": steps[0], "b": steps[1], "label": frame["label"].to_numpy(dtype=int)})
            yield found.groupby(["a", "b", "label"]).size().reset_index(name="n")

    counts = (
        rows.where("part = 'calibrate'")
        .select("text_f", "meta_f", "label")
        .mapInPandas(place, "a int, b int, label int, n long")
        .groupBy("a", "b", "label")
        .agg(F.sum("n").alias("n"))
        .orderBy("a", "b", "label")
        .toPandas()
    )
    if counts["label"].nunique() < 2:
        return model
    a, b = (counts[c].to_numpy() * width - LIMIT for c in ("a", "b"))
    y, n = counts["label"].to_numpy(float), counts["n"].to_numpy(float)
    model.text.shift, model.text.slope = logistic(a[:, None], y, n)
    model.meta.shift, model.meta.slope = logistic(b[:, None], y, n)
    both = np.c_[model.text.slope * a + model.text.shift, model.meta.slope * b + model.meta.shift]
    model.weights = logistic(both, y, n)
    return model


def fit(rows: DataFrame, rounds: int = 3, confidence: float = 0.98, pseudo_weight: float = 0.5) -> CoTrained:
    """Co-trained views from the table of ``featured``; all its rows take part.

    A view learns an unlabelled document, with ``pseudo_weight``, as what the
    other one takes it for with calibrated probability ``confidence``. Without
    labels of both classes every score is 0.5.
    """
    model = None
    for _ in range(rounds):
        model = _fitted(rows, model, confidence, pseudo_weight)
    return model


def score(rows: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, score (probability of good quality), predicted (1 from 0.5 on), text_score and meta_score of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text_f, meta_f in batches:
            logits = shared.value.logits(pd.DataFrame({"text_f": text_f, "meta_f": meta_f}))
            scores = [1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in logits]
            yield pd.DataFrame(dict(zip(("text_score", "meta_score", "score"), scores, strict=True)))

    rated = F.pandas_udf(rate, "text_score double, meta_score double, score double")
    return rows.select("doc_id", rated("text_f", "meta_f").alias("r")).select(
        "doc_id",
        "r.score",
        (F.col("r.score") >= 0.5).cast("int").alias("predicted"),
        "r.text_score",
        "r.meta_score",
    )
