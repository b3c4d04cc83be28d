"""Language identification with language-bitmask n-gram filters.

Each language has a Bloom filter over its frequent character 4-grams. The
filters are bit-sliced: row ``i`` of the table holds bit ``i`` of all filters as
a mask of as many 64-bit words as the languages need, so the AND of the probed
rows names every language that contains an n-gram. Per document and language the hits are counted, corrected for the
filter's false positives, and the highest corrected share decides.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.lineage import cut_lineage
from crawlspark.llm.common import chunks_of, uniform

UNDETERMINED = "und"
GRAM = 4
#: Languages of one word of a mask.
WORD = 64
#: A longer text goes in pieces of so many code points.
BLOCK = 1 << 20
#: Code points of the pieces handled at once, one piece at least; they take about a hundred bytes each.
BATCH = 1 << 17
#: Texts that are Python strings at once.
ROWS = 1000
#: N-grams of texts that are held before they are counted.
HELD = 1 << 20

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)


@dataclass(frozen=True)
class LanguageFilters:
    """The fitted table: its size depends on the parameters of ``fit`` alone."""

    languages: list[str]
    rows: np.ndarray  # by word, one mask of languages per bit position
    probes: int

    def false_positive_rates(self) -> np.ndarray:
        places = [(self.rows[i // WORD], np.uint64(i % WORD)) for i in range(len(self.languages))]
        filled = np.array([np.count_nonzero((word >> bit) & np.uint64(1)) for word, bit in places], dtype=float)
        return (filled / max(1, self.rows.shape[1])) ** self.probes


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)], dtype=bool)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All 4-grams of the texts and the index of the text of each.

    Letters are lower-cased, runs of anything else become one space, and a text
    stands between one space and three, so a text of one letter has n-grams.
    """
    letters = _letters()
    parts, owner = [], []
    edge = np.array([32], dtype=np.uint32)
    tail = np.array([32, 32, 32], dtype=np.uint32)
    for i, text in enumerate(texts):
        points = _code_points(text.lower())
        is_letter = letters[points]
        before = np.empty_like(is_letter)
        before[:1] = False
        before[1:] = is_letter[:-1]
        kept = np.where(is_letter, points, 32)[is_letter | before]
        if not is_letter.any():
            continue
        if kept[-1] == 32:
            kept = kept[:-1]
        parts += [edge, kept.astype(np.uint32), tail]
        owner.append((i, len(kept) + 4))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    points = np.concatenate(parts).astype(np.uint64) & np.uint64(0xFFFF)
    owners = np.repeat([i for i, _ in owner], [n for _, n in owner])
    grams = (points[:-3] << np.uint64(48)) | (points[1:-2] << np.uint64(32)) | (points[2:-1] << np.uint64(16)) | points[3:]
    inside = owners[:-3] == owners[3:]
    return grams[inside], owners[:-3][inside]


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """The texts in batches of bounded size, with the index of the text of each piece."""
    indices, pieces = [], []
    for i, text in enumerate(texts):
        for start in range(0, len(text), BLOCK):
            indices.append(i)
            pieces.append(text[start : start + BLOCK])
    for start, stop in chunks_of([len(p) for p in pieces], BATCH):
        yield indices[start:stop], pieces[start:stop]


def _gram_counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams and the number of pieces they are in, for some of the texts after the other."""
    seen, held = [], 0
    for _, pieces in _pieces(texts):
        grams, owners = _grams(pieces)
        if not len(grams):
            continue
        order = np.lexsort((grams, owners))
        g, o = grams[order], owners[order]
        first = np.ones(len(g), dtype=bool)
        first[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
        seen.append(g[first])
        held += len(seen[-1])
        if held >= HELD:
            yield np.unique(np.concatenate(seen), return_counts=True)
            seen, held = [], 0
    if seen:
        yield np.unique(np.concatenate(seen), return_counts=True)


def _positions(grams: np.ndarray, probe: int, size: int) -> np.ndarray:
    shift = np.uint64(64 - (size.bit_length() - 1))
    return (((grams ^ (grams >> np.uint64(29))) * _MULTIPLIERS[probe]) >> shift).astype(np.int64)


def fit(
    docs: DataFrame,
    train_docs: int = 2000,
    grams_per_language: int = 1 << 16,
    min_share: float = 0.002,
    bits: int = 1 << 20,
    probes: int = 3,
) -> LanguageFilters:
    """Filters from the columns ``text`` and ``lang`` of labelled rows.

    About ``train_docs`` documents of each language are taken, by a hash of the
    text (all of a language that has fewer). An n-gram enters a filter if it is
    in a share ``min_share`` of them and in two at least; the
    ``grams_per_language`` most frequent ones do. Rows with a NULL text or
    language teach nothing. All languages are learned; without any labelled row
    there are none.
    """
    spark = docs.sparkSession
    labelled = docs.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    languages = [r["lang"] for r in sizes]
    if not languages:
        return LanguageFilters([], np.zeros((1, bits), np.uint64), probes)
    number = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, i)])
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, train_docs / r["count"]))])
    # The share is looked up before the hash: most rows end there without their text being read twice.
    sample = labelled.where(uniform("text", seed=3) < F.coalesce(share[F.col("lang")], F.lit(0.0))).select(
        "text", number[F.col("lang")].alias("number")
    )

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for language, group in frame.groupby("number"):
                for values, n in _gram_counts(list(group["text"])):
                    yield pd.DataFrame({"number": language, "gram": values.view(np.int64), "n": n, "docs": 0})
                yield pd.DataFrame({"number": [language], "gram": [0], "n": [0], "docs": [len(group)]})

    counted = sample.mapInPandas(count, "number int, gram long, n long, docs long")
    totals = counted.groupBy("number", "gram").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = np.zeros((-(-len(languages) // WORD), bits), dtype=np.uint64)
    totals = cut_lineage(totals, "language-grams")
    trained = {r["number"]: r["docs"] for r in totals.where("gram = 0").select("number", "docs").collect()}
    least = [1.0 if trained.get(i, 0) == 1 else max(2.0, min_share * trained.get(i, 0)) for i in range(len(languages))]
    frequent = Window.partitionBy("number").orderBy(F.desc("n"), "gram")
    for word in range(len(rows)):
        # The driver holds the n-grams of one word's languages at a time.
        own = range(word * WORD, min((word + 1) * WORD, len(languages)))
        needed = F.create_map(*[F.lit(x) for i in own for x in (i, least[i])])
        kept = (
            totals.where(F.col("number").between(own.start, own.stop - 1) & (F.col("gram") != 0))
            .where(F.col("n") >= needed[F.col("number")])
            .withColumn("place", F.row_number().over(frequent))
            .where(F.col("place") <= grams_per_language)
            .select("number", "gram")
            .toPandas()
        )
        for i, grams in kept.groupby("number")["gram"]:
            for probe in range(probes):
                rows[word, _positions(grams.to_numpy(np.int64).view(np.uint64), probe, bits)] |= np.uint64(1 << int(i) % WORD)
    return LanguageFilters(languages, rows, probes)


def _shares(model: LanguageFilters, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Corrected share of n-grams in each language, and the number of n-grams, per text."""
    hits = np.zeros((len(texts), len(model.languages)))
    total = np.zeros(len(texts), dtype=np.int64)
    narrow = model.rows.astype(np.uint8) if len(model.languages) <= 8 else model.rows
    size = model.rows.shape[1]
    for indices, pieces in _pieces(texts):
        grams, owners = _grams(pieces)
        if not len(grams):
            continue
        starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
        documents = np.asarray(indices)[owners[starts]]
        lengths = np.diff(np.r_[starts, len(owners)])
        np.add.at(total, documents, lengths)
        positions = [_positions(grams, probe, size) for probe in range(model.probes)]
        for word, masks in enumerate(narrow):
            found = masks[positions[0]]
            for probed in positions[1:]:
                found &= masks[probed]
            for i in range(word * WORD, min((word + 1) * WORD, len(model.languages))):
                bit = (found >> narrow.dtype.type(i % WORD)) & narrow.dtype.type(1)
                np.add.at(hits[:, i], documents, np.add.reduceat(bit, starts, dtype=np.int64))
    rates = model.false_positive_rates()
    n = total[:, None]
    corrected = np.maximum(0.0, (hits - rates * n) / np.maximum(1e-9, 1 - rates))
    return np.minimum(1.0, corrected / np.maximum(1, n)), total


def _decided(model: LanguageFilters, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    if not model.languages:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    shares, total = _shares(model, texts)
    best = shares.argmax(axis=1)
    names = np.array(model.languages, dtype=object)[best]
    # Marks take part in n-grams, but only a letter makes a language.
    unknown = (total == 0) | ~np.array([any(map(str.isalpha, t)) for t in texts], dtype=bool)
    names[unknown] = UNDETERMINED
    return names.tolist(), np.where(unknown, 0.0, shares[np.arange(len(texts)), best]).tolist()


def predict(docs: DataFrame, model: LanguageFilters, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    ``score`` is the corrected share of the whole text's n-grams that the chosen
    language contains. A NULL text, or one without a letter, gets ``und`` and 0;
    a text whose n-grams no language contains gets the most frequent language
    and 0; a tie goes to the more frequent language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for batch in batches:
            names, scores = [], []
            for start in range(0, len(batch), ROWS):
                found, score = _decided(fitted, [t or "" for t in batch[start : start + ROWS].to_pylist()])
                names += found
                scores += score
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"]
            )

    decided = F.arrow_udf(decide, "lang_pred string, score double")
    answer = "_language"
    return (
        docs.withColumn(answer, decided(F.col(text)))
        .withColumns({"lang_pred": F.col(f"{answer}.lang_pred"), "score": F.col(f"{answer}.score")})
        .drop(answer)
    )
