"""Language identification by interpolated Kneser-Ney character models.

A text is reduced to its letters in lower case with single gaps between words. For each
language a bounded sample of labelled documents gives counts of four-character sequences,
and from them the Kneser-Ney probabilities of all orders. The tables of all languages
share their keys: sorted arrays of 64-bit hashes, one for each order, with a row of log
probabilities, one for each language. A text gets the language whose model gives the
lowest cross-entropy per character; held-back sample documents calibrate the score and
the cross-entropy beyond which a text counts as none of the languages.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.arrow import chunks, ship_package
from isobar.llm.words import mixed, odd_numbers
from isobar.storage import materialise

ORDER = 4
#: Expected sample documents of a language; a fifth of them calibrate.
PER_LANGUAGE = 2000
#: A language with fewer documents than this teaches with all of them and is not calibrated.
FEW = 25
#: Most frequent sequences kept of a language.
SEQUENCES = 60_000
#: Share of a language's own texts whose cross-entropy may be called too high.
REJECTED = 0.001
UNKNOWN = "und"

_GAP = 0x20
_FACTORS = odd_numbers(ORDER, 9)


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its folded form (a gap if it is no letter or mark), and whether it is a letter."""
    folded = np.full(sys.maxunicode + 1, _GAP, dtype=np.uint32)
    letter = np.zeros(sys.maxunicode + 1, dtype=bool)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LM":
            low = chr(code).lower()
            folded[code] = ord(low[0])
            letter[code] = kind == "L"
    return folded, letter


def reduce_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all reduced texts, each begun by gaps as context; where they start; if any is a letter."""
    folded, letter = _letters()
    values = pc.fill_null(texts, "").to_pylist()
    sizes = np.array([len(v) for v in values], dtype=np.int64)
    codes = np.frombuffer("".join(values).encode("utf-32-le", "replace"), dtype=np.uint32)
    ends = np.cumsum(sizes)
    seen = np.concatenate([[0], np.cumsum(letter[codes], dtype=np.int64)])
    has_letter = seen[ends] > seen[ends - sizes]
    chars = folded[codes]
    keep = np.ones(len(chars), dtype=bool)
    gap = chars == _GAP
    keep[1:] = ~(gap[1:] & gap[:-1])
    begins = (ends - sizes)[sizes > 0]
    keep[begins] = ~gap[begins]
    kept = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
    firsts = kept[np.concatenate([[0], ends])]
    return chars[keep], firsts, has_letter


def _contexts(chars: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The character at each place and the ORDER - 1 before it, as columns from the oldest."""
    out = np.full((len(chars), ORDER), _GAP, dtype=np.uint32)
    since = np.arange(len(chars)) - np.repeat(firsts[:-1], np.diff(firsts))
    for back in range(ORDER):
        column = out[:, ORDER - 1 - back]
        if back:
            column[back:] = chars[:-back]
            column[since < back] = _GAP
        else:
            column[:] = chars
    return out


def _hashes(grams: np.ndarray) -> np.ndarray:
    """A hash per row; rows of different widths are hashed apart."""
    width = grams.shape[1]
    total = np.full(len(grams), width, dtype=np.uint64)
    for i in range(width):
        total += (grams[:, i].astype(np.uint64) + np.uint64(1)) * _FACTORS[i]
    return mixed(total)


@dataclass(frozen=True)
class HashTable:
    """Sorted hashes with a row of values each; ``index`` is where each leading-bit group starts."""

    keys: np.ndarray
    values: np.ndarray
    index: np.ndarray
    shift: int

    @staticmethod
    def of(hashes: np.ndarray, values: np.ndarray) -> HashTable:
        order = np.argsort(hashes)
        keys = np.append(hashes[order], np.uint64(np.iinfo(np.uint64).max))
        bits = max(4, int(len(keys)).bit_length() + 2)
        index = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        return HashTable(keys, values[order], index.astype(np.int32), 64 - bits)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, or -1."""
        last = len(self.keys) - 1
        places = self.index[(hashes >> np.uint64(self.shift)).astype(np.int64)]
        places = np.minimum(places, last)
        behind = np.flatnonzero(self.keys[places] < hashes)
        while len(behind):
            places[behind] += 1
            behind = behind[self.keys[places[behind]] < hashes[behind]]
        found = (self.keys[places] == hashes) & (places < last)
        return np.where(found, places, -1)


@dataclass(frozen=True)
class Models:
    """All languages: log probabilities by order, and the weights of falling back from a context."""

    languages: list[str]
    seen: list[HashTable]  # of orders 1 to ORDER
    fall: list[HashTable]  # of contexts of 1 to ORDER - 1 characters
    floor: np.ndarray
    sharpness: float = 10.0
    highest: np.ndarray | None = None

    def log_probabilities(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """A row per gram, a column per language."""
        if order == 0:
            return np.repeat(self.floor[None, :], len(grams), axis=0)
        own = grams[:, -order:]
        table = self.seen[order - 1]
        rows = table.find(_hashes(own))
        out = table.values[np.maximum(rows, 0)] if len(table.values) else np.zeros((len(grams), len(self.floor)), np.float32)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            lower = self.log_probabilities(grams[missing], order - 1)
            if order > 1:
                contexts = self.fall[order - 2]
                at = contexts.find(_hashes(own[missing, :-1]))
                known = at >= 0
                lower[known] += contexts.values[at[known]]
            out[missing] = lower
        return out

    def cross_entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats per character for each text and language, characters, and if there is a letter."""
        chars, firsts, has_letter = reduce_texts(texts)
        sizes = np.diff(firsts)
        logs = self.log_probabilities(_contexts(chars, firsts))
        totals = np.zeros((len(sizes), len(self.languages)))
        full = np.flatnonzero(sizes > 0)
        if len(full):
            totals[full] = np.add.reduceat(logs, firsts[:-1][full], axis=0, dtype=np.float64)
        return -totals / np.maximum(sizes, 1)[:, None], sizes, has_letter

    def scores(self, entropies: np.ndarray) -> np.ndarray:
        low = entropies.min(axis=1, keepdims=True)
        weights = np.exp(-self.sharpness * (entropies - low))
        return weights / weights.sum(axis=1, keepdims=True)


def _by_context(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes with the sum and number of their rows, and each row's place among them."""
    distinct, place = np.unique(hashes, return_inverse=True)
    return distinct, np.bincount(place, weights=counts), place


def _kneser_ney(counts: list[tuple[np.ndarray, np.ndarray]], everywhere: list[np.ndarray]) -> tuple[list, list, float]:
    """One language. ``counts`` has its grams and counts for orders 1 to ORDER, the lower ones
    continuation counts; ``everywhere`` the grams of any language. Returns, by order, the log
    probabilities of these grams, and the contexts with their log fall-back weights."""
    letters = max(2, len(everywhere[0]) + 1)
    floor = -np.log(letters)
    seen, fall = [], []
    lower = np.full(len(everywhere[0]), np.exp(floor))
    for order, ((grams, number), wanted) in enumerate(zip(counts, everywhere, strict=True), start=1):
        ones, twos = (number == 1).sum(), (number == 2).sum()
        discount = float(np.clip(ones / max(1, ones + 2 * twos), 0.1, 0.9))
        contexts = _hashes(grams[:, :-1]) if order > 1 else np.zeros(len(grams), dtype=np.uint64)
        distinct, totals, place = _by_context(contexts, number)
        kinds = np.bincount(place, minlength=len(distinct))
        weight = discount * kinds / np.maximum(totals, 1)
        direct = dict(zip(_hashes(grams).tolist(), ((number - discount) / totals[place]).tolist(), strict=True))
        wanted_contexts = _hashes(wanted[:, :-1]) if order > 1 else np.zeros(len(wanted), dtype=np.uint64)
        at = np.minimum(np.searchsorted(distinct, wanted_contexts), max(0, len(distinct) - 1))
        known = (distinct[at] == wanted_contexts) if len(distinct) else np.zeros(len(wanted), dtype=bool)
        if order > 1:
            previous = {h: i for i, h in enumerate(_hashes(everywhere[order - 2]).tolist())}
            below = lower[[previous[h] for h in _hashes(wanted[:, 1:]).tolist()]]
            fall.append((distinct, np.log(np.maximum(weight, 1e-12))))
        else:
            below = np.full(len(wanted), np.exp(floor))
        own = np.array([direct.get(h, 0.0) for h in _hashes(wanted).tolist()])
        lower = own + np.where(known, weight[at] if len(weight) else 1.0, 1.0) * below
        seen.append(np.log(lower))
    return seen, fall, floor


def _continuations(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grams without their first character, and in how many of the rows each is."""
    return np.unique(grams[:, 1:], axis=0, return_counts=True)


def build_models(rows: list[tuple[str, int, int, int, int, int]]) -> Models:
    """From (language, four characters, count) of every kept sequence."""
    languages = sorted({row[0] for row in rows})
    by_language = {}
    for language in languages:
        own = np.array([row[1:] for row in rows if row[0] == language], dtype=np.int64)
        grams, number = own[:, :ORDER].astype(np.uint32), own[:, ORDER].astype(np.float64)
        levels = [(grams, number)]
        while levels[0][0].shape[1] > 1:
            shorter, kinds = _continuations(levels[0][0])
            levels.insert(0, (shorter, kinds.astype(np.float64)))
        by_language[language] = levels
    everywhere = [
        np.unique(np.concatenate([by_language[lang][order][0] for lang in languages]), axis=0)
        for order in range(ORDER)
    ]
    fitted = [_kneser_ney(by_language[language], everywhere) for language in languages]
    seen = [
        HashTable.of(_hashes(grams), np.stack([f[0][order] for f in fitted], axis=1).astype(np.float32))
        for order, grams in enumerate(everywhere)
    ]
    fall = []
    for order in range(ORDER - 1):
        keys = np.unique(np.concatenate([f[1][order][0] for f in fitted]))
        values = np.zeros((len(keys), len(languages)), dtype=np.float32)
        for column, f in enumerate(fitted):
            values[np.searchsorted(keys, f[1][order][0]), column] = f[1][order][1]
        fall.append(HashTable.of(keys, values))
    return Models(languages, seen, fall, np.array([f[2] for f in fitted], dtype=np.float32))


def _count_sequences(sample: DataFrame) -> DataFrame:
    """(lang, c0, c1, c2, c3, n) of a sample (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            chars, firsts, _ = reduce_texts(batch.column("text"))
            grams = _contexts(chars, firsts)
            names, which = np.unique(batch.column("lang").to_pylist(), return_inverse=True)
            owner = np.repeat(which, np.diff(firsts)).astype(np.uint64)
            _, first, number = np.unique(_hashes(grams) ^ mixed(owner + np.uint64(1)), return_index=True, return_counts=True)
            columns = [pa.array(grams[first, i].astype(np.int32)) for i in range(ORDER)]
            lang = pa.array(names[owner[first].astype(np.int64)].tolist(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [lang, *columns, pa.array(number, pa.int64())], ["lang", "c0", "c1", "c2", "c3", "n"]
            )

    return sample.mapInArrow(run, "lang string, c0 int, c1 int, c2 int, c3 int, n bigint")


def _sample(docs: DataFrame, train: Column, id_col: str, lang_col: str, text_col: str, rows: int) -> DataFrame:
    """(lang, text, part): about ``rows`` whole documents of each language, the same in every run."""
    taught = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    taught = taught.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    number = F.count(F.lit(1))
    rates = taught.groupBy("lang").agg((F.lit(float(rows)) / number).alias("rate"), (number < FEW).alias("few"))
    rates = materialise(rates, "rates")
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    part = F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(5))
    picked = taught.withColumn("drawn", drawn).join(rates, "lang").where("drawn < rate")
    part = F.when(F.col("few"), 1).otherwise(part)
    return materialise(picked.select("lang", "text", part.alias("part")), "language-sample")


def fit(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    lang_col: str = "lang",
    text_col: str = "text",
    per_language: int = PER_LANGUAGE,
    sequences: int = SEQUENCES,
) -> Models | None:
    """Models of every language that ``train`` rows name; None if they name none."""
    ship_package(docs.sparkSession)
    sample = _sample(docs, train, id_col, lang_col, text_col, per_language)
    counted = _count_sequences(sample.where("part > 0").select("lang", "text"))
    summed = counted.groupBy("lang", "c0", "c1", "c2", "c3").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "c0", "c1", "c2", "c3")
    kept = summed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= sequences).drop("rank")
    rows = [tuple(row) for row in kept.collect()]
    if not rows:
        return None
    models = build_models(rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            entropies, sizes, has_letter = models.cross_entropies(batch.column("text"))
            column = pa.array(list(entropies), pa.list_(pa.float64()))
            out = pa.RecordBatch.from_arrays([batch.column("lang"), column], ["lang", "entropies"])
            yield out.filter(pa.array(has_letter))

    held = sample.where("part = 0").select("lang", "text").mapInArrow(measure, "lang string, entropies array<double>")
    calibration = [(lang, values) for lang, values in held.collect() if lang in models.languages]
    return _calibrated(models, calibration)


def _calibrated(models: Models, held: list[tuple[str, list[float]]]) -> Models:
    """The sharpness that makes held-back languages likeliest, and the highest entropy of each."""
    highest = np.full(len(models.languages), np.inf)
    best = (np.inf, models.sharpness)
    if held:
        entropies = np.array([values for _, values in held])
        own = np.array([models.languages.index(lang) for lang, _ in held])
        for sharpness in (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0):
            trial = Models(models.languages, [], [], models.floor, sharpness)
            chance = trial.scores(entropies)[np.arange(len(own)), own]
            best = min(best, (float(-np.log(np.maximum(chance, 1e-9)).mean()), sharpness))
        for i in range(len(models.languages)):
            mine = entropies[own == i, i]
            if len(mine):
                highest[i] = np.quantile(mine, 1 - REJECTED) + 0.25
    return Models(models.languages, models.seen, models.fall, models.floor, best[1], highest)


def identify(docs: DataFrame, models: Models | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score``, ``cross_entropy``, ``rejected``.

    The language of a null text, or of one without a letter, is ``und`` with score 0, and
    so is every language without models. ``rejected`` marks texts whose best cross-entropy
    is beyond what the language's own texts show; their best language is still given. Ties
    go to the language first in order of name. Repeated rows each give a row; other
    columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if models is None:
        return rows.select(
            F.col("id").alias(id_col), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"),
        )
    shared = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in chunks(batches, "text"):
            entropies, _, has_letter = models.cross_entropies(batch.column("text"))
            best = entropies.argmin(axis=1)
            lowest = entropies[np.arange(len(best)), best]
            score = models.scores(entropies).max(axis=1)
            names = [models.languages[i] if known else UNKNOWN for i, known in zip(best, has_letter, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(names, pa.string()), pa.array(np.where(has_letter, score, 0.0)),
                    pa.array(lowest, mask=~has_letter), pa.array(~has_letter | (lowest > models.highest[best])),
                ],
                ["id", "lang_pred", "score", "cross_entropy", "rejected"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(
        run, f"id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean"
    )
    return found.withColumnRenamed("id", id_col)
