"""Secrets in text: fixed patterns, and a character network that judges every other candidate.

The patterns give the base spans. Every long run of key characters beside them, and every
shorter value that is assigned to something, is a candidate. A convolutional network over
the characters of a candidate and of the text around it gives its score.

The network is trained here, on labelled findings: base spans are secrets. As they look
much alike, each is also taken with its value drawn anew from the alphabets that keys are
written in, in its own or another context. Names, hosts, dates and numbers made of the
words of the same contexts are the counterexamples, and in a second round also the
candidates that the first one rejects. Findings held back from training calibrate the
scores and choose, for either family of candidates, the highest threshold that keeps the
wanted recall.

A text is read once. What is stored of it are its findings and the characters around them.
Training takes all different ones: they are dealt by a hash into tasks of bounded size. In
each round every task starts from the same network and learns from its own windows; then
the networks are averaged, each by its windows, and sent out again. One task, enough for a
small table, is plain training. Calibration and thresholds come from counts of all scores
of the findings held back. Only averages and counts reach the driver.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.arrow import chunks, ship_package
from isobar.storage import materialise

#: Secrets drawn anew at least, where there are few findings; else one for each finding, or two for each known secret.
DRAWN = 1200
#: Windows that one task learns from between two averages, about.
PER_TASK = 8192
#: One in so many lessons is held back from training, and scores that share a count in a unit of the logit.
HELD, BINS = 4, 64
#: Share of the held-out secrets that a threshold must let through, and the lowest threshold.
RECALL, EVEN = 0.98, 0.5
#: Shortest long run, and shortest assigned value.
LONG, SHORT = 16, 8
#: Characters before, of and behind a candidate that one window shows; a longer one has more windows.
LEFT, VALUE, RIGHT = 24, 64, 16
EPOCHS = 8
_REACH, _FILTERS, _WIDTH, _BATCH = 5, 24, 8, 256

# The base kinds in their order, then the two families of candidates.
BASE = ("assign", "access", "hex")
FAMILIES = ("long", "value")
# On lower-cased bytes, which keeps every place.
_ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_RUN = re.compile(rb"[A-Za-z0-9+/_.~-]{%d,}={0,2}" % LONG)
_VALUE = re.compile(rb"[:=][\"'\x20]*([A-Za-z0-9+/_.~-]{%d,%d})(?![A-Za-z0-9+/_.~-])" % (SHORT, LONG - 1))
_DIGIT, _LETTER, _TURN = re.compile(rb"[0-9]"), re.compile(rb"[A-Za-z]"), re.compile(rb"[a-z][A-Z]|[A-Z][a-z]")


def base_spans(text: bytes) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, where the value starts), in bytes, by start and then kind."""
    found = [("assign", *m.span(), m.start(1)) for m in _ASSIGN.finditer(text.lower()) if m.end(1) - m.start(1) >= 6]
    found += [("access", *m.span(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


def _key_like(run: bytes) -> bool:
    """Letters and digits together, or letters that change their case again and again."""
    if _DIGIT.search(run):
        return _LETTER.search(run) is not None
    return len(run) >= 20 and len(_TURN.findall(run)) >= 4


def candidates(text: bytes, taken: list[tuple[str, int, int, int]]) -> list[tuple[str, int, int, int]]:
    """Runs that could be secrets and touch no base span, as ``base_spans`` gives them."""
    found = []
    for family, pattern, group in (("long", _RUN, 0), ("value", _VALUE, 1)):
        for m in pattern.finditer(text):
            start, end = m.span(group)
            run = m[group].rstrip(b".")
            lead = len(run) - len(run.lstrip(b"."))
            if _key_like(run):
                found.append((family, start + lead, start + len(run), start + lead))
    if not taken or not found:
        return found
    starts = np.array([s[1] for s in taken])
    ends = np.maximum.accumulate([s[2] for s in taken])
    free = []
    for one in found:
        before = np.searchsorted(starts, one[2])
        if not before or ends[before - 1] <= one[1]:
            free.append(one)
    return free


_FINDING = "struct<kind:string,start:bigint,end:bigint,left:binary,value:binary,right:binary>"
_FINDING_TYPE = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("left", pa.binary()), ("value", pa.binary()),
     ("right", pa.binary())]
)


def _findings(text: bytes) -> list[dict]:
    base = base_spans(text)
    spans = sorted(base + candidates(text, base), key=lambda s: (s[1], (*BASE, *FAMILIES).index(s[0])))
    if not spans:
        return []
    # Continuation bytes start no code point.
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [
        {"kind": kind, "start": int(points[start]), "end": int(points[end]), "left": text[max(0, at - LEFT) : at],
         "value": text[at:end], "right": text[end : end + RIGHT]}
        for kind, start, end, at in spans
    ]


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, findings): base spans and candidates with the characters around them."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = pa.array([_findings(text or b"") for text in texts], pa.list_(_FINDING_TYPE))
            yield pa.RecordBatch.from_arrays([batch.column("id"), found], ["id", "findings"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, findings array<{_FINDING}>")


Shown = tuple[bytes, bytes, bytes]
_BEYOND, _NOTHING = 128, 129


def windows(shown: list[Shown]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters and the mask of the value's own, a row for each window, and each row's candidate."""
    parts, owners = [], []
    for number, (left, value, right) in enumerate(shown):
        whole, first = left + value + right, len(left)
        for at in range(0, max(1, len(value)), VALUE):
            held = value[at : at + VALUE]
            before = whole[max(0, first + at - LEFT) : first + at]
            after = whole[first + at + len(held) : first + at + len(held) + RIGHT]
            parts.append((before, held, after))
            owners.append(number)
    symbols = np.full((len(parts), LEFT + VALUE + RIGHT), _NOTHING, dtype=np.uint8)
    inside = np.zeros(symbols.shape, dtype=np.float32)
    for row, (before, held, after) in enumerate(parts):
        # A candidate's context touches it on both sides, whatever its length.
        line = np.minimum(np.frombuffer(before + held + after, np.uint8), _BEYOND)
        place = LEFT - len(before)
        symbols[row, place : place + len(line)] = line
        inside[row, LEFT : LEFT + len(held)] = 1
    return symbols, inside, np.array(owners, dtype=np.int64)


@dataclass
class CharNetwork:
    """Embedded characters, one convolution, three poolings, one output."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 11) -> CharNetwork:
        draw = np.random.default_rng(seed).standard_normal
        return CharNetwork({
            "letters": (draw((_NOTHING + 1, _WIDTH)) * 0.3).astype(np.float32),
            "filters": (draw((_REACH * (_WIDTH + 1), _FILTERS)) * 0.15).astype(np.float32),
            "filter_bias": np.zeros(_FILTERS, np.float32),
            "output": (draw(3 * _FILTERS + 1) * 0.1).astype(np.float32),
            "output_bias": np.zeros(1, np.float32),
        })

    def _forward(self, symbols: np.ndarray, inside: np.ndarray) -> tuple:
        w = self.weights
        each = np.concatenate([w["letters"][symbols], inside[:, :, None]], axis=2)
        rows, length, depth = each.shape
        out = length - _REACH + 1
        seen = np.lib.stride_tricks.sliding_window_view(each, _REACH, axis=1).transpose(0, 1, 3, 2).reshape(rows, out, -1)
        raised = np.maximum(seen @ w["filters"] + w["filter_bias"], 0)
        own = inside[:, _REACH // 2 : _REACH // 2 + out, None]
        number = np.maximum(own.sum(axis=1), 1)
        most, around = raised * own, raised * (1 - own)
        top, top_around = most.argmax(axis=1), around.argmax(axis=1)
        size = np.log2(1 + inside.sum(axis=1, keepdims=True)) / 6
        pooled = np.concatenate([most.max(axis=1), most.sum(axis=1) / number, around.max(axis=1), size], axis=1)
        return seen, raised, own, number, top, top_around, pooled, pooled @ w["output"] + w["output_bias"]

    def logits(self, symbols: np.ndarray, inside: np.ndarray) -> np.ndarray:
        parts = [
            self._forward(symbols[at : at + _BATCH], inside[at : at + _BATCH])[-1] for at in range(0, len(symbols), _BATCH)
        ]
        return np.concatenate([np.empty(0, np.float32), *parts])

    def gradients(
        self, symbols: np.ndarray, inside: np.ndarray, labels: np.ndarray, shares: np.ndarray | float = 1.0
    ) -> tuple[float, dict[str, np.ndarray]]:
        """The mean cross-entropy, each row's taken by its share, and its gradient."""
        w = self.weights
        seen, raised, own, number, top, top_around, pooled, logit = self._forward(symbols, inside)
        chance = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        loss = float(np.mean(shares * (np.logaddexp(0, logit) - labels * logit)))
        error = (shares * (chance - labels) / len(labels)).astype(np.float32)
        back = error[:, None] * w["output"]
        f = _FILTERS
        hidden = np.repeat((back[:, None, f : 2 * f] / number[:, None]) * 1.0, seen.shape[1], axis=1) * own
        row, column = np.arange(len(labels))[:, None], np.arange(f)[None, :]
        np.add.at(hidden, (row, top, column), back[:, :f] * own[row, top, 0])
        np.add.at(hidden, (row, top_around, column), back[:, 2 * f : 3 * f] * (1 - own[row, top_around, 0]))
        hidden *= raised > 0
        flat, met = hidden.reshape(-1, f), seen.reshape(-1, seen.shape[2])
        through = (flat @ w["filters"].T).reshape(*seen.shape[:2], _REACH, _WIDTH + 1)[..., :_WIDTH]
        letters = np.zeros_like(w["letters"])
        for shift in range(_REACH):
            part = symbols[:, shift : shift + seen.shape[1]].ravel()
            pulled = through[:, :, shift].reshape(-1, _WIDTH)
            for depth in range(_WIDTH):
                letters[:, depth] += np.bincount(part, weights=pulled[:, depth], minlength=len(letters))
        return loss, {
            "letters": letters, "filters": met.T @ flat, "filter_bias": flat.sum(axis=0),
            "output": pooled.T @ error, "output_bias": error.sum(keepdims=True),
        }


@dataclass
class Learner:
    """A network and Adam's two moments of its weights, which go from round to round together."""

    network: CharNetwork
    first: dict[str, np.ndarray]
    second: dict[str, np.ndarray]
    step: float = 0.0

    @staticmethod
    def fresh() -> Learner:
        network = CharNetwork.fresh()
        first, second = ({name: np.zeros_like(value) for name, value in network.weights.items()} for _ in range(2))
        return Learner(network, first, second)

    def flat(self) -> np.ndarray:
        parts = (self.network.weights, self.first, self.second)
        return np.concatenate([*(value.ravel() for part in parts for value in part.values()), [self.step]]).astype(np.float64)

    def replaced(self, flat: np.ndarray) -> Learner:
        parts, at = [], 0
        for part in (self.network.weights, self.first, self.second):
            parts.append({})
            for name, value in part.items():
                parts[-1][name] = flat[at : at + value.size].reshape(value.shape).astype(np.float32)
                at += value.size
        return Learner(CharNetwork(parts[0]), parts[1], parts[2], float(flat[at]))

    def learn(
        self, symbols: np.ndarray, inside: np.ndarray, labels: np.ndarray, shares: np.ndarray, order: np.random.Generator
    ) -> None:
        """Adam over shuffled batches, once over all rows."""
        weights, mixed = self.network.weights, order.permutation(len(labels))
        for at in range(0, len(mixed), _BATCH):
            own = mixed[at : at + _BATCH]
            _, pulls = self.network.gradients(symbols[own], inside[own], labels[own], shares[own])
            self.step += 1
            for name, pull in pulls.items():
                self.first[name] += 0.1 * (pull - self.first[name])
                self.second[name] += 0.01 * (pull * pull - self.second[name])
                rise = self.first[name] / (1 - 0.9**self.step)
                weights[name] = (
                    weights[name] - 0.01 * rise / (np.sqrt(self.second[name] / (1 - 0.99**self.step)) + 1e-8)
                ).astype(np.float32)


def _logits(network: CharNetwork, shown: list[Shown]) -> np.ndarray:
    """Of each candidate; one of several windows has the mean of theirs."""
    if not shown:
        return np.empty(0)
    symbols, inside, owners = windows(shown)
    return np.bincount(owners, weights=network.logits(symbols, inside)) / np.bincount(owners)


@dataclass(frozen=True)
class Judge:
    """The network, its calibration, and a threshold for each family."""

    network: CharNetwork
    slope: float
    offset: float
    thresholds: dict[str, float]

    def scores(self, shown: list[Shown]) -> np.ndarray:
        """The probability of a secret."""
        return self.chances(_logits(self.network, shown))

    def chances(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.offset, -30, 30)))


# The alphabets that keys are written in.
_ALPHABETS = (
    b"0123456789abcdef", b"0123456789ABCDEF", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    b"abcdefghijklmnopqrstuvwxyz0123456789",
)


def _redrawn(contexts: list[tuple[bytes, bytes]], number: int, random: np.random.Generator) -> list[Shown]:
    """Secrets of other alphabets and lengths, in given contexts."""
    out = []
    while len(out) < number:
        left, right = contexts[random.integers(len(contexts))]
        letters = np.frombuffer(_ALPHABETS[random.integers(len(_ALPHABETS))], np.uint8)
        short = random.random() < 0.25
        size = int(random.integers(SHORT + 2, LONG)) if short else int(random.integers(20, 72))
        value = letters[random.integers(0, len(letters), size)].tobytes()
        if not short and random.random() < 0.3:
            value = bytes(random.integers(97, 123, int(random.integers(2, 5))).astype(np.uint8)) + b"_-"[random.integers(2) :][:1] + value
        if short:
            left = (left.rstrip(b" :=\"'") + (b" = ", b": ", b"=")[random.integers(3)])[-LEFT:]
        if _key_like(value):
            out.append((left, value, right))
    return out


def _harmless(contexts: list[tuple[bytes, bytes]], number: int, random: np.random.Generator) -> list[Shown]:
    """Names, hosts, paths, dates and numbers made of the words of the contexts."""
    words = sorted({w.lower() for left, right in contexts for w in re.findall(rb"[A-Za-z]{3,}", left + b" " + right)})
    words = words or [b"word", b"name", b"item"]
    word = lambda: words[random.integers(len(words))]
    count = lambda most: b"%d" % random.integers(0, most)
    date = lambda: b"20%02d-%02d-%02d" % (random.integers(100), random.integers(1, 13), random.integers(1, 29))
    several = lambda join: join.join(word() for _ in range(random.integers(2, 5)))
    kinds = (
        lambda: several(b"_") + b"_" + count(100),
        lambda: several(b"-") + b"-" + count(3000),
        lambda: word() + count(10) + b"." + word() + b".com",
        lambda: several(b"/") + b"/" + count(100) + b".html",
        lambda: b"".join(word().capitalize() for _ in range(3)) + count(1000),
        lambda: date() + b"T" + b"%02d" % random.integers(24),
        lambda: date() + b"-" + several(b"-"),
        lambda: count(20) + b"." + count(20) + b"." + count(100) + b"-" + word() + count(10),
        lambda: several(b"") + count(100),
        lambda: word() + count(10**9),
        lambda: b"-".join(b"%0*x" % (n, random.integers(0, 16**n)) for n in (8, 4, 4, 4, 12)),
        lambda: several(b"_").upper() + count(10),
        lambda: word() + b"+" + word() + b"/" + count(1000) + b"-" + word(),
    )
    out = []
    while len(out) < number:
        left, right = contexts[random.integers(len(contexts))]
        value = kinds[random.integers(len(kinds))]()
        if random.random() < 0.2:
            left = (left.rstrip(b" :=\"'") + (b" = ", b": ", b"=")[random.integers(3)])[-LEFT:]
        if len(value) >= SHORT and _key_like(value):
            out.append((left, value, right))
    return out


_LESSON = "left binary, value binary, right binary, label float, held boolean"


def _lessons(shown: DataFrame, secrets: int, number: int) -> DataFrame:
    """Labelled findings, and the values made in the context of every finding; some of each are held back."""
    tasks = math.ceil(number / PER_TASK)
    # Values drawn anew in the context of each finding; at least one, so that rejected candidates outnumber no secrets.
    anew = max(1, 2 * secrets / number, DRAWN / number)

    def invent(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        each = sorted(zip(*(rows.column(name).to_pylist() for name in ("left", "right", "known")), strict=True))
        contexts = [(left, right) for left, right, _ in each]
        random = np.random.default_rng([29, key[0].as_py()])
        positive = _redrawn(contexts, math.ceil(len(contexts) * anew), random)
        negative = _harmless(contexts, len(positive) + sum(known for _, _, known in each), random)
        left, value, right = zip(*positive, *negative, strict=True)
        return pa.table({
            "left": pa.array(left, pa.binary()), "value": pa.array(value, pa.binary()), "right": pa.array(right, pa.binary()),
            "label": pa.array([1.0] * len(positive) + [0.0] * len(negative), pa.float32()),
            "held": pa.array(random.random(len(value)) < 1 / HELD),
        })

    task = F.pmod(F.xxhash64("left", "value", "right"), F.lit(tasks)).alias("task")
    contexts = shown.select("left", "right", "known", task).repartition(tasks, "task")
    # All contexts of a value are on the same side.
    held = (F.pmod(F.xxhash64("value"), F.lit(HELD)) == 0).alias("held")
    found = shown.where("known").select("left", "value", "right", F.lit(1.0).cast("float").alias("label"), held)
    return found.unionByName(contexts.groupBy("task").applyInArrow(invent, _LESSON))


def _shown(batch: pa.RecordBatch) -> list[Shown]:
    return list(zip(*(batch.column(name).to_pylist() for name in ("left", "value", "right")), strict=True))


def _dealt(lessons: DataFrame) -> DataFrame:
    """The windows of all lessons, stored as one row for each task that learns."""
    number = lessons.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.length("value") / F.lit(VALUE))))).first()[0]
    tasks = math.ceil(number / PER_TASK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "value"):
            symbols, inside, owners = windows(_shown(batch))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lesson").take(pa.array(owners)),
                    pa.array(np.arange(len(owners)) - np.searchsorted(owners, owners)),
                    pa.array([row.tobytes() for row in symbols], pa.binary()),
                    pa.array(inside.sum(axis=1).astype(np.int32)), batch.column("label").take(pa.array(owners)),
                    # A lesson counts once, however many windows it has.
                    pa.array((1 / np.bincount(owners)[owners]).astype(np.float32)),
                ],
                ["lesson", "number", "symbols", "size", "label", "share"],
            )

    lesson = F.xxhash64("left", "value", "right", "label").alias("lesson")
    each = lessons.select(lesson, "left", "value", "right", "label").mapInArrow(
        run, "lesson bigint, number bigint, symbols binary, size int, label float, share float"
    )
    task = F.pmod(F.xxhash64("lesson", "number"), F.lit(tasks)).cast("int")
    rows = each.withColumn("task", task).repartition(tasks, "task").groupBy("task")
    # Sorted, so that every run learns in the same order.
    own = rows.agg(F.array_sort(F.collect_list(F.struct("lesson", "number", "symbols", "size", "label", "share"))).alias("own"))
    return materialise(own.select("task", "own.symbols", "own.size", "own.label", "own.share"), "windows")


def _averaged(parts: DataFrame) -> np.ndarray:
    """The mean of the tasks' states, each by its windows; decimals have the same sum in any order."""
    each = parts.select("number", F.posexplode("state").alias("place", "value"))
    total = F.sum((F.col("value") * F.col("number")).cast("decimal(38,22)")).cast("double")
    mean = each.groupBy("place").agg((total / F.sum("number")).alias("mean"))
    rows = mean.collect()
    flat = np.empty(len(rows))
    flat[[row["place"] for row in rows]] = [row["mean"] for row in rows]
    return flat


def _trained(dealt: DataFrame, rounds: int) -> CharNetwork:
    learner = Learner.fresh()
    for number in range(rounds):
        shared = dealt.sparkSession.sparkContext.broadcast(learner)

        def learn(batches: Iterator[pa.RecordBatch], number: int = number, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for task, symbols, size, labels, shares in zip(*batch.columns, strict=True):
                    learner = shared.value.replaced(shared.value.flat())
                    symbols = np.frombuffer(b"".join(symbols.values.to_pylist()), np.uint8).reshape(len(labels.values), -1)
                    place = np.arange(symbols.shape[1]) - LEFT
                    inside = ((place >= 0) & (place < size.values.to_numpy()[:, None])).astype(np.float32)
                    order = np.random.default_rng([5, number, task.as_py()])
                    learner.learn(symbols, inside, labels.values.to_numpy(), shares.values.to_numpy(), order)
                    state = pa.array([learner.flat()], pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([pa.array([len(symbols)]), state], ["number", "state"])

        learner = learner.replaced(_averaged(dealt.mapInArrow(learn, "number bigint, state array<double>")))
        shared.unpersist()
    return learner.network


def _judged(rows: DataFrame, network: CharNetwork) -> DataFrame:
    """``rows`` with the logit of each."""
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "value"):
            logit = pa.array(_logits(shared.value, _shown(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, logit], [*batch.schema.names, "logit"])

    return rows.mapInArrow(run, f"{_LESSON}, logit double")


def _calibrated(logit: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a weak pull towards 1 and 0."""
    x, weights = np.stack([logit, np.ones_like(logit)], axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (counts * (labels - chance)) - (weights - [1.0, 0.0])
        weights = weights + np.linalg.solve((x * (counts * chance * (1 - chance))[:, None]).T @ x + np.eye(2), slope)
    return float(max(weights[0], 1e-3)), float(weights[1])


def _with_thresholds(network: CharNetwork, kept: DataFrame, recall: float) -> Judge:
    """Calibration and thresholds from all lessons held back, counted by the lower edge of their logit's bin."""
    edge = F.floor(F.greatest(F.lit(-20), F.least(F.lit(20), "logit")) * BINS) / BINS
    family = F.when(F.length("value") < LONG, "value").otherwise("long")
    counted = _judged(kept, network).groupBy(edge.alias("edge"), family.alias("family"), "label").count()
    rows = counted.orderBy("edge", "family", "label").collect()
    edges, labels, counts = (np.array([row[name] for row in rows], dtype=np.float64) for name in ("edge", "label", "count"))
    judge = Judge(network, *_calibrated(edges, labels, counts), {})
    for family in FAMILIES:
        own = np.array([row["family"] == family for row in rows], dtype=bool) & (labels == 1)
        limit, passed = 1.0, np.cumsum(counts[own])
        if len(passed):
            # The highest edge that lets the wanted share of the held-out secrets through.
            place = np.searchsorted(passed, int((1 - recall) * passed[-1]), side="right")
            limit = judge.chances(edges[own][place])
        judge.thresholds[family] = float(max(EVEN, limit))
    return judge


def fit(scanned: DataFrame, recall: float = RECALL, epochs: int = EPOCHS) -> Judge | None:
    """Train on all different findings of a stored table. None without base spans."""
    ship_package(scanned.sparkSession)
    each = scanned.select(F.explode("findings").alias("f")).select("f.*")
    # Copies of a finding with the same characters around it teach once.
    known = F.max(F.col("kind").isin(*BASE)).alias("known")
    shown = materialise(each.groupBy("left", "value", "right").agg(known), "shown")
    secrets, number = shown.agg(F.count_if("known"), F.count(F.lit(1))).first()
    if not secrets:
        return None
    lessons = materialise(_lessons(shown, secrets, number), "lessons")
    taught = lessons.where("not held")
    network = _trained(_dealt(taught), max(1, epochs // 2))
    harmless = F.lit(0.0).cast("float").alias("label"), F.lit(False).alias("held")
    others = shown.where("not known").select("left", "value", "right", *harmless)
    rejected = materialise(_judged(others, network).where("logit < 0").drop("logit"), "rejected")
    network = _trained(_dealt(taught.unionByName(rejected)), epochs)
    return _with_thresholds(network, lessons.where("held"), recall)


_SPAN_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and ``spans`` (kind, start, end, score), by start and then kind.

    Starts and ends count code points, ends are exclusive. All base spans are kept,
    whatever their score; candidates (``long``, ``value``) from the threshold of their
    family on. Null and empty texts have no spans. Without any base span in the table
    there is nothing to learn from: no candidate is kept. A text of any length is
    searched whole and a candidate of any length judged by all of its windows. Repeated
    rows each give a row and teach once; other columns are ignored.
    """
    scanned = materialise(scan(docs, id_col, text_col), "findings")
    judge = scanned.sparkSession.sparkContext.broadcast(fit(scanned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for found in batch.column("findings").to_pylist():
                kept = []
                scores = np.ones(len(found))
                if judge.value is not None and found:
                    scores = judge.value.scores([(f["left"], f["value"], f["right"]) for f in found])
                for f, score in zip(found, scores.tolist(), strict=True):
                    limit = 0.0 if f["kind"] in BASE else judge.value.thresholds[f["kind"]] if judge.value else 2.0
                    if score >= limit:
                        kept.append({"kind": f["kind"], "start": f["start"], "end": f["end"], "score": score})
                spans.append(kept)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, pa.list_(_SPAN_TYPE))], ["id", "spans"])

    kind = scanned.schema["id"].dataType.simpleString()
    found = scanned.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return found.select(F.col("id").alias(id_col), "spans")


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by base kind, a digest of the base spans, all spans as text, and the highest score."""
    found = find_secrets(docs, id_col, text_col)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    return found.select(
        F.col(id_col), *(of(kind) for kind in BASE),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("top_score"),
    )
