"""Secrets in texts: patterns, and a character network that judges every other candidate in its context."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airseries.llm import char_cnn
from airseries.llm.common import release_memory
from airseries.operators.quantiles import quantiles_of
from airseries.session import stage, stage_even

#: Kinds of spans in the order they are listed in; the network's own come last.
KINDS = ("assign", "access", "hex", "cnn")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
#: Some text before any match of ASSIGN, for a quick look.
KEYWORD = "(?i)password|passwd|secret|token|api_?key"
#: A longer run includes every shorter one, so a run that is long enough matches from its start.
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
ASSIGN_LEAST, HEX_LEAST, CANDIDATE_LEAST = 6, 24, 16
#: A candidate that changes between letter and digit no more than so often is a word, a number or a plain name.
PLAIN_CHANGES = 2
#: Code points of context on both sides of a candidate.
CONTEXT = 24
#: Bytes of text scanned at once; a longer text is scanned alone.
PART = 4 << 20
#: Times that all findings are learned from.
ROUNDS = 6
#: Findings, and characters of their windows, that are learned from in one row: a slice holds about so many.
SLICE_FINDINGS, SLICE_CHARACTERS = 8192, 4 << 20
#: Pieces that a learner is cut into to be averaged, and learners that are averaged at once.
PIECES, FAN = 16, 256
#: From so many findings of a shape on, its threshold is drawn on them alone.
LEAST_FINDINGS = 20

_CLASS = np.zeros(256, np.uint8)
_CLASS[list(b"0123456789abcdef")] = 2
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz+/_.=-")] = 1


def runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches of True that are at least so long."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


class Scanned:
    """Base spans and candidates of a batch of texts, in code points of each text."""

    def __init__(self, texts: list[bytes], worded: list[bool]) -> None:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        # A line feed between texts belongs to no run.
        joined = b"\n".join(texts)
        self.first = np.cumsum(sizes + 1) - sizes - 1
        data = np.frombuffer(joined, np.uint8)
        classes = _CLASS[data]
        spans: list[tuple[int, int, int]] = []
        for i in np.flatnonzero(worded).tolist():
            base = int(self.first[i])
            spans += [(base + m.start(), 0, base + m.end()) for m in ASSIGN.finditer(texts[i]) if len(m[2]) >= ASSIGN_LEAST]
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(joined)]
        spans += [(s, 2, e) for s, e in zip(*(x.tolist() for x in runs(classes == 2, HEX_LEAST)), strict=True)]
        spans.sort()
        #: Start, kind and end of every base span, in bytes of the joined texts.
        self.spans = np.array(spans, np.int64).reshape(-1, 3)
        self.candidates = np.stack(runs(classes > 0, CANDIDATE_LEAST), 1)
        self.data, self.sizes = data, sizes
        self._points = np.cumsum(np.concatenate([[0], (data & 0xC0) != 0x80]), dtype=np.int64)

    def points(self, at: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Code points from the start of the text to a place in the joined bytes."""
        return self._points[at] - self._points[self.first[text]]

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1

    def covered(self) -> np.ndarray:
        """Which candidates share a byte with a base span."""
        change = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(change, self.spans[:, 0], 1)
        np.add.at(change, self.spans[:, 2], -1)
        held = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
        return held[self.candidates[:, 1]] > held[self.candidates[:, 0]]

    def plain(self) -> np.ndarray:
        """Which candidates are words, numbers or plain names."""
        digit = (self.data >= 48) & (self.data <= 57)
        folded = self.data | 32
        letter = (folded >= 97) & (folded <= 122)
        change = (digit[:-1] & letter[1:]) | (letter[:-1] & digit[1:])
        upto = np.concatenate([[0, 0], np.cumsum(change)])
        # Changes inside the run only.
        return upto[self.candidates[:, 1]] - upto[self.candidates[:, 0] + 1] <= PLAIN_CHANGES

    def window(self, start: int, end: int, text: int) -> tuple[str, int]:
        """A candidate with its context, and the code points before it."""
        lo, hi = int(self.first[text]), int(self.first[text] + self.sizes[text])
        before = self.data[max(lo, start - 4 * CONTEXT) : start].tobytes().decode(errors="ignore")[-CONTEXT:]
        after = self.data[end : min(hi, end + 4 * CONTEXT)].tobytes().decode(errors="ignore")[:CONTEXT]
        return before + self.data[start:end].tobytes().decode() + after, len(before)


FOUND_DDL = (
    "id long, kinds array<int>, starts array<long>, ends array<long>,"
    " candidates array<struct<start:long,end:long,label:int,before:int,window:string>>"
)


def _arrow(ddl: str) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T._parse_datatype_string(ddl)
    return schema, to_arrow_schema(schema)


def _scan_batch(ids: pa.Array, texts: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
    worded = pc.fill_null(pc.match_substring_regex(texts, KEYWORD), False).to_pylist()
    whole = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    found = Scanned(whole, worded)
    numbers = np.arange(len(whole) + 1)
    span_text = found.text_of(found.spans[:, 0])
    starts, ends = (found.points(found.spans[:, k], span_text) for k in (0, 2))
    bounds = np.searchsorted(span_text, numbers)
    own_text = found.text_of(found.candidates[:, 0])
    own_starts, own_ends = (found.points(found.candidates[:, k], own_text) for k in (0, 1))
    # Findings of the patterns are secrets, words and numbers are none; about the others nothing is known.
    label = np.where(found.covered(), 1, np.where(found.plain(), 0, -1)).tolist()
    candidates: list[list[dict]] = [[] for _ in whole]
    for k, (start, end) in enumerate(found.candidates.tolist()):
        window, before = found.window(start, end, int(own_text[k]))
        candidates[own_text[k]].append(
            {"start": int(own_starts[k]), "end": int(own_ends[k]), "label": label[k], "before": before, "window": window}
        )
    split = lambda x: [x[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
    columns = [ids, split(found.spans[:, 1].astype(np.int32)), split(starts), split(ends), candidates]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans of every text and all candidates with their context, staged; the texts themselves are left behind."""
    schema, arrow = _arrow(FOUND_DDL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held = 0, 0
            for i in range(batch.num_rows + 1):
                text = batch.column(1)[i] if i < batch.num_rows else None
                size = len(text.as_buffer()) if text is not None and text.is_valid else 0
                if i > start and (i == batch.num_rows or held + size > PART):
                    yield _scan_batch(batch.column(0)[start:i], batch.column(1)[start:i], arrow)
                    start, held = i, 0
                    release_memory()
                held += size

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return stage(source.mapInArrow(run, schema), "scanned")


@dataclass
class Judge:
    """The network, its calibration, and the threshold of each shape of context."""

    network: char_cnn.Network
    slope: float
    offset: float
    thresholds: dict[bool, float]

    def chances(self, windows: list[np.ndarray]) -> np.ndarray:
        return self.chance_of(char_cnn.all_logits(self.network, windows))

    def chance_of(self, logits: np.ndarray) -> np.ndarray:
        x = self.slope * logits + self.offset
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def assigned(window: str, before: int) -> bool:
    """Whether the candidate follows a colon or an equals sign, quotes and spaces aside."""
    return window[:before].rstrip(" \"'")[-1:] in ("=", ":")


def train(found: DataFrame, recall: float = 0.95) -> Judge | None:
    """A judge from labelled findings: candidates that share a byte with a base span are secrets, candidates that
    change between letter and digit at most twice (words, numbers, plain names) are none, others are not learned from.

    All findings are learned from, of any length; equal windows count once. By their hash a fifth is held out, on
    which probabilities are calibrated and thresholds set: the highest that finds ``recall`` of the held-out findings, for
    candidates after a colon or an equals sign and for others (where the patterns find too few of those, their threshold
    is drawn on findings without context). None where a label has fewer than two examples on either side.

    Findings are dealt into slices. In each of ROUNDS rounds every slice goes on from the same network on its own, and the
    networks are averaged by their findings (see :func:`fit`). Calibration and thresholds are sums and counts over all
    held-out findings. The driver gets one network a round.
    """
    labelled = found.select(F.inline("candidates")).where("label >= 0")
    distinct = labelled.groupBy("window", "before").agg(F.max("label").alias("label"))
    hashed = F.xxhash64("window", "before")
    held = F.pmod(F.shiftright(hashed, 7), F.lit(5)) == 0
    distinct = stage_even(distinct.select("window", "before", "label", hashed.alias("hash"), held.alias("held")), "findings")
    sides = {(h, label): (0, 0) for h in (False, True) for label in (0, 1)}
    size = F.sum(F.length("window").cast("long"))
    sides |= {(r[0], r[1]): (r[2], r[3]) for r in distinct.groupBy("held", "label").agg(F.count("*"), size).collect()}
    if any(n < 2 for n, _ in sides.values()):
        return None
    n, characters = (sides[False, 0][k] + sides[False, 1][k] for k in (0, 1))
    slices = max(1, -(-n // SLICE_FINDINGS), -(-characters // SLICE_CHARACTERS))
    network = fit(_sliced(distinct.where("NOT held"), slices), slices)
    judged = stage(_logits(distinct.where("held"), network), "judged")
    slope, offset = char_cnn.platt(_platt_sums(judged, sides[True, 1][0], sides[True, 0][0]))
    judge = Judge(network, slope, offset, {})
    # The highest chances are those of the highest logits.
    sign = 1.0 if slope >= 0 else -1.0
    secret = F.col("label") == 1
    seen, alone = (F.when(secret, F.col(c) * sign) for c in ("seen", "alone"))
    own = judged.select(
        seen.alias("all_seen"), alone.alias("all_alone"), *[F.when(F.col("shape") == k, seen).alias(f"seen_{k}") for k in (True, False)]
    )
    counts = own.agg(*[F.count(c) for c in own.columns]).first()
    wanted = {}
    for c, count in zip(own.columns, counts, strict=True):
        if count:
            # The rank from below of the finding that completes the wanted share from above.
            wanted[c] = [Fraction(count - max(1, int(np.ceil(recall * count))) + 1, count)]
    limits = quantiles_of(own, wanted)
    for kind, spare in ((True, "all_seen"), (False, "all_alone")):
        enough = counts[f"count(seen_{kind})"] >= LEAST_FINDINGS
        limit = limits[f"seen_{kind}" if enough else spare][0]
        judge.thresholds[kind] = max(0.5, float(judge.chance_of(np.array([sign * limit], np.float32))[0]))
    return judge


SLICE_DDL = "slice int, findings long, codes binary, sizes binary, labels binary"


def _sliced(learned: DataFrame, slices: int) -> DataFrame:
    """The findings as one row per slice, staged: codes of all its windows, their sizes and labels, in order of hash."""
    schema, arrow = _arrow(SLICE_DDL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, codes, labels = 0, [], []
        for batch in batches:
            windows = _encoded(batch)
            if windows:
                number = batch.column(3)[0].as_py()
            codes += windows
            labels += batch.column(2).to_pylist()
        if codes:
            sizes = np.fromiter(map(len, codes), np.int64, len(codes))
            row = (number, len(codes), np.concatenate(codes).tobytes(), sizes.tobytes(), np.array(labels, np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, arrow, strict=True)], schema=arrow)
        release_memory()

    number = F.pmod(F.xxhash64("hash"), F.lit(slices)).cast("int").alias("slice")
    dealt = learned.select("window", "before", "label", number, "hash").repartitionById(slices, "slice")
    ordered = dealt.sortWithinPartitions("hash", "window", "before").drop("hash")
    return stage(ordered.mapInArrow(run, schema), "slices")


LEARNER_DDL = "slice int, piece int, findings long, numbers binary"


def fit(sliced: DataFrame, slices: int) -> char_cnn.Network:
    """A network trained on all slices: they go on from one network side by side, and after each round it becomes the
    mean of theirs, weighted by their findings. With one slice this is Adam over all findings."""
    schema, arrow = _arrow(LEARNER_DDL)

    def learn(state, turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    number, findings, codes, sizes, labels = (batch.column(k)[i].as_py() for k in range(5))
                    ends = np.cumsum(np.frombuffer(sizes, np.int64))
                    windows = np.split(np.frombuffer(codes, np.int16), ends[:-1])
                    learner = char_cnn.Learner.of(state.value)
                    learner.epoch(windows, np.frombuffer(labels, np.float32), np.random.default_rng([turn, number]))
                    pieces = [x.tobytes() for x in np.array_split(learner.vector(), PIECES)]
                    columns = [[number] * PIECES, list(range(PIECES)), [findings] * PIECES, pieces]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
                    release_memory()

        return run

    def mean(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["slice"])
        findings = sum(r["findings"] for r in rows)
        total = sum(np.frombuffer(r["numbers"], np.float32).astype(np.float64) * r["findings"] for r in rows) / findings
        row = {"slice": rows[0]["slice"] // FAN, "piece": rows[0]["piece"], "findings": findings, "numbers": total.astype(np.float32).tobytes()}
        return pa.Table.from_pylist([row], schema=arrow)

    spark = sliced.sparkSession
    vector = char_cnn.Learner.fresh().vector()
    for turn in range(ROUNDS):
        state = spark.sparkContext.broadcast(vector)
        made, left = sliced.mapInArrow(learn(state, turn), schema), slices
        while left > 1:
            made = made.groupBy(F.expr(f"slice div {FAN}"), "piece").applyInArrow(mean, schema)
            left = -(-left // FAN)
        pieces = sorted(made.collect(), key=lambda r: r.piece)
        vector = np.concatenate([np.frombuffer(r.numbers, np.float32) for r in pieces])
        state.destroy()
    return char_cnn.Learner.of(vector).network


def _logits(held: DataFrame, network: char_cnn.Network) -> DataFrame:
    """Label and shape of every finding, and its logits with its context and without."""
    state = held.sparkSession.sparkContext.broadcast(network)
    schema, arrow = _arrow("label int, shape boolean, seen double, alone double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = _encoded(batch)
            shapes = [assigned(w, b) for w, b in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True)]
            seen = char_cnn.all_logits(state.value, windows)
            alone = char_cnn.all_logits(state.value, [char_cnn.without_context(w) for w in windows])
            columns = [batch.column(2), pa.array(shapes, pa.bool_()), pa.array(seen.astype(float)), pa.array(alone.astype(float))]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
            release_memory()

    return held.select("window", "before", "label").mapInArrow(run, schema)


def _platt_sums(judged: DataFrame, positive: int, negative: int):
    """The sums that calibration asks for, over the logits of all findings in both forms (candidates must also be known
    by themselves)."""
    found, other = char_cnn.targets(2 * positive, 2 * negative)
    target = F.when(F.col("label") == 1, found).otherwise(other)
    both = judged.select(target.alias("target"), F.explode(F.array("seen", "alone")).alias("x"))

    def sums(slope: float, offset: float) -> list[float]:
        level = F.greatest(F.least(F.col("x") * slope + offset, F.lit(500.0)), F.lit(-500.0))
        chance = 1 / (1 + F.exp(-level))
        error, curve = chance - F.col("target"), chance * (1 - chance)
        x = F.col("x")
        return list(both.agg(*[F.sum(c) for c in (error * x, error, curve * x * x, curve * x, curve)]).first())

    return sums


def _encoded(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Codes of a batch whose first columns are windows and the characters before their candidates.

    A candidate ends with its run of characters."""
    run = re.compile(r"[0-9A-Za-z+/_.=-]*")
    rows = zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True)
    return [char_cnn.encode(w, before, run.match(w, before).end()) for w, before in rows]


SPANS_DDL = "id long, n_assign long, n_access long, n_hex long, n_cnn long, base_sha256 string, spans string"


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = 0.95) -> DataFrame:
    """Secret spans of every whole text: those of three patterns, and candidates the network takes for secrets.

    Spans are ``kind:start:end`` in code points, end exclusive. A candidate is a longest run of at least 16 characters of
    ``[A-Za-z0-9+/_.=-]``; the network sees it whole with 24 code points on either side. It is trained on all
    pattern findings of the corpus (see :func:`train`), and judges every candidate that shares no character with a base span.

    Returns ``id_col``, ``n_assign``, ``n_access``, ``n_hex``, ``n_cnn``, ``base_sha256``, ``spans``. Null is the empty
    text; a null id stays null; repeated rows come back each; other columns are left out. An empty table
    gives an empty one; without findings to learn from there are base spans only.
    """
    found = scan(docs, id_col, text_col)
    judge = docs.sparkSession.sparkContext.broadcast(train(found, recall))
    schema, arrow = _arrow(SPANS_DDL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _judged_batch(batch, judge.value, arrow)
            release_memory()

    return found.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _judged_batch(batch: pa.RecordBatch, judge: Judge | None, schema: pa.Schema) -> pa.RecordBatch:
    columns = {name: batch.column(name).to_pylist() for name in ("kinds", "starts", "ends", "candidates")}
    open_ = [(i, c) for i, own in enumerate(columns["candidates"]) for c in own if c["label"] != 1] if judge else []
    added: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
    if open_:
        windows = [char_cnn.encode(c["window"], c["before"], c["before"] + c["end"] - c["start"]) for _, c in open_]
        for (i, c), chance in zip(open_, judge.chances(windows).tolist(), strict=True):
            if chance >= judge.thresholds[assigned(c["window"], c["before"])]:
                added[i].append((c["start"], len(KINDS) - 1, c["end"]))
    rows = []
    for i, (kinds, starts, ends) in enumerate(zip(columns["kinds"], columns["starts"], columns["ends"], strict=True)):
        base = sorted(zip(starts, kinds, ends, strict=True))
        rows.append(
            (
                *[kinds.count(k) for k in range(len(KINDS) - 1)],
                len(added[i]),
                hashlib.sha256(_written(base).encode()).hexdigest(),
                _written(sorted(base + added[i])),
            )
        )
    made = [batch.column("id"), *zip(*rows, strict=True)] if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(made, schema, strict=True)], schema=schema
    )


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)
