"""Toxic documents by a string-kernel support vector machine with Nystroem landmarks.

A text is read as sentences, a sentence as units: its words without the signs around them, runs of single
letters ("i d i o t") as one unit, and overlapping windows of very long words. The kernel of two units counts
their common subsequences of three characters, each weighted by ``DECAY`` to the power of its length with
gaps, so inserted and changed characters cost similarity but do not break the match. Values are normalised
by the units' own kernels.

Labels are on documents, so they are brought down to units first: a unit is toxic if it stands in
significantly more contexts (previous and next word) in toxic sentences than its share of all contexts. Contexts
are counted, not documents, so that copies of a text count once. The toxic units and frequent clean ones are
the landmarks; a unit's features are its kernel values with the landmarks, whitened by the landmarks' own
kernel matrix (Nystroem), and a linear machine is trained on them, with intruded forms of the toxic units,
and again with the clean units that it takes for toxic. A linear function of Nystroem features is a linear function
of weighted subsequences, so the trained machine is one table with a value per three characters, whatever
the number of landmarks. A text's score is that of its most toxic unit, calibrated on the documents of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.bytes import SpanHasher, binary_column, blocks, byte_class, mix, word_spans
from basketlens.llm.tables import keep

IS_WORD = ~byte_class((0x00, 0x20))
SIGNIFICANT = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Characters of the kernel: 0 for both ends of a unit, a-z, one for other signs, 32 for the last bytes of
#: letters beyond ASCII and one for their first bytes.
ALPHABET = 61
CODE = np.full(256, 27, np.int32)
CODE[0x61:0x7B] = CODE[0x41:0x5B] = np.arange(1, 27)
CODE[0x80:0xC0] = 28 + np.arange(64) % 32
CODE[0xC0:] = 60
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
DECAY, MOST_SPAN, LONGEST, SHORTEST = 0.7, 9, 24, 3
#: Bounds of the training sample: documents per label, clean units, landmarks of each kind, clean units per repair.
SAMPLE_DOCS, CLEAN_UNITS, LANDMARKS, REPAIRS = 3000, 8000, 60, 2000
TOXIC_UNITS, TOXIC_LANDMARKS = 400, 160
#: A unit is toxic from this log-likelihood ratio on.
SIGNIFICANCE = 25.0
#: Lengths of the beginnings that inflected insults are known by.
STEMS = (4, 5, 6, 7)
FLOOR = -4.0
#: Weight of the machine's norm against its loss.
RIDGE = 1e-5
#: Scores of units that a task remembers.
REMEMBERED = 1 << 20
BLOCK = 1 << 20


def triples(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of all subsequences of three characters, and the weight of each."""
    found = [(i, j, k) for i in range(length) for k in range(i + 2, min(length, i + MOST_SPAN)) for j in range(i + 1, k)]
    i, j, k = np.array(found, np.int64).reshape(-1, 3).T
    return i, j, k, (DECAY ** (k - i + 1)).astype(np.float32)


def subsequences(codes: np.ndarray, table: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, subsequence numbers and normalised weights of units of one length (a row of codes each)."""
    codes = np.pad(codes, ((0, 0), (1, 1)))  # both ends count as characters
    length = codes.shape[1]
    if length not in table:
        table[length] = triples(length)
    i, j, k, weights = table[length]
    number = (codes[:, i] * ALPHABET + codes[:, j]) * ALPHABET + codes[:, k]
    order = np.argsort(number, axis=1)
    number = np.take_along_axis(number, order, 1)
    weights = weights[order]
    first = np.ones(number.shape, bool)
    first[:, 1:] = number[:, 1:] != number[:, :-1]
    at = np.flatnonzero(first)
    summed = np.add.reduceat(weights.ravel(), at)
    rows = at // number.shape[1]
    norm = np.sqrt(np.bincount(rows, summed * summed, len(codes)))
    return rows, number.ravel()[at], summed / norm[rows]


class Units:
    """The units of a block of texts: code strings with their document, and a hash of each."""

    def __init__(self, hasher: SpanHasher, buf: np.ndarray, offsets: np.ndarray) -> None:
        self.codes = CODE[buf]
        starts, ends, first = word_spans(buf, offsets, IS_WORD)
        good = SIGNIFICANT[buf]
        n = len(buf)
        place = np.arange(n)
        following = np.minimum.accumulate(np.where(good, place, n)[::-1])[::-1] if n else place
        previous = np.maximum.accumulate(np.where(good, place, -1)) if n else place
        doc = np.searchsorted(first, np.arange(len(starts)), "right") - 1
        if len(starts):
            starts, ends = following[starts], previous[ends - 1] + 1
        real = starts < ends
        starts, ends, doc = starts[real], ends[real], doc[real]
        self.words = (starts, ends, doc)
        size = ends - starts
        extra, extra_doc = self._spelled(buf, starts, ends, doc)
        pieces_s, pieces_n, pieces_d = [starts[(size >= SHORTEST) & (size <= LONGEST)]], [size[(size >= SHORTEST) & (size <= LONGEST)]], [doc[(size >= SHORTEST) & (size <= LONGEST)]]
        for s, length, d in zip(*(x[size > LONGEST] for x in (starts, size, doc)), strict=True):
            at = np.append(np.arange(s, s + length - LONGEST, LONGEST // 2), s + length - LONGEST)
            pieces_s.append(at)
            pieces_n.append(np.full(len(at), LONGEST))
            pieces_d.append(np.full(len(at), d))
        if len(extra):  # spelled units stand behind the block
            lengths = np.array([len(e) for e in extra])
            pieces_s.append(n + np.cumsum(lengths) - lengths)
            pieces_n.append(lengths)
            pieces_d.append(np.array(extra_doc))
            self.codes = np.concatenate([self.codes, *extra])
        self.starts, self.sizes, self.doc = (np.concatenate(x).astype(np.int64) for x in (pieces_s, pieces_n, pieces_d))
        hasher.read(self.codes.astype(np.uint8))
        self.hashes = hasher.spans(self.starts, self.starts + self.sizes)
        self.hasher = hasher

    def _spelled(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
        """Runs of single characters of one document, joined, in windows if they are long."""
        lead = (buf & 0xC0) != 0x80
        lead[:-1] &= ~((buf[:-1] == 0xCC) | (buf[:-1] == 0xCD) & (buf[1:] < 0xB0))  # combining marks belong to their letter
        before = np.concatenate([[0], np.cumsum(lead)])
        single = before[ends] - before[starts] == 1
        if not single.any():
            return [], []
        same = np.concatenate([[False], single[1:] & single[:-1] & (doc[1:] == doc[:-1]), [False]])
        begins = np.flatnonzero(~same[:-1] & same[1:])
        stops = np.flatnonzero(same[:-1] & ~same[1:])
        found, found_doc = [], []
        for a, b in zip(begins.tolist(), stops.tolist(), strict=True):
            if b - a + 1 < SHORTEST:
                continue
            run = np.concatenate([self.codes[s:e] for s, e in zip(starts[a : b + 1].tolist(), ends[a : b + 1].tolist(), strict=True)])
            last = max(len(run) - LONGEST, 0)
            windows = [*range(0, last, LONGEST // 2), last]
            found += [run[i : i + LONGEST] for i in windows]
            found_doc += [int(doc[a])] * len(windows)
        return found, found_doc

    def values(self, chosen: np.ndarray, weights: np.ndarray, table: dict) -> np.ndarray:
        """Kernel machine values of the chosen units: sums of normalised weights times their values."""
        out = np.zeros(len(chosen))
        sizes = self.sizes[chosen]
        for length in np.unique(sizes):
            own = np.flatnonzero(sizes == length)
            step = max(1, 400_000 // ((length + 2) * MOST_SPAN * 4))
            for low in range(0, len(own), step):
                some = own[low : low + step]
                codes = self.codes[self.starts[chosen[some]][:, None] + np.arange(length)]
                rows, number, share = subsequences(codes, table)
                out[some] = np.bincount(rows, share * weights[number], len(some))
        return out


class Model:
    """Value of each subsequence, bias, and the calibration of document scores."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float = 1.0, offset: float = 0.0) -> None:
        self.weights, self.bias, self.slope, self.offset = weights.astype(np.float32), bias, slope, offset

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * np.clip(margins, FLOOR, -FLOOR) + self.offset)))


def unit_vectors(units: list[str]) -> np.ndarray:
    """Dense normalised subsequence weights of a bounded list of units, as sparse rows (row, number, weight)."""
    table: dict = {}
    found = []
    for row, unit in enumerate(units):
        codes = CODE[np.frombuffer(unit.encode()[:LONGEST], np.uint8)]
        _, number, share = subsequences(codes[None, :], table)
        found.append((np.full(len(number), row), number, share))
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def intruded(unit: str) -> list[str]:
    """The unit with a sign between its letters, everywhere and at single places, and with a doubled letter."""
    inner = range(1, len(unit))
    return [".".join(unit), *(f"{unit[:i]}*{unit[i:]}" for i in inner), *(unit[:i] + unit[i - 1] + unit[i:] for i in inner)]


def train_machine(toxic: list[str], clean: list[str], extra: list[str], landmarks: list[str], rounds: int = 60) -> Model:
    """Linear machine on Nystroem features of the units, by Newton steps on the squared hinge loss."""
    mark_rows, mark_numbers, mark_shares = unit_vectors(landmarks)
    numbers, column = np.unique(mark_numbers, return_inverse=True)
    dense = np.zeros((len(landmarks), len(numbers)), np.float32)
    dense[mark_rows, column] = mark_shares
    kernel = (dense @ dense.T).astype(np.float64)
    value, vector = np.linalg.eigh(kernel)
    usable = value > 1e-6
    whiten = vector[:, usable] / np.sqrt(value[usable])  # features = kernel row @ whiten

    forms = [*toxic, *(f for unit in toxic for f in intruded(unit))]
    own = [len(toxic), len(forms) - len(toxic)]
    units = [*forms, *clean, *extra]
    kernels = []
    for low in range(0, len(units), 1000):
        some = units[low : low + 1000]
        rows, number, share = unit_vectors(some)
        at = np.minimum(np.searchsorted(numbers, number), len(numbers) - 1)
        common = numbers[at] == number
        part = np.zeros((len(some), len(numbers)), np.float32)
        part[rows[common], at[common]] = share[common]
        kernels.append(part @ dense.T)
    features = np.concatenate(kernels).astype(np.float64) @ whiten
    target = np.where(np.arange(len(units)) < len(forms), 1.0, -1.0)
    weight = np.concatenate([
        np.full(own[0], 0.35 / max(own[0], 1)), np.full(own[1], 0.15 / max(own[1], 1)),
        np.full(len(clean), 0.25 / max(len(clean), 1)), np.full(len(extra), 0.25 / max(len(extra), 1)),
    ])
    features = np.column_stack([features, np.ones(len(units))])
    held = np.full(features.shape[1], RIDGE)
    held[-1] = 1e-9  # the bias is free
    w = np.zeros(features.shape[1])
    for _ in range(rounds):
        active = target * (features @ w) < 1
        part, weighted = features[active], weight[active]
        step = np.linalg.solve((part * weighted[:, None]).T @ part + np.diag(held), part.T @ (weighted * target[active]))
        done = np.abs(step - w).max() < 1e-9
        w = 0.5 * (w + step) if not done else step
        if done:
            break
    w, b = w[:-1], w[-1]
    weights = np.zeros(ALPHABET**3)
    weights[numbers] = dense.T @ (whiten @ w)
    return Model(weights, float(b))


def _labelled_units(sample: DataFrame) -> DataFrame:
    """(unit, context, toxic) of a labelled sample of (toxic, text), once per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher(61)
        for batch in batches:
            label = np.array(batch.column(0).to_pylist(), np.int64)
            for low, _, buf, offsets in blocks(binary_column(batch, "text")):
                units = Units(hasher, buf, offsets)
                starts, ends, doc = units.words
                if not len(starts):
                    continue
                hashed = hasher.spans(starts, ends)
                same = np.concatenate([[False], doc[1:] == doc[:-1], [False]])
                context = mix(np.where(same[:-1], np.roll(hashed, 1), 0).astype(np.uint64)) + np.where(same[1:], np.roll(hashed, -1), 0).astype(np.uint64)
                size = ends - starts
                own = np.flatnonzero((size >= SHORTEST) & (size <= LONGEST))
                raw = LOWER[buf].tobytes()
                texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
                columns = [pa.array(texts, pa.string()), pa.array(context[own].astype(np.int64)), pa.array(label[low + doc[own]], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["unit", "context", "toxic"])

    return sample.select("toxic", "text").mapInArrow(run, "unit string, context bigint, toxic bigint").distinct()


class Scorer:
    """Margins of texts in one task; remembers the values of units it has seen, up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model, self.hasher, self.table = model, SpanHasher(61), {}
        self.known, self.known_value = np.zeros(0, np.uint64), np.zeros(0)

    def values(self, units: Units) -> np.ndarray:
        found, at, back = np.unique(units.hashes, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.known, found), max(len(self.known) - 1, 0))
        seen = self.known[place] == found if len(self.known) else np.zeros(len(found), bool)
        value = np.zeros(len(found))
        if len(self.known):
            value[seen] = self.known_value[place[seen]]
        value[~seen] = units.values(at[~seen], self.model.weights, self.table) + self.model.bias
        if len(self.known) + len(found) > REMEMBERED:
            self.known, self.known_value = found, value
        else:
            merged, first = np.unique(np.concatenate([self.known, found]), return_index=True)
            self.known, self.known_value = merged, np.concatenate([self.known_value, value])[first]
        return value[back]

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Of every text, the margin of its most toxic unit."""
        out = np.full(len(texts), FLOOR)
        for low, _, buf, offsets in blocks(texts, BLOCK):
            units = Units(self.hasher, buf, offsets)
            np.maximum.at(out, units.doc + low, self.values(units))
        return out


def margins(docs: DataFrame, model: Model) -> DataFrame:
    """``margin`` of every row of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.margins(binary_column(batch, "text")))], ["id", "margin"])

    return docs.mapInArrow(run, T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("margin", T.DoubleType())]))


def _calibrate(model: Model, margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
    """Logistic fit of the labels on the margins (Newton steps, lightly held back)."""
    x = np.stack([np.clip(margin, FLOOR, -FLOOR), np.ones(len(margin))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        gradient = x.T @ (weight * (p - label)) + 1e-3 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(curve, gradient)
    model.slope, model.offset = max(float(w[0]), 1e-3), float(w[1])


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample_docs: int = SAMPLE_DOCS
) -> Model:
    """Train on the labelled documents among ``docs``.

    About ``sample_docs`` documents of each label are drawn by a hash of their key, so what comes to the
    driver is bounded: their unit statistics in part, and one margin each. Rows with null labels, keys or
    texts teach nothing. Without a document of either label, every text gets the share of toxic labels.
    """
    known = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("bigint").alias("toxic")).where("id IS NOT NULL AND toxic IN (0, 1)")
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text")).where("text IS NOT NULL")
    known = known.join(texts.select("id").distinct(), "id")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        share = 1.0 if sizes.get(1) else 0.0
        return Model(np.zeros(ALPHABET**3), FLOOR, 0.0, 6.0 * (2 * share - 1))
    chance = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(103)), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.where(chance * F.when(F.col("toxic") == 1, sizes[1]).otherwise(sizes[0]) < sample_docs)
    sample = keep(texts.join(F.broadcast(drawn), "id"), "toxic-sample")

    counts = _labelled_units(sample).groupBy("unit").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    counts = keep(counts, "toxic-units")
    bad, good = counts.agg(F.sum("bad"), F.sum("good")).first()
    bad, good = max(bad or 0, 1), max(good or 0, 1)
    both = F.col("bad") + F.col("good")
    part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / (both * F.lit(share)))).otherwise(0.0)
    ratio = 2 * (part(F.col("bad"), bad / (bad + good)) + part(F.col("good"), good / (bad + good)))
    more = F.col("bad") * F.lit(float(good)) > 10 * F.col("good") * F.lit(float(bad))
    # inflected insults: significant beginnings stand for the units that begin so
    begun = counts.select(F.explode(F.array(*(F.substring("unit", 1, n) for n in STEMS))).alias("stem"), "unit", "bad", "good").where(F.length("unit") > F.length("stem"))
    stems = begun.groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where((F.col("bad") >= 3) & more).withColumn("ratio", ratio)
    stems = stems.where(F.col("ratio") >= SIGNIFICANCE).orderBy(F.desc("ratio"), "stem").limit(TOXIC_UNITS).select("stem")
    inflected = begun.join(F.broadcast(stems), "stem").where(more).select("unit").distinct().withColumn("inflected", F.lit(True))
    ranked = counts.where((F.col("bad") >= 1) & more).withColumn("ratio", ratio).join(inflected, "unit", "left")
    ranked = ranked.where((F.col("bad") >= 2) | F.col("inflected")).orderBy(F.desc("ratio"), "unit")
    sure = ranked.where((F.col("ratio") >= SIGNIFICANCE) | F.col("inflected")).limit(TOXIC_UNITS).collect()
    toxic = [r["unit"] for r in sure or ranked.limit(10).collect()]
    if not toxic:
        return Model(np.zeros(ALPHABET**3), FLOOR, 0.0, float(np.log(sizes[1] / sizes[0])))
    innocent = counts.where("good > 0").where(~F.col("unit").isin(toxic))
    clean = [r["unit"] for r in innocent.orderBy(F.xxhash64("unit"), "unit").limit(CLEAN_UNITS).collect()]
    frequent = [r["unit"] for r in innocent.orderBy(F.desc("good"), "unit").limit(LANDMARKS).collect()]
    landmarks = [*toxic[:TOXIC_LANDMARKS], *frequent]
    extra: list[str] = list(frequent)
    for _ in range(2):
        model = train_machine(toxic, clean, extra, landmarks)
        scored = margins(innocent.select(F.col("unit").alias("id"), F.col("unit").cast("binary").alias("text")), model)
        worst = scored.where("margin > -0.7").orderBy(F.desc("margin"), "id").limit(REPAIRS).collect()
        extra = sorted({*extra, *(r["id"] for r in worst)})
        landmarks = [*landmarks, *(r["id"] for r in worst[:LANDMARKS] if r["id"] not in landmarks)]
    model = train_machine(toxic, clean, extra, landmarks)
    seen = margins(sample.select(F.col("toxic").alias("id"), "text"), model).collect()  # two numbers per document of the sample
    label_of, margin = np.array([r["id"] for r in seen], float), np.array([r["margin"] for r in seen])
    share = {c: sizes[c] / max((label_of == c).sum(), 1) for c in (0, 1)}
    weight = np.where(label_of == 1, share[1], share[0])
    _calibrate(model, margin, label_of, weight / weight.mean())
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Toxicity of every row's whole text: the key, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Null, empty and wordless texts have the lowest score that the model gives. Null and repeated keys are
    rows like any other; extra columns are ignored.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    line = F.lit(model.slope) * F.greatest(F.least(F.col("margin"), F.lit(-FLOOR)), F.lit(FLOOR)) + F.lit(model.offset)
    scored = margins(rows, model).select(F.col("id").alias(key), (1 / (1 + F.exp(-line))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with all their columns."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            column = pa.RecordBatch.from_arrays([batch.column(place)], ["text"])
            yield batch.filter(pa.array(model.probability(scorer.margins(binary_column(column, "text"))) < 0.5))

    return docs.mapInArrow(run, docs.schema)
