"""Toxicity: a support vector machine on a gapped subsequence kernel with Nyström landmarks, trained on labelled sentences.

Texts are cut into sentences, and sentences into pieces of at most WORDS words (lower case, runs of single letters put
together); a piece is an instance, a text the bag of its pieces. The kernel of two pieces sums, over common subsequences
of ORDERS letters within a word and a limited span, DECAY to the power of both spans, scaled by what pieces with words
of these lengths can have at most; a word's ends count as letters, and a word with punctuation inside counts without it
as well. So `i.d.i.o.t` or `stuupid` stays close to the insult that it hides.

Only whole texts have labels, so training goes in rounds: the piece of each toxic text that the machine of the round
before rates highest is taken as toxic; all pieces of clean texts are clean, and those rated highest are learned from,
with others at random. Before the first round, pieces are rated by their subsequences' log odds between the labels.
Landmarks are taken from these pieces anew in each round, Nyström features K^-1/2 k(x, landmarks) are made of them, and a
squared-hinge machine is trained on those. As its decision is a weighted sum of kernels with landmarks, and each kernel
a product over subsequences, the weights are gathered into one table by hashed subsequence (TABLE entries): scoring a
word adds up table entries, and a piece adds up its words. A text's score is logistic in its highest decisions.

What is fitted comes from a bounded sample: the SAMPLE labelled rows with the smallest hash of their id, and of their
clean pieces HARD and RANDOM ones in each round; scoring covers whole texts. Defined results: null and empty texts
and those without letters or digits have no pieces and get the lowest score; an empty table gives an empty table;
without labels of both kinds every score is below 0.01; of several labels of one id the highest counts, ties in order
go by the text's hash; repeated rows are scored alike; a row without an id is not held out, and not learned from;
extra columns pass through, one with the result's name is replaced.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, crc_of_id, durable, schema_with, slices, table, with_columns

SAMPLE = 16_000
#: Words in a piece; rounds of training; landmarks; clean pieces that a round adds: the highest rated, and others.
WORDS, ROUNDS, LANDMARKS = 3, 3, 400
HARD, RANDOM = 4_000, 2_000
ORDERS, SPAN, DECAY = (3, 4), 6, 0.7
TABLE = 1 << 18
#: Longer words are looked at through windows of so many letters.
WINDOW = 40
KNOWN = 600_000
TOP, FLOOR = 3, -3.0
_single = re.compile(r"(?<!\S)(?:\w[ \t]+){3,}\w(?!\S)")
_inside = re.compile(r"[\W_]+")
_OFFSETS = [(j, k) for j in range(1, SPAN) for k in range(j + 1, SPAN) if k < 5] + [(i, j, k) for i in range(1, SPAN) for j in range(i + 1, SPAN) for k in range(j + 1, SPAN)]


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each between the marks 1 and 2 and with SPAN zeros behind; where each begins."""
    text = "".join(["\1" + w + "\2" + "\0" * SPAN for w in words])
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2 + SPAN
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), np.concatenate(([0], np.cumsum(sizes)[:-1]))


def subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each shape: where it fits, the table entries of the subsequences found there, and their weight."""
    for offsets in _OFFSETS:
        n = len(codes) - offsets[-1]
        at = np.flatnonzero((codes[:n] != 0) & (codes[offsets[-1] :] != 0))
        h = codes[at] * np.uint64(0x9E3779B97F4A7C15)
        for o in offsets:
            h = (h ^ (h >> np.uint64(29)) ^ codes[at + o]) * np.uint64(0xBF58476D1CE4E5B9)
        yield at, (h >> np.uint64(46)).astype(np.int64), DECAY ** (offsets[-1] + 1)


def norms(lengths: np.ndarray) -> np.ndarray:
    """The squared norms of words of these lengths whose subsequences all differ."""
    total = np.zeros(len(lengths))
    for offsets in _OFFSETS:
        total += np.maximum(lengths + 2 - offsets[-1], 0) * DECAY ** (2 * (offsets[-1] + 1))
    return np.maximum(total, 1e-9)


def trimmed(chunk: str) -> tuple[int, int]:
    """Where a chunk's first letter or digit is, and where its last one ends."""
    first, last = 0, len(chunk)
    while first < last and not chunk[first].isalnum():
        first += 1
    while last > first and not chunk[last - 1].isalnum():
        last -= 1
    return first, last


def forms(chunk: str) -> list[str]:
    """What a chunk of lower-case text is looked at as."""
    first, last = trimmed(chunk)
    word = chunk[first:last]
    if not word:
        return []
    out = [word] if len(word) <= WINDOW else [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]
    if not word.isalnum():
        bare = _inside.sub("", word)
        out += [bare] if len(bare) <= WINDOW else [bare[i : i + WINDOW] for i in range(0, len(bare) - WINDOW // 2, WINDOW // 2)]
    return [f for f in out if f]


def ends_sentence(chunk: str) -> bool:
    return any(c in ".!?" for c in chunk[trimmed(chunk)[1] :])


def chunks(text: str | None) -> list[str]:
    """Words of a text in lower case as they stand, runs of four or more single letters as one."""
    return _single.sub(lambda run: "".join(run.group().split()), text.lower()).split() if text else []


class Words:
    """Numbers the words that it meets; knows their norms and which end a sentence."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.norm, self.ends = np.zeros(0), np.zeros(0, bool)

    def numbers(self, text: str | None) -> np.ndarray:
        place = self.place
        return np.array([place.setdefault(c, len(place)) for c in chunks(text)], dtype=np.int64)

    def fresh(self) -> tuple[list[str], np.ndarray]:
        """Forms of the words met since the last call, with each one's word, counted from the first of them."""
        new = list(self.place)[len(self.norm) :]
        listed = [forms(c) for c in new]
        owner = np.repeat(np.arange(len(new)), [len(x) for x in listed])
        flat = [f for x in listed for f in x]
        self.norm = np.concatenate((self.norm, np.bincount(owner, norms(np.array([len(f) for f in flat])), len(new))))
        self.ends = np.concatenate((self.ends, np.array([ends_sentence(c) for c in new], dtype=bool)))
        return flat, owner

    def pieces(self, at: np.ndarray) -> np.ndarray:
        """Where pieces of a text's words begin."""
        ends = self.ends[at]
        sentence = np.cumsum(ends) - ends
        first = np.concatenate(([0], np.flatnonzero(ends) + 1))[sentence]
        return np.flatnonzero((np.arange(len(at)) - first) % WORDS == 0)


def summed(flat: list[str], owner: np.ndarray, n: int, table: np.ndarray) -> np.ndarray:
    """For each word the weighted sum of its subsequences' rows of the table (TABLE entries, of one number or several)."""
    out = np.zeros((n, *table.shape[1:]), np.float32)
    step = 20_000 if table.ndim == 1 else 2_000
    for i in range(0, len(flat), step):
        codes, begins = letters(flat[i : i + step])
        total = np.zeros((len(codes), *table.shape[1:]), np.float32)
        for at, entry, weight in subsequences(codes):
            total[at] += np.float32(weight) * table[entry]
        np.add.at(out, owner[i : i + step], np.add.reduceat(total, begins))
    return out


class Machine:
    """The fitted table and the logistic weights; some MB whatever the data."""

    def __init__(self, weights: np.ndarray, bias: float, logistic: np.ndarray):
        self.weights, self.bias, self.logistic = weights.astype(np.float32), bias, logistic
        self.name = uuid.uuid4().hex

    def score(self, tops: np.ndarray) -> np.ndarray:
        z = np.hstack([tops, np.ones((len(tops), 1))]) @ self.logistic
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Scorer:
    """Rates the pieces of texts; keeps the words that it has met with their sums."""

    def __init__(self, machine: Machine):
        self.machine, self.words, self.raw = machine, Words(), np.zeros(0, np.float32)

    def rated(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text its words' numbers, where its pieces begin, and their decisions."""
        if len(self.words.place) > KNOWN:
            self.words, self.raw = Words(), np.zeros(0, np.float32)
        numbered = [self.words.numbers(t) for t in texts]
        flat, owner = self.words.fresh()
        self.raw = np.concatenate((self.raw, summed(flat, owner, len(self.words.norm) - len(self.raw), self.machine.weights)))
        for at in numbered:
            begins = self.words.pieces(at) if len(at) else at
            if not len(at):
                yield at, begins, np.zeros(0)
                continue
            norm = np.add.reduceat(self.words.norm[at], begins)
            value = np.add.reduceat(self.raw[at].astype(np.float64), begins) / np.sqrt(np.maximum(norm, 1e-9)) + self.machine.bias
            yield at, begins, np.where(norm > 0, value, FLOOR)

    def tops(self, texts: list[str | None]) -> np.ndarray:
        """The TOP highest different decisions in each text, at least FLOOR."""
        out = np.full((len(texts), TOP), FLOOR)
        for i, (_, _, value) in enumerate(self.rated(texts)):
            best = np.unique(value)[::-1][:TOP]
            out[i, : len(best)] = np.maximum(best, FLOOR)
        return out


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 1.5, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton's method on the rows inside the margin, some rows at a time."""
    n, step = x.shape[1] + 1, 2048
    w, ridge = np.zeros(n), np.eye(n)
    ridge[-1, -1] = 1e-3
    for _ in range(rounds):
        left, right = ridge.copy(), np.zeros(n)
        for k in range(0, len(x), step):
            a, t = np.hstack([x[k : k + step].astype(np.float64), np.ones((len(x[k : k + step]), 1))]), y[k : k + step]
            inside = t * (a @ w) < 1
            b, scaled = a[inside], a[inside] * (c * weight[k : k + step][inside])[:, None]
            left += scaled.T @ b
            right += scaled.T @ t[inside]
        new = np.linalg.solve(left, right)
        if np.allclose(new, w, atol=1e-6):
            break
        w = 0.5 * w + 0.5 * new
    return w[:-1], float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> np.ndarray:
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(a @ w)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-6)[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _odds(rows: DataFrame, bad: int, good: int) -> np.ndarray:
    """Each table entry's log odds between toxic and clean texts; less for those that few texts have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, TABLE), np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                listed = [f for c in set(chunks(text)) for f in forms(c)]
                if listed:
                    codes, _ = letters(listed)
                    counts[toxic, np.unique(np.concatenate([entry for _, entry, _ in subsequences(codes)]))] += 1
        used = np.flatnonzero(counts.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[0, used]), pa.array(counts[1, used])], names=["entry", "clean", "toxic"])

    sums = rows.mapInArrow(run, "entry long, clean long, toxic long").groupBy("entry").agg(F.sum("clean"), F.sum("toxic"))
    clean, toxic = np.zeros(TABLE), np.zeros(TABLE)
    found = sums.toArrow()  # TABLE rows at most
    entry, c, t = (x.to_numpy() for x in found.columns)
    clean[entry], toxic[entry] = c, t
    odds = np.clip(np.log((toxic + 1) / (bad + 2)) - np.log((clean + 1) / (good + 2)), -3, 3)
    return odds * np.minimum(1, (toxic + clean) / (0.02 * bad + 1))


def _witnesses(rows: DataFrame, machine: Machine, seed: int) -> DataFrame:
    """(toxic, kind, piece, value): the highest piece of each text (kind 0) and one at random of each clean one (kind 1)."""
    model = rows.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                found = []
                texts, toxic = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
                for text, mark, (at, begins, value) in zip(texts, toxic, scorer.rated(texts), strict=True):
                    if not len(value):
                        continue
                    spelled, edges = chunks(text), [*begins.tolist(), len(at)]
                    best = int(value.argmax())
                    other = (len(text) * 7919 + seed * 104729) % len(value)
                    found += [(mark, kind, " ".join(spelled[edges[k] : edges[k + 1]]), float(value[k])) for kind, k in ((0, best), (1, other))[: 2 - mark]]
                cols = list(zip(*found, strict=True)) if found else [[]] * 4
                kinds = [pa.int32(), pa.int32(), pa.string(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["toxic", "kind", "piece", "value"])

    return rows.select("text", "toxic").mapInArrow(run, "toxic int, kind int, piece string, value double")


def _fitted(positive: list[str], negative: list[str], most: int) -> tuple[np.ndarray, float]:
    """Table and bias of the machine trained on these pieces; the first of each list are the landmarks."""
    pieces = positive + negative
    words = Words()
    numbered = [words.numbers(p) for p in pieces]
    flat, owner = words.fresh()
    distinct = list(dict.fromkeys(positive))[:most]
    others = list(dict.fromkeys(negative))
    others = others[:: max(1, len(others) // max(50, len(distinct)))][: max(50, len(distinct))]
    where = {p: i for i, p in enumerate(pieces)}
    chosen = [numbered[where[p]] for p in distinct + others]
    length = lambda at: float(np.sqrt(max(words.norm[at].sum(), 1e-9)))
    listed: list[list[str]] = [[] for _ in range(len(words.norm))]
    for f, o in zip(flat, owner.tolist(), strict=True):
        listed[o].append(f)
    entries = []
    for j, at in enumerate(chosen):
        codes, _ = letters([f for w in at.tolist() for f in listed[w]])
        entries += [(entry, j, weight / length(at)) for _, entry, weight in subsequences(codes)]
    columns = np.unique(np.concatenate([e for e, _, _ in entries]))
    small = np.zeros((len(columns) + 1, len(chosen)), np.float32)
    for entry, j, weight in entries:
        np.add.at(small[:, j], np.searchsorted(columns, entry), np.float32(weight))
    place = np.full(TABLE, len(columns), np.int32)
    place[columns] = np.arange(len(columns))
    by_word = summed_at(flat, owner, len(words.norm), place, small)
    kernel = np.empty((len(pieces), len(chosen)), np.float32)
    for i, at in enumerate(numbered):
        kernel[i] = by_word[at].sum(axis=0) / length(at)
    del by_word
    gram = kernel[[where[p] for p in distinct + others]].astype(np.float64)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    weight = np.where(y > 0, 0.5 * len(negative) / len(positive), 1.0)
    for k in range(0, len(kernel), 2048):
        kernel[k : k + 2048] = kernel[k : k + 2048] @ root
    w, bias = train(kernel, y, weight / weight.mean())
    weights = np.zeros(TABLE)
    weights[columns] = small[:-1] @ (root @ w).astype(np.float32)
    return weights, bias


def summed_at(flat: list[str], owner: np.ndarray, n: int, place: np.ndarray, small: np.ndarray, step: int = 500) -> np.ndarray:
    """summed() over a table of which only some rows are kept."""
    out = np.zeros((n, small.shape[1]), np.float32)
    for i in range(0, len(flat), step):
        codes, begins = letters(flat[i : i + step])
        total = np.zeros((len(codes), small.shape[1]), np.float32)
        for at, entry, weight in subsequences(codes):
            to = place[entry]
            known = to < len(small) - 1
            total[at[known]] += np.float32(weight) * small[to[known]]
        np.add.at(out, owner[i : i + step], np.add.reduceat(total, begins))
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> Machine:
    """A machine from (doc_id, text) and (doc_id, toxic): the rows to learn from, already restricted."""
    spark = docs.sparkSession
    bounded_batches(spark)
    marked = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    joined = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = durable(joined.orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(sample).select("text", (F.col("toxic") > 0).cast("int").alias("toxic")).repartition(8 * spark.sparkContext.defaultParallelism))
    n = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        return Machine(np.zeros(TABLE), -1.0, np.array([0.0] * TOP + [-5.0]))
    machine = Machine(_odds(rows, bad, good), 0.0, np.zeros(TOP + 1))
    negative: dict[str, None] = {}
    for r in range(rounds):
        found = durable(_witnesses(rows, machine, r))
        positive = [x[0] for x in found.where("toxic = 1").orderBy(F.desc("value"), "piece").select("piece").collect()]  # one of each toxic row
        clean = found.where("toxic = 0")
        hard = clean.where("kind = 0").groupBy("piece").agg(F.max("value").alias("value")).orderBy(F.desc("value"), "piece").limit(HARD)
        others = clean.where("kind = 1").select("piece").distinct().orderBy(F.xxhash64("piece"), "piece").limit(RANDOM)
        negative |= dict.fromkeys(x[0] for x in hard.select("piece").union(others).collect())
        if not positive or not negative:
            break
        task = spark.sparkContext.parallelize([(positive, list(negative), LANDMARKS // 2)], 1)  # as the driver's memory is shared by all stages
        [(weights, bias)] = task.map(lambda pieces: _fitted(*pieces)).collect()
        machine = Machine(weights, bias, machine.logistic)
    tops = scored(rows.select("text", "toxic"), machine, raw=True).select("tops", "toxic").collect()  # SAMPLE rows at most
    return Machine(machine.weights, machine.bias, logistic(np.array([r[0] for r in tops]), np.array([float(r[1]) for r in tops])))


_scorers: dict[str, Scorer] = {}


def scored(df: DataFrame, machine: Machine, text: str = "text", result: str = "score", raw: bool = False) -> DataFrame:
    """Adds the score (or `tops`, the highest decisions) of each whole text."""
    bounded_batches(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(machine)
    key = machine.name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(model.value)
        scorer = _scorers[key]
        for whole in batches:
            for batch in slices(whole, text):
                tops = scorer.tops(batch.column(text).to_pylist())
                more = {"tops": pa.array(tops.tolist(), pa.list_(pa.float64()))} if raw else {result: pa.array(scorer.machine.score(tops))}
                yield with_columns(batch, **more)

    return df.mapInArrow(run, schema_with(df, **({"tops": T.ArrayType(T.DoubleType())} if raw else {result: T.DoubleType()})))


def learned(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Machine:
    """Fitted on the labelled rows that are not held out."""
    taught = crc_of_id() % 4 != 2
    return fit(docs.where(taught), labels.where(taught))


def op10_toxicity(spark: SparkSession, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = learned(spark, docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(crc_of_id() % 4 == 2, F.lit(False))
    return scored(docs, machine).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
