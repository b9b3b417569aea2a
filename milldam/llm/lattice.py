"""Language-model scores: subword lattice likelihood.

The pieces of an existing subword vocabulary, each with a log probability, make a lattice of every word: all
its segmentations. The forward recursion in log space sums over them, so a word's score is its marginal
probability, and a text's is the product over its words and one end. The vocabulary's own scores are the start;
they are fitted to the training texts by expectation and maximisation, over the counts of all distinct words.

Corpus statistics are tables: word counts are summed up in Spark and never gathered; the driver gets one number
for each piece of the vocabulary. For scoring, texts are dealt into blocks of bounded size; each block asks for
the figures of its own distinct words by a join, and scores its texts with them.

Defined results: null and empty texts are the end alone; words of any length are fitted and scored whole; repeated rows
are scored alike and count as often as they occur; a row without an id is learned from; without any training text every
count is 0; an empty table gives an empty table; ids keep their type, and extra columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import bounded_batches, crc_of_id, durable, table

#: Bytes of text in a block, about, and distinct words that a task counts before it passes them on.
BLOCK_BYTES, HELD_WORDS = 12 << 20, 400_000
ROUNDS = 2
#: Words of more letters go through the recursion one by one.
LONG = 160
MARK = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SLOTS = 1 << 18


def words(text: str | None) -> list[bytes]:
    """bytes.lower and bytes.split know ASCII only, as is meant."""
    return text.encode().lower().split() if text else []


class Pieces:
    """A vocabulary of pieces with log probabilities, and a hash table of their spellings."""

    def __init__(self, spelled: list[str], logs: np.ndarray, end: float):
        self.spelled, self.logs, self.end = spelled, logs, end
        self.index = {p: i for i, p in enumerate(spelled)}
        self.most = max(map(len, spelled))
        self.bytes_at = len(spelled)  # the 256 single bytes come after the pieces
        self.keys, self.values = np.zeros(_SLOTS, np.uint64), np.full(_SLOTS, -1, np.int64)
        for i, p in enumerate(spelled):
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in p:
                    h = h * _BASE + np.uint64(ord(c))
                key = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            slot = int(key >> np.uint64(46))
            while self.values[slot] >= 0:
                slot = (slot + 1) % _SLOTS
            self.keys[slot], self.values[slot] = key, i

    @staticmethod
    def start(path: str) -> "Pieces":
        """From a sentencepiece file; its scores are ranks, taken as Zipf's weights."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        weight = 1 / (np.array([-sp.get_score(i) for i in plain]) + 3.0)
        logs = np.log(np.concatenate((0.98 * weight / weight.sum(), np.full(256, 0.01 / 256))))
        return Pieces([sp.id_to_piece(i) for i in plain], logs, math.log(0.01))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece with that spelling's hash, or -1."""
        key = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        slot = (key >> np.uint64(46)).astype(np.int64)
        out = np.where(self.keys[slot] == key, self.values[slot], -1)
        open_ = np.flatnonzero((out < 0) & (self.values[slot] >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % _SLOTS
            s = slot[open_]
            hit = (self.keys[s] == key[open_]) & (self.values[s] >= 0)
            out[open_[hit]] = self.values[s[hit]]
            open_ = open_[~hit & (self.values[s] >= 0)]
        return out

    def spare(self, letter: str) -> float:
        """The log probability of a letter that is no piece: that of its bytes."""
        return float(sum(self.logs[self.bytes_at + b] for b in letter.encode("utf-8", "surrogatepass")))

    def arcs(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For equally long rows of code points and each length: the pieces at every start (-1: none) and their logs."""
        n, width = codes.shape
        prefix = np.zeros((n, width + 1), np.uint64)
        for i in range(width):
            prefix[:, i + 1] = prefix[:, i] * _BASE + codes[:, i]
        out, power = [], _BASE
        for k in range(1, min(self.most, width) + 1):
            with np.errstate(over="ignore"):
                ids = self.find((prefix[:, k:] - prefix[:, :-k] * power).ravel()).reshape(n, width - k + 1)
                power = power * _BASE
            logs = np.where(ids >= 0, self.logs[ids], -np.inf)
            if k == 1 and (ids < 0).any():
                missing = ids < 0
                kinds, back = np.unique(codes[missing], return_inverse=True)
                logs[missing] = np.array([self.spare(chr(int(c))) for c in kinds])[back]
            out.append((ids, logs))
        return out

    def forward(self, arcs: list, n: int, width: int) -> np.ndarray:
        alpha = np.full((n, width + 1), -np.inf)
        alpha[:, 0] = 0
        for i in range(1, width + 1):
            terms = [alpha[:, i - k] + arcs[k - 1][1][:, i - k] for k in range(1, min(i, len(arcs)) + 1)]
            alpha[:, i] = terms[0] if len(terms) == 1 else np.logaddexp.reduce(terms, axis=0)
        return alpha

    def groups(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of equally long words, some thousand at a time, with their code points, the mark before each."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(texts):
            by_length.setdefault(len(w), []).append(i)
        for width, at in by_length.items():
            step = max(1, min(4096, 400_000 // (width + 1)))
            for k in range(0, len(at), step):
                part = at[k : k + step]
                joined = "".join([MARK + texts[i] for i in part])
                yield np.array(part), np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64).reshape(len(part), width + 1)

    def marginal(self, texts: list[str]) -> np.ndarray:
        """Natural log of each word's probability over all segmentations."""
        out = np.zeros(len(texts))
        for at, codes in self.groups(texts):
            if codes.shape[1] > LONG:
                out[at] = [self.one(MARK + texts[i])[-1] for i in at.tolist()]
            else:
                out[at] = self.forward(self.arcs(codes), *codes.shape)[:, -1]
        return out

    def one(self, word: str) -> list[float]:
        """The recursion over a single long word."""
        alpha = [0.0]
        for i in range(1, len(word) + 1):
            terms = []
            for k in range(1, min(i, self.most) + 1):
                p = self.index.get(word[i - k : i], -1)
                if p >= 0:
                    terms.append(alpha[i - k] + float(self.logs[p]))
                elif k == 1:
                    terms.append(alpha[i - 1] + self.spare(word[i - 1]))
            top = max(terms)
            alpha.append(top + math.log(sum(math.exp(t - top) for t in terms)))
        return alpha

    def use(self, word: str, count: float, total: np.ndarray) -> None:
        """Adds how often a single long word uses each piece and byte, over all its segmentations."""
        alpha, n = self.one(word), len(word)
        beta = [0.0] * (n + 1)  # log probability of what stands behind a place
        for i in range(n - 1, -1, -1):
            terms = []
            for k in range(1, min(n - i, self.most) + 1):
                p = self.index.get(word[i : i + k], -1)
                if p >= 0:
                    terms.append((p, k, float(self.logs[p]) + beta[i + k]))
                elif k == 1:
                    terms.append((-1, 1, self.spare(word[i]) + beta[i + 1]))
            top = max(t for _, _, t in terms)
            beta[i] = top + math.log(sum(math.exp(t - top) for _, _, t in terms))
            for p, _, t in terms:
                used = count * math.exp(alpha[i] + t - alpha[n])
                if p >= 0:
                    total[p] += used
                else:
                    for b in word[i].encode("utf-8", "surrogatepass"):
                        total[self.bytes_at + b] += used

    def expected(self, texts: list[str], counts: np.ndarray) -> np.ndarray:
        """How often each piece (and byte) is used over all segmentations of the words, by their counts."""
        total = np.zeros(len(self.logs))
        for at, codes in self.groups(texts):
            n, width = codes.shape
            if width > LONG:
                for i in at.tolist():
                    self.use(MARK + texts[i], float(counts[i]), total)
                continue
            arcs = self.arcs(codes)
            alpha = self.forward(arcs, n, width)
            beta = np.full((n, width + 1), -np.inf)
            beta[:, width] = 0
            for i in range(width - 1, -1, -1):
                terms = [beta[:, i + k] + arcs[k - 1][1][:, i] for k in range(1, min(width - i, len(arcs)) + 1)]
                beta[:, i] = terms[0] if len(terms) == 1 else np.logaddexp.reduce(terms, axis=0)
            whole, c = alpha[:, -1:], counts[at][:, None]
            for k, (ids, logs) in enumerate(arcs, 1):
                r, s = np.nonzero(ids >= 0)
                use = np.exp(alpha[r, s] + logs[r, s] + beta[r, s + k] - whole[r, 0]) * c[r, 0]
                total[: self.bytes_at] += np.bincount(ids[r, s], use, self.bytes_at)
                if k == 1 and (ids < 0).any():
                    r, s = np.nonzero(ids < 0)
                    use = np.exp(alpha[r, s] + logs[r, s] + beta[r, s + 1] - whole[r, 0]) * c[r, 0]
                    for code, u in zip(codes[r, s].tolist(), use.tolist(), strict=True):
                        for b in chr(code).encode("utf-8", "surrogatepass"):
                            total[self.bytes_at + b] += u
        return total

    def fitted(self, total: np.ndarray, ends: int) -> "Pieces":
        """Relative frequencies with a little for what was not seen."""
        total = total + 0.05
        whole = total.sum() + ends + 0.5
        return Pieces(self.spelled, np.log(total / whole), math.log((ends + 0.5) / whole))


def word_counts(docs: DataFrame) -> DataFrame:
    """(text, taught) -> (word, c): distinct words of all texts with their number in the taught ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taught: Counter = Counter()
        other: set = set()

        def out() -> pa.RecordBatch:
            rest = [w for w in other if w not in taught]
            return pa.RecordBatch.from_arrays([pa.array([*taught, *rest], pa.binary()).cast(pa.string()), pa.array([*taught.values(), *[0] * len(rest)], pa.int64())], names=["word", "c"])

        for batch in batches:
            for text, mine in zip(batch.column("text").to_pylist(), batch.column("taught").to_pylist(), strict=True):
                (taught if mine else other).update(words(text))
            if len(taught) + len(other) > HELD_WORDS:
                yield out()
                taught.clear()
                other.clear()
        yield out()

    return docs.select("text", "taught").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def fit(counts: DataFrame, ends: int, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Expectation and maximisation over all distinct taught words; each round sends one number a piece to the driver."""
    spark = counts.sparkSession
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(pieces)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(now.value.logs))
            for batch in batches:
                total += now.value.expected(batch.column("word").to_pylist(), batch.column("c").to_numpy(zero_copy_only=False).astype(float))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["piece", "n"])

        sums = counts.where("c > 0").select("word", "c").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        total = np.zeros(len(pieces.logs))
        for r in sums:
            total[r[0]] = r[1]
        pieces = pieces.fitted(total, ends)
    return pieces


def score(docs: DataFrame, path: str, taught: str = "taught") -> DataFrame:
    """(doc_id, text, taught) -> doc_id, taught, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", "text", F.coalesce(F.col(taught), F.lit(False)).alias("taught"))
    size, ends = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if("taught")).first()
    counts = durable(word_counts(docs))
    tokens, distinct = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, distinct = tokens + ends, distinct + (ends > 0)
    pieces = fit(counts, ends, Pieces.start(path))
    model = spark.sparkContext.broadcast(pieces)

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = model.value.marginal(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(logs / math.log(10))], names=["word", "c", "log"])

    figures = counts.mapInArrow(valued, "word string, c long, log double")
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(blocks)).cast("int")).repartition(max(blocks, 1), "block")

    def spelling(texts: pa.Table) -> list[bytes]:
        found: set = set()
        for text in texts.column("text").to_pylist():
            found.update(words(text))
        return sorted(found)

    def asked(texts: pa.Table) -> pa.Table:
        found = spelling(texts)
        block = texts.column("block")[0].as_py()
        return pa.table({"block": pa.array([block] * len(found), pa.int32()), "word": pa.array(found, pa.binary()).cast(pa.string()), "at": pa.array(range(len(found)), pa.int32())})

    # both uses of `dealt` read all its columns, so that its exchange is made once
    wanted = dealt.groupBy("block").applyInArrow(asked, "block int, word string, at int")
    answers = wanted.join(figures, "word").select("block", "at", "c", "log")
    bottom, end_log = tokens + 0.5 * (distinct + 1), pieces.end / math.log(10)

    def sums(texts: pa.Table, answer: pa.Table) -> pa.Table:
        spelled = spelling(texts)
        place = dict(zip(spelled, range(len(spelled)), strict=True))
        c, logs = np.zeros(len(spelled), np.int64), np.zeros(len(spelled))
        at = answer.column("at").to_numpy()
        c[at], logs[at] = answer.column("c").to_numpy(), answer.column("log").to_numpy()
        base = np.log10((c + 0.5) / bottom)
        rows = []
        for text in texts.column("text").to_pylist():
            at = np.array(list(map(place.__getitem__, words(text))), dtype=np.int64)
            rows.append((len(at) + 1, int((c[at] > 0).sum()) + (ends > 0), float(base[at].sum()) + math.log10((ends + 0.5) / bottom), float(logs[at].sum()) + end_log))
        cols = list(zip(*rows, strict=True))
        n = len(rows)
        return pa.table({
            "doc_id": texts.column("doc_id"), "taught": texts.column("taught"),
            "n_tokens": pa.array(cols[0], pa.int64()), "n_known": pa.array(cols[1], pa.int64()), "train_tokens": pa.array([tokens] * n, pa.int64()),
            "base_score": pa.array(cols[2], pa.float64()), "score": pa.array(cols[3], pa.float64()),
        }) if n else schema.empty_table()

    of_id = docs.schema["doc_id"]
    schema = pa.schema([("doc_id", to_arrow_type(of_id.dataType)), ("taught", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(sums, T.StructType([of_id, *T._parse_datatype_string("taught boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").fields]))


def op7_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(crc_of_id() % 5 != 1, F.lit(True)).alias("taught"))
    return score(docs, public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", (~F.col("taught")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
