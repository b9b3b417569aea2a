"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

Test items are cut into parts of at most PART words, and the parts are indexed: an inverted index whose
postings come in blocks with their highest impact. Each training text is cut into overlapping passages, and each
passage is a query. What is retrieved is every part whose score is at least RETRIEVE of the score that the part
would give itself. Each part's commonest words, up to COMMON of its threshold, are set aside: a passage that has less
than the rest from the part's other words cannot reach the threshold. So passages are first summed up over these
short postings, all of a text at once; those that some part may be retrieved for go through block-max WAND. For retrieved items the overlap of question (all but the last sentence) and answer (the last
one) with the text around the passage is verified by runs of three words: each of the two, or the whole item, must reach
OVERLAP. So a copy that lacks the answer, or has a word of a short answer edited, is verified by the whole item.

The items are broadcast in blocks of bounded size, and all texts query each block; item statistics are taken over
all items. Defined results: null and empty texts and items match nothing; an item of fewer than three words is
verified as a whole; of several passages with an item the best counts, of equal ones the first; repeated rows match
alike; whole texts are searched, whatever their length; an empty table on either side gives an empty one; ids keep
their types; extra columns are left out.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import bounded_batches, durable, slices, table

PASSAGE, STRIDE, PART = 64, 32, 32
RETRIEVE, OVERLAP, COMMON = 0.6, 0.5, 0.5
K1, B = 1.2, 0.75
#: Postings in a block of the index; bytes and number of items that are broadcast at once.
POSTINGS, ITEM_BYTES, ITEMS = 64, 16 << 20, 50_000
KNOWN = 500_000
_sentence = re.compile(r"(?<=[.!?])\s+")


def term(chunk: str) -> str:
    """A chunk of lower-case text without punctuation around."""
    first, last = 0, len(chunk)
    while first < last and not chunk[first].isalnum():
        first += 1
    while last > first and not chunk[last - 1].isalnum():
        last -= 1
    return chunk[first:last]


def terms(text: str | None) -> list[str]:
    return [t for t in map(term, text.lower().split()) if t] if text else []


def grams(ids: list[int]) -> list[tuple]:
    return [tuple(ids[i : i + 3]) for i in range(max(1, len(ids) - 2))] if ids else []


def parts(words: list) -> list[list]:
    """A text's words in parts of PART; a last one of less than half of that is filled up from those before."""
    out = [words[k : k + PART] for k in range(0, len(words), PART)]
    if len(out) > 1 and len(out[-1]) < PART // 2:
        out[-1] = words[-PART:]
    return out


class Index:
    """A block of items: postings with block maxima, and what verification needs."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n: int, mean: float):
        self.name = uuid.uuid4().hex
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for _, text in items for t in terms(text)}))}
        idf = np.zeros(len(self.vocabulary) + 1)
        for t, i in self.vocabulary.items():
            d = df.get(t, 1)
            idf[i] = math.log(1 + (n - d + 0.5) / (d + 0.5))
        self.ids = [i for i, _ in items]
        self.question, self.answer, self.whole, self.owner = [], [], [], []
        lists: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        self.least: list[float] = []
        needed: list[list[tuple[int, float]]] = [[] for _ in range(len(self.vocabulary) + 1)]
        for at, (_, text) in enumerate(items):
            sentences = [s for s in _sentence.split(text.strip()) if terms(s)]
            spelled = [[self.vocabulary[t] for t in terms(s)] for s in sentences]
            whole = [i for s in spelled for i in s]
            asked, told = [i for s in spelled[:-1] for i in s], spelled[-1]
            self.question.append(grams(asked if len(asked) > 2 else whole))
            self.answer.append(grams(told if len(told) > 2 else whole))
            self.whole.append(grams(whole))
            for part in parts(whole):
                impact = {i: idf[i] * c * (K1 + 1) / (c + K1 * (1 - B + B * len(part) / mean)) for i, c in Counter(part).items()}
                least = RETRIEVE * sum(impact.values())
                aside, rest = 0.0, []
                for i in sorted(impact, key=lambda i: (idf[i], i)):
                    lists[i].append((len(self.owner), impact[i]))
                    if aside + impact[i] <= COMMON * least:
                        aside += impact[i]
                    else:
                        rest.append(i)
                for i in rest:
                    needed[i].append((len(self.owner), impact[i] / (least - aside)))
                self.owner.append(at)
                self.least.append(least)
        self.begins = np.concatenate(([0], np.cumsum([len(x) for x in needed])))
        self.part = np.array([p for x in needed for p, _ in x], dtype=np.int64)
        self.share = np.array([s for x in needed for _, s in x])
        self.postings = [([p for p, _ in x], [s for _, s in x]) for x in lists]
        self.blocks = [([p[min(k + POSTINGS, len(p)) - 1] for k in range(0, len(p), POSTINGS)], [max(s[k : k + POSTINGS]) for k in range(0, len(s), POSTINGS)]) for p, s in self.postings]
        self.highest = [max(s, default=0.0) for _, s in self.postings]
        self.lowest = min(self.least, default=math.inf)

    def retrieve(self, query: set[int]) -> list[tuple[int, float]]:
        """Block-max WAND: all parts whose score reaches their own threshold. Thresholds differ, so the pivot uses the lowest."""
        cursors = [[self.postings[t][0][0], 0, 0, t] for t in query]  # next part, its place, its block, term
        found, goal = [], self.lowest - 1e-9
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += self.highest[c[3]]
                if bound >= goal:
                    pivot = i
                    break
            if pivot < 0:
                break
            part = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == part:
                pivot += 1
            bound, border = 0.0, math.inf
            for c in cursors[: pivot + 1]:
                lasts, highs = self.blocks[c[3]]
                while lasts[c[2]] < part and c[2] + 1 < len(lasts):
                    c[2] += 1
                bound += highs[c[2]]
                border = min(border, lasts[c[2]])
            if bound >= goal:
                if cursors[0][0] == part:
                    total = sum(self.postings[c[3]][1][c[1]] for c in cursors[: pivot + 1])
                    if total >= self.least[part] - 1e-9:
                        found.append((part, total))
                target, moved = part + (cursors[0][0] == part), cursors[: pivot + 1]
            else:
                rest = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf
                target, moved = max(part + 1, min(border + 1, rest)), cursors[: pivot + 1]
            for c in moved:
                places = self.postings[c[3]][0]
                while c[1] < len(places) and places[c[1]] < target:
                    c[1] += 1
                c[0] = places[c[1]] if c[1] < len(places) else math.inf
                c[2] = min(c[1] // POSTINGS, len(self.blocks[c[3]][0]) - 1)
            cursors = [c for c in cursors if c[0] < math.inf]
        return found


class Finder:
    """Looks for the items of one index in texts; keeps the index words of the chunks that it has met."""

    def __init__(self, index: Index):
        self.index, self.known = index, {}

    def ids(self, text: str) -> np.ndarray:
        chunks = text.lower().split()
        known = self.known
        try:
            out = list(map(known.__getitem__, chunks))
        except KeyError:
            if len(known) > KNOWN:
                known.clear()
            get, none = self.index.vocabulary.get, len(self.index.vocabulary)
            for c in chunks:
                if c not in known:
                    t = term(c)
                    known[c] = get(t, none) if t else -1
            out = list(map(known.__getitem__, chunks))
        ids = np.array(out, dtype=np.int64)
        return ids[ids >= 0] if len(ids) else ids

    def passages(self, ids: np.ndarray) -> list[int]:
        """Passages in which some part's needed words may be enough; a repeated word counts each time, which only adds."""
        x, most = self.index, 1 << 14
        out: set[int] = set()
        for i in range(0, len(ids), most):
            some = ids[i : i + most + STRIDE]
            sizes = x.begins[some + 1] - x.begins[some]
            at = np.repeat(x.begins[some] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            if not len(at):
                continue
            strip = np.repeat(np.arange(len(some)) // STRIDE, sizes)
            key, back = np.unique(x.part[at] * (most + 2) + strip, return_inverse=True)
            have = np.bincount(back, x.share[at])
            follows = np.zeros(len(key))
            follows[:-1] = np.where(key[1:] == key[:-1] + 1, have[1:], 0)
            before = np.zeros(len(key))
            before[1:] = np.where(key[1:] == key[:-1] + 1, have[:-1], 0)
            strips = key % (most + 2)
            out.update((strips[have + follows >= 1 - 1e-9] + i // STRIDE).tolist())
            out.update((strips[(have + before >= 1 - 1e-9) & (strips > 0)] - 1 + i // STRIDE).tolist())
        last = max(0, -(-(len(ids) - PASSAGE) // STRIDE))
        return sorted({min(k, last) for k in out})

    def find(self, text: str | None) -> list[tuple[int, float, float, float, float, int]]:
        """(item's place, score, overlap of question, answer and whole item, first word of the passage), the best of each item."""
        x = self.index
        ids = self.ids(text) if text else np.zeros(0, np.int64)
        if not len(ids) or not x.owner:
            return []
        best: dict[int, tuple] = {}
        none = len(x.vocabulary)
        for k in self.passages(ids):
            i, j = k * STRIDE, min(k * STRIDE + PASSAGE, len(ids))
            for part, score in x.retrieve(set(ids[i:j].tolist()) - {none}):
                item = x.owner[part]
                span = len(x.question[item]) + len(x.answer[item]) + PASSAGE
                near = set(grams(ids[max(0, i - span) : j + span].tolist()))
                asked, told, both = ([sum(g in near for g in gs) / len(gs) for gs in (x.question[item], x.answer[item], x.whole[item])])
                if (min(asked, told) >= OVERLAP or both >= OVERLAP) and (item not in best or score > best[item][1]):
                    best[item] = (item, score, asked, told, both, i)
        return list(best.values())


def average(items: DataFrame) -> float:
    """The mean number of words in the parts of all items."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [len(p) for t in batch.column("text").to_pylist() for p in parts(terms(t))]
            yield pa.RecordBatch.from_arrays([pa.array([len(cut)], pa.int64()), pa.array([sum(cut)], pa.int64())], names=["n", "words"])

    n, words = items.select("text").mapInArrow(sizes, "n long, words long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    return words / n if n else float(PART)


def indexes(items: DataFrame) -> list[Index]:
    """The items in blocks; only one block at a time is on the driver before it is broadcast."""
    items = durable(items.where("text is not null").select("item_id", "text"))
    size, n = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    blocks = max(1, math.ceil(size / ITEM_BYTES), math.ceil(n / ITEMS))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(b, t, 1) for b, text in zip(batch.column("block").to_pylist(), batch.column("text").to_pylist(), strict=True) for t in set(terms(text))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["block", "term"])

    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("long"))
    listed = dealt.mapInArrow(distinct, "block long, term string").groupBy("block", "term").agg(F.count("*").alias("n"))
    frequency = durable(listed.join(listed.groupBy("term").agg(F.sum("n").alias("df")), "term").select("block", "term", "df"))
    mean = average(items)
    for b in range(blocks):
        rows = [(r[0], r[1]) for r in dealt.where(F.col("block") == b).select("item_id", "text").sort("item_id", "text").collect() if terms(r[1])]
        yield Index(rows, {r[0]: r[1] for r in frequency.where(F.col("block") == b).select("term", "df").collect()}, n, mean)


_finders: dict[str, Finder] = {}


def contamination(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, item_id, bm25, question_overlap, answer_overlap, item_overlap, first_word) of every verified match."""
    spark = docs.sparkSession
    bounded_batches(spark)
    slim, of_item = docs.select("doc_id", F.col(text).alias("text")), to_arrow_type(items.schema["item_id"].dataType)

    def matches(index: Index) -> DataFrame:
        shared, key, keys, of_id = spark.sparkContext.broadcast(index), index.name, pa.array(index.ids, of_item), to_arrow_type(docs.schema["doc_id"].dataType)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if key not in _finders:
                _finders.clear()
                _finders[key] = Finder(shared.value)
            finder = _finders[key]
            for whole in batches:
                for batch in slices(whole, "text"):
                    rows = [(d, *m) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for m in finder.find(t)]
                    cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], of_id), keys.take(pa.array(cols[1], pa.int64())), *(pa.array(c, pa.float64()) for c in cols[2:6]), pa.array(cols[6], pa.int64())],
                        names=["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap", "item_overlap", "first_word"],
                    )

        figures = T._parse_datatype_string("bm25 double, question_overlap double, answer_overlap double, item_overlap double, first_word long")
        return slim.mapInArrow(run, T.StructType([docs.schema["doc_id"], items.schema["item_id"], *figures.fields]))

    return reduce(DataFrame.union, map(matches, indexes(items)))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
