"""Maximal periodic runs of words, by recompression.

A batch's texts are laid end to end as one sequence of numbers; words of different texts have different numbers, so nothing is
equal across texts. Recompression turns it into a run-length grammar: block compression gives each run of one symbol a symbol,
pair compression one to each adjacent pair of a left and a right symbol, a coin per symbol and level saying which it is. It
ends once all symbols differ. Equal stretches are parsed alike but for their ends, so the longest common extension of two places
is found by going up while they agree and down where they differ, with at most one step at each level, for all pairs of
places at once.

A run of period q and at least 2q words holds two neighbours i, i+q of the grid of multiples of q. So for each q the grid's
neighbours of one word are candidates, whose extensions to both sides give the run; of runs over the same words the smallest period
is the run's. Candidates are n log n in all, sequences and grammar linear in the batch's words.

Defined results: texts without words (null, empty, white space) have no runs and an empty rest; whole texts count, whatever their
length; repeated rows each have their result; a null id has its result, and rewritten() leaves its words alone; an empty table
gives an empty table; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import bounded_batches, slices, table

#: Runs of fewer words do not count.
SHORTEST = 12
#: Bytes of text that are searched together; a longer text is searched alone.
AT_ONCE = 2 << 20


class Grammar:
    """The levels of a sequence: symbols (a sentinel at the end), whether blocks were compressed next, and the way up and down."""

    def __init__(self, symbols: np.ndarray, seed: int = 42):
        self.symbols, self.blocks, self.first, self.up, self.phrase = [], [], [], [], []
        fresh, coins = int(symbols.max(initial=0)) + 1, np.random.default_rng(seed)
        s, block = symbols.astype(np.int64), True
        while True:
            ordered = np.sort(s)
            if not (ordered[1:] == ordered[:-1]).any():
                break
            if block:
                starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
                sizes = np.diff(np.append(starts, len(s)))
                many = sizes > 1
                names = s[starts] * np.int64(len(s) + 1) + sizes
            else:
                factor = coins.integers(1, 1 << 62, dtype=np.int64) * 2 + 1
                left = ((s * factor) >> 40) & 1 == 0
                second = np.concatenate(([False], left[:-1] & ~left[1:]))
                starts = np.flatnonzero(~second)
                many = np.diff(np.append(starts, len(s))) > 1
                names = s[starts] * np.int64(fresh) + s[np.minimum(starts + 1, len(s) - 1)]
            if many.any():
                above = s[starts]
                found, inverse = np.unique(names[many], return_inverse=True)
                above[many] = fresh + inverse
                self._add(s, block, starts)
                fresh += len(found)
                s = above
            block = not block
        self.symbols.append(np.append(s, -1))

    def _add(self, s: np.ndarray, block: bool, starts: np.ndarray) -> None:
        up = np.full(len(s) + 1, -1, np.int32)
        up[starts] = np.arange(len(starts))
        up[-1] = len(starts)
        phrase = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(s))))
        self.symbols.append(np.append(s, -1))
        self.blocks.append(block)
        self.first.append(np.append(starts, len(s)).astype(np.int32))
        self.up.append(up)
        self.phrase.append(np.append(phrase, 0))

    def _stepped(self, level: int, p: np.ndarray, q: np.ndarray, ahead: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both places past the symbol, or the part of the block, that they have in common at this level; and whether there is one."""
        symbols, first, phrase = self.symbols[level], self.first[level], self.phrase[level]
        a, b = (p, q) if ahead else (p - 1, q - 1)
        same = symbols[a] == symbols[b]
        if self.blocks[level]:
            x, y = phrase[a], phrase[b]
            step = np.minimum(first[x + 1] - p, first[y + 1] - q) if ahead else np.minimum(p - first[x], q - first[y])
            step = np.where(same, step, 0)
        else:
            step = same.astype(np.int32)
        return (p + step, q + step, same) if ahead else (p - step, q - step, same)

    def extension(self, i: np.ndarray, j: np.ndarray, ahead: bool = True) -> np.ndarray:
        """For places i < j: how many symbols from them on, or before them, are equal."""
        top = len(self.blocks)
        p, q = i.astype(np.int32), j.astype(np.int32)
        going, parked = np.arange(len(p)), [np.empty(0, np.int64)] * (top + 1)
        for level in range(top):
            up = self.up[level]
            x, y = p[going], q[going]
            inside = (up[x] < 0) | (up[y] < 0)
            if inside.any():
                some = np.flatnonzero(inside)
                x[some], y[some], _ = self._stepped(level, x[some], y[some], ahead)
            x_up, y_up = up[x], up[y]
            stops = (x_up < 0) | (y_up < 0)
            parked[level] = going[stops]
            p[going], q[going] = np.where(stops, x, x_up), np.where(stops, y, y_up)
            going = going[~stops]
        for level in range(top - 1, -1, -1):
            first = self.first[level]
            p[going], q[going], _ = self._stepped(level, first[p[going]], first[q[going]], ahead)
            going = np.concatenate((going, parked[level]))
        return np.abs(p - i)


def numbered(texts: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, words of different texts always differing, and where each text begins (and the end)."""
    ends = np.cumsum([0, *map(len, texts)])
    out, base = np.empty(ends[-1], np.int64), 0
    for at, words in zip(ends, texts, strict=False):
        seen: dict = {}
        out[at : at + len(words)] = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)) + base
        base += len(seen)
    return out, ends


def candidates(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, q): equal neighbours i, i+q of the grids of all periods that fit; the texts are in order of falling size."""
    starts, periods = [], []
    ends = np.cumsum(sizes)
    fits = np.searchsorted(-sizes, -2 * np.arange(int(sizes[0]) // 2 + 1), side="right") if len(sizes) else [0]
    for q in range(1, len(fits)):
        if fits[q] == 0 or sizes[0] < SHORTEST:
            break
        grid = words[: ends[fits[q] - 1] : q]
        i = np.flatnonzero(grid[1:] == grid[:-1])
        if len(i):
            starts.append(i * q)
            periods.append(np.full(len(i), q))
    return (np.concatenate(starts), np.concatenate(periods)) if starts else (np.empty(0, np.int64), np.empty(0, np.int64))


def runs(texts: list[list]) -> list[np.ndarray]:
    """For each sequence: its maximal runs, rows of (start, length, period) in order of start, then period."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    words, begins = numbered([texts[k] for k in order])
    i, q = candidates(words, np.diff(begins))
    out = [np.empty((0, 3), np.int64)] * len(texts)
    if not len(i):
        return out
    grammar = Grammar(words)
    start = i - grammar.extension(i, i + q, False)
    length = i + q + grammar.extension(i, i + q) - start
    long = length >= np.maximum(SHORTEST, 2 * q)
    found = np.unique(np.stack([start, length, q], axis=1)[long], axis=0)  # of equal stretches the smallest period is first
    if not len(found):
        return out
    found = found[np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(axis=1)))]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    text = np.searchsorted(begins, found[:, 0], side="right") - 1
    found[:, 0] -= begins[text]
    cuts = np.flatnonzero(np.diff(text)) + 1
    for rows, k in zip(np.split(found, cuts), text[np.concatenate(([0], cuts))].tolist(), strict=True):
        out[order[k]] = rows
    return out


def collapsed(words: list, found: np.ndarray) -> list:
    """The words that no run holds after its first period."""
    if not len(found):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def rewritten(doc_id: int | None, words: list) -> list:
    """One text of ten, by a digest of its id, repeats a stretch of its words to its end."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return words[:a] + (stretch * ((n - a) // p + 1))[: n - a]


SCHEMA = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed string"


def periodic(df: DataFrame, doc_id: str = "doc_id", text: str = "text", before: Callable[[int | None, list], list] | None = None, digest: bool = False) -> DataFrame:
    """(doc_id, SCHEMA): each text's longest run (ties: first start, then period), all runs' digest, and the words kept, joined by
    spaces, or with `digest` their SHA-256. before(id, words) may replace the words."""
    bounded_batches(df.sparkSession)
    schema = T.StructType([T.StructField("doc_id", df.schema[doc_id].dataType), *T._parse_datatype_string(SCHEMA).fields])

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        words = [(x or b"").split() for x in texts]  # bytes.split knows ASCII white space only, as is meant
        if before is not None:
            words = list(map(before, ids, words))
        for key, w, found in zip(ids, words, runs(words), strict=True):
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in found.tolist())
            best = min(found.tolist(), key=lambda r: (-r[1], r[0], r[2]), default=None)
            s, n, q = best or (None, None, None)
            kept = b" ".join(collapsed(w, found))
            last = hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "replace")
            yield key, len(w), len(found), s, n, q, None if best is None else 1000 * n // q, hashlib.sha256(listed.encode()).hexdigest(), last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", AT_ONCE):
                columns = zip(*rows(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()), strict=True)
                kinds = [batch.schema.field("doc_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

    return df.select(df[doc_id].alias("doc_id"), df[text].alias("text")).mapInArrow(run, schema)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic(table(spark, sf_dir, "documents"), before=rewritten, digest=True)
    return found.withColumnRenamed("collapsed", "collapsed_sha256").select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words")
