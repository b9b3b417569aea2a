"""Token counts of whole texts, as the library of a model file gives them.

Texts go through Arrow in batches bounded by bytes. For a sentencepiece model whose pieces have the
word mark in front only, a single blank between two other characters is a safe boundary: no piece
spans it, and what follows, encoded alone, gets back the mark that the blank would have become. Texts
are split there, equal parts of a batch are encoded once, in library batches balanced by bytes, and
only lengths come back.

Defined results: null and empty texts have 0 tokens; whole texts count, whatever their length; an empty table gives an
empty table; repeated rows and extra columns pass through; a column that has the name of the result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, schema_with, slices, table, with_columns

MARK = "▁"
#: Bytes that the library gets at once.
LIBRARY_BYTES = 1 << 20
#: Counts kept in a worker, of parts of at most PART characters.
KEPT, PART = 600_000, 48
_boundary = re.compile(f"(?<=[^ {MARK}]) (?=[^ {MARK}])")


class PieceCounter:
    """Counts with a sentencepiece model, given as bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = (self.library.id_to_piece(i) for i in range(self.library.get_piece_size()))
        self.safe = not any(MARK in p.lstrip(MARK) for p in pieces) and self.library.encode("x", out_type=str)[0].startswith(MARK) and len(self.library.encode("a  b")) > 2
        self.known: dict[str, int] = {}

    def parts(self, text: str) -> list[str]:
        if not self.safe:
            return [text]
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return _boundary.split(text)
        return text.split(" ")

    def lengths(self, parts: list[str]) -> list[int]:
        out, batch, size = [], [], 0
        for p in parts:
            batch.append(p)
            size += len(p.encode()) + 32
            if size > LIBRARY_BYTES:
                out += map(len, self.library.encode(batch, num_threads=1))
                batch, size = [], 0
        return out + [len(x) for x in self.library.encode(batch, num_threads=1)] if batch else out

    def count(self, texts: list[str | None]) -> list[int]:
        split = [self.parts(t) if t else [] for t in texts]
        if len(self.known) > KEPT:
            self.known.clear()
        new = set()
        for parts in split:
            new.update(parts)
        new.difference_update(self.known)
        new = list(new)
        found = dict(zip(new, self.lengths(new), strict=True))
        long = {p: n for p, n in found.items() if len(p) > PART}
        self.known.update(found if not long else {p: n for p, n in found.items() if len(p) <= PART})
        known = self.known
        if not long:
            return [sum(map(known.__getitem__, parts)) for parts in split]
        return [sum([known[p] if p in known else long[p] for p in parts]) for parts in split]


class WholeCounter:
    """Counts with a tokenizers file; its texts are not split, as no boundary is safe for every such file."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model.decode())
        self.library.no_truncation()
        self.library.no_padding()

    def count(self, texts: list[str | None]) -> list[int]:
        return [len(x.ids) for x in self.library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


_counters: dict = {}


def count_tokens(df: DataFrame, path: str, text: str = "text", result: str = "n_tokens") -> DataFrame:
    """Adds the number of tokens of each whole text. The model's bytes, some MB at most, are broadcast."""
    bounded_batches(df.sparkSession)
    with open(path, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())
    kind = PieceCounter if path.endswith(".model") else WholeCounter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = kind(model.value)
        counter = _counters[path]
        for whole in batches:
            for batch in slices(whole, text):
                counts = counter.count(batch.column(text).to_pylist())
                yield with_columns(batch, **{result: pa.array(counts, pa.int64())})

    return df.mapInArrow(run, schema_with(df, **{result: T.LongType()}))


def op2_token_counts(spark: SparkSession, sf_dir: str, limit: int = 4096) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
