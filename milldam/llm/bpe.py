"""Byte-pair encoding and decoding: speculate, verify, and merge only what failed.

A word's tokens are first guessed by greedy longest match over a trie. The guess is the
true encoding if and only if every adjacent pair of it is compatible, that is, no merge
across the border of the two would have come before the merges that built its sides.
All pairs of a batch are tested at once; words with a bad pair are merged exactly, in
lockstep. A word is encoded once per batch of texts, however often it occurs.

Defined results: null and empty texts have no tokens and decode to ''; whole texts are encoded, whatever their
length; an empty table gives an empty table; repeated rows and extra columns pass through; a column that has the
name of a result is replaced.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, schema_with, slices, table, with_columns

#: Words are kept in a worker's memory up to this number; then all are forgotten.
CACHE_WORDS = 600_000
#: Failing words of more symbols are merged one by one with a heap, shorter ones in lockstep.
LOCKSTEP = 48
END = 256
# Marks whose place among other marks differs between versions of Unicode.
REORDERED = frozenset("\u1df6\U0001e4ec\U0001e4ed")
NEVER = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(printable))
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Tables of a BPE vocabulary with word ends, from a tokenizers file. Bounded by the vocabulary, not by data."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: only lower-casing BPE with word ends is supported")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        ids = model["vocab"]
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.written = [""] * self.size
        for token, i in {**ids, **self.special}.items():
            self.written[i] = token
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], dtype=np.int64)
        right = np.array([ids[b] for _, b in merges], dtype=np.int64)
        made = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks, self.pair_made = keys[order], order.astype(np.int64), made[order]
        self.left, self.right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        self.rank = np.full(self.size, -1, np.int64)
        self.left[made], self.right[made], self.rank[made] = left, right, np.arange(len(merges))
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        self.base = np.full((256, 2), -1, np.int64)
        letters = byte_letters()
        for b in range(256):
            self.base[b] = ids[letters[b]], ids[letters[b] + "</w>"]
        spelled = {}
        for token, i in ids.items():
            ends = token.endswith("</w>")
            body = token[:-4] if ends else token
            spelled[i] = [to_byte[c] for c in body] + [END] * ends
        self._own(spelled)
        self._trie({i: s for i, s in spelled.items() if self.own[i]})

    def _own(self, spelled: dict[int, list[int]]) -> None:
        """own: the tokens that their own spelling encodes to; no encoding has any other."""
        self.own = np.zeros(self.size, bool)
        by_length: dict[int, list[int]] = {}
        for i, s in spelled.items():
            by_length.setdefault(len(s) - (s[-1] == END), []).append(i)
        for n, tokens in by_length.items():
            rows = np.array([self.symbols(spelled[i]) for i in tokens], dtype=np.int64).reshape(len(tokens), n)
            merged, sizes = self.merge_rows(rows)
            self.own[np.array(tokens)] = (sizes == 1) & (merged[:, 0] == np.array(tokens))

    def symbols(self, spelling: list[int]) -> list[int]:
        ends = spelling[-1] == END
        body = spelling[:-1] if ends else spelling
        out = [int(self.base[b, 0]) for b in body]
        if ends:
            out[-1] = int(self.base[body[-1], 1])
        return out

    def _trie(self, spelled: dict[int, list[int]]) -> None:
        edges: dict[int, int] = {}
        accept = [-1]
        for i, spelling in spelled.items():
            node = 0
            for s in spelling:
                key = node * 257 + s
                child = edges.get(key)
                if child is None:
                    child = edges[key] = len(accept)
                    accept.append(-1)
                node = child
            accept[node] = i
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        self.edge_keys, self.edge_to = keys[order], np.fromiter(edges.values(), np.int64, len(edges))[order]
        self.accept = np.array(accept, dtype=np.int64)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NEVER: none) and result of the merge of a with b."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_ranks[at], NEVER), self.pair_made[at]

    def speculate(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words at once: the tokens, and the word that each belongs to, in order."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        symbols = np.full(int((lengths + 1).sum()) + 1, END, np.int64)
        body = np.ones(len(symbols) - 1, bool)
        body[starts + lengths] = False
        symbols[:-1][body] = np.frombuffer(b"".join(words), np.uint8)
        ends = starts + lengths
        who, pos = np.arange(len(words)), starts.copy()
        tokens, owners = [], []
        while len(who):
            best, step = np.full(len(who), -1, np.int64), np.zeros(len(who), np.int64)
            node, at, live = np.zeros(len(who), np.int64), pos.copy(), np.arange(len(who))
            while len(live):
                s = symbols[at]
                keys = node * 257 + s
                found = np.minimum(np.searchsorted(self.edge_keys, keys), len(self.edge_keys) - 1)
                hit = self.edge_keys[found] == keys
                live, at, s, node = live[hit], at[hit] + 1, s[hit], self.edge_to[found[hit]]
                token = self.accept[node]
                good = (token >= 0) & ((s == END) | (symbols[at] != END))
                best[live[good]], step[live[good]] = token[good], at[good] - pos[live[good]]
                more = s != END
                live, at, node = live[more], at[more], node[more]
            tokens.append(best)
            owners.append(who)
            pos = pos + step
            left = pos <= ends[who]
            left &= pos != ends[who] + 1
            who, pos = who[left], pos[left]
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        order = np.argsort(owner, kind="stable")
        return token[order], owner[order]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a and b stay as they are side by side.

        Going back in time from (a, b), the younger side is undone step by step. A merge of the
        two pieces that touch at the border must not come before the merge that used up either.
        """
        good = np.ones(len(a), bool)
        live, x, y = np.arange(len(a)), a.copy(), b.copy()
        used_x, used_y = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(live):
            m, _ = self.pairs(x, y)
            bad = (m < used_x) & (m <= used_y)
            good[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            live, x, y, used_x, used_y, rx, ry = (v[go] for v in (live, x, y, used_x, used_y, rx, ry))
            on_x = rx > ry
            used_x, used_y = np.where(on_x, rx, used_x), np.where(on_x, used_y, ry)
            x, y = np.where(on_x, self.right[x], x), np.where(on_x, y, self.left[y])
        return good

    def merge_rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of equally long rows of symbols in lockstep: tokens and their number in each row."""
        rows = rows.copy()
        n, width = rows.shape
        sizes = np.full(n, width, np.int64)
        if width < 2:
            return rows, sizes
        ranks, made = (v.reshape(n, width - 1) for v in self.pairs(rows[:, :-1].ravel(), rows[:, 1:].ravel()))
        ranks = ranks.copy()
        made = made.copy()
        live = np.arange(n)
        while len(live):
            j = ranks[live].argmin(1)
            go = ranks[live, j] < NEVER
            live, j = live[go], j[go]
            if not len(live):
                break
            rows[live, j] = made[live, j]
            k = np.arange(width - 1)
            shift = k[None, :] > j[:, None]
            block = rows[live]
            block[:, :-1] = np.where(shift, block[:, 1:], block[:, :-1])
            # what stands at j + 1 .. moves one to the left
            block[:, -1] = -1
            sizes[live] -= 1
            rows[live] = block
            r, m = ranks[live], made[live]
            tail = k[None, :-1] > j[:, None] if width > 2 else np.zeros((len(live), 0), bool)
            r[:, :-1], m[:, :-1] = np.where(tail, r[:, 1:], r[:, :-1]), np.where(tail, m[:, 1:], m[:, :-1])
            r[:, -1] = NEVER
            for off in (-1, 0):
                at = j + off
                ok = (at >= 0) & (at + 1 < sizes[live])
                rr, mm = self.pairs(block[np.arange(len(live)), np.maximum(at, 0)], block[np.arange(len(live)), np.minimum(at + 1, width - 1)])
                sel = np.flatnonzero(at >= 0)
                at = np.minimum(at, width - 2)
                r[sel, at[sel]] = np.where(ok, rr, NEVER)[sel]
                m[sel, at[sel]] = mm[sel]
            ranks[live], made[live] = r, m
        return rows, sizes

    def merge_long(self, symbols: list[int]) -> list[int]:
        """Exact merging of one long row with a heap of its pairs."""
        tokens, following, previous = list(symbols), [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
        ranks, made = (v.tolist() for v in self.pairs(np.array(symbols[:-1]), np.array(symbols[1:])))
        heap = [(r, i, tokens[i], tokens[i + 1], m) for i, (r, m) in enumerate(zip(ranks, made, strict=True)) if r < NEVER]
        heapq.heapify(heap)
        look = {}
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = following[i] if tokens[i] == a else -1
            if j < 0 or tokens[j] != b:
                continue
            tokens[i], tokens[j] = whole, -1
            following[i] = following[j]
            if following[j] >= 0:
                previous[following[j]] = i
            for p, q in ((previous[i], i), (i, following[i])):
                if p >= 0 and q >= 0:
                    pair = tokens[p], tokens[q]
                    if pair not in look:
                        r, m = self.pairs(np.array([pair[0]]), np.array([pair[1]]))
                        look[pair] = int(r[0]), int(m[0])
                    if look[pair][0] < NEVER:
                        heapq.heappush(heap, (look[pair][0], p, *pair, look[pair][1]))
        return [t for t in tokens if t >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words (none empty) in a row, and where each word's begin (and the last one's end)."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        tokens, owner = self.speculate(words)
        border = np.flatnonzero(owner[1:] == owner[:-1])
        pair = tokens[border] * self.size + tokens[border + 1]
        known, back = np.unique(pair, return_inverse=True)
        good = self.compatible(known // self.size, known % self.size)[back] if len(known) else np.zeros(0, bool)
        failed = np.zeros(len(words), bool)
        failed[owner[border[~good]]] = True
        sizes = np.bincount(owner, minlength=len(words))
        exact = []
        by_length: dict[int, list[int]] = {}
        for w in np.flatnonzero(failed).tolist():
            by_length.setdefault(len(words[w]), []).append(w)
        for n, group in by_length.items():
            raw = np.frombuffer(b"".join([words[w] for w in group]), np.uint8).reshape(len(group), n)
            rows = self.base[raw, 0]
            rows[:, -1] = self.base[raw[:, -1], 1]
            if n > LOCKSTEP:
                for w, row in zip(group, rows, strict=True):
                    merged = np.array(self.merge_long(row.tolist()), dtype=np.int64)[None, :]
                    exact.append((np.array([w]), merged, np.array([merged.shape[1]])))
            else:
                exact.append((np.array(group), *self.merge_rows(rows)))
        for at, _, k in exact:
            sizes[at] = k
        starts = np.concatenate(([0], np.cumsum(sizes)))
        out = np.empty(starts[-1], np.int64)
        kept = ~failed[owner]
        out[np.repeat(~failed, sizes)] = tokens[kept]
        for at, merged, k in exact:
            inside = np.arange(merged.shape[1])[None, :] < k[:, None]
            out[(starts[at][:, None] + np.arange(merged.shape[1]))[inside]] = merged[inside]
        return out, starts


class Encoder:
    """Encodes texts with a vocabulary; keeps the words that it has met lately."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pieces = regex.compile(vocabulary.pattern).findall
        self.known: dict[str, bytes] = {}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")")
        self.marks = list(vocabulary.special)
        self.space = regex.compile(r"\s+")
        self.spelled = [t.encode() for t in vocabulary.written]
        self.rare = None

    def chunks(self, text: str) -> list[str]:
        """What stands between white space. str.split also cuts at four control characters, which are none."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [x for x in self.space.split(text) if x]
        return text.split()

    def unassigned(self, chunk: str) -> list[str]:
        """Pieces of a chunk with letters that Python's Unicode tables may lack: their case, kind and order are the library's."""
        if self.rare is None:
            from tokenizers import Regex, normalizers, pre_tokenizers

            self.rare = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]), pre_tokenizers.Split(Regex(self.v.pattern), "removed", invert=True)
        return [p for p, _ in self.rare[1].pre_tokenize_str(self.rare[0].normalize_str(chunk))]

    def learn(self, chunks: list[str]) -> None:
        words: dict[str, int] = {}
        place = words.setdefault
        single, single_at, several, several_at = [], [], [], []
        for chunk in chunks:
            if chunk.isascii():
                plain = chunk.lower()
            elif not (chunk.isprintable() and REORDERED.isdisjoint(chunk)):
                several.append(chunk)
                several_at.append([place(p, len(words)) for p in self.unassigned(chunk)])
                continue
            else:
                plain = unicodedata.normalize("NFC", chunk)
                plain = "".join([c.lower() for c in plain]) if "Σ" in plain else plain.lower()
            if plain.isalpha():
                single.append(chunk)
                single_at.append(place(plain, len(words)))
            else:
                several.append(chunk)
                several_at.append([place(p, len(words)) for p in self.pieces(plain)])
        tokens, starts = self.v.encode_words([w.encode() for w in words])
        packed = tokens.astype("<u4").tobytes()
        cuts = (starts * 4).tolist()
        known = self.known
        for chunk, i in zip(single, single_at, strict=True):
            known[chunk] = packed[cuts[i] : cuts[i + 1]]
        for chunk, at in zip(several, several_at, strict=True):
            known[chunk] = b"".join([packed[cuts[i] : cuts[i + 1]] for i in at])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, packed as little-endian unsigned 32-bit integers."""
        parts: list[list[list[str] | bytes]] = []
        for text in texts:
            if not text:
                parts.append([])
            elif any(m in text for m in self.marks):
                cut = self.cut.split(text)
                parts.append([self.v.special[x].to_bytes(4, "little") if i % 2 else self.chunks(x) for i, x in enumerate(cut)])
            else:
                parts.append([self.chunks(text)])
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = set()
        for part in parts:
            for x in part:
                if type(x) is list:
                    new.update(x)
        new.difference_update(self.known)
        if new:
            self.learn(list(new))
        get = self.known.__getitem__
        return [b"".join(x if type(x) is bytes else b"".join(map(get, x)) for x in part) for part in parts]

    def decode(self, packed: bytes) -> bytes:
        """The text of packed ids in UTF-8: without a decoder, the library joins the written tokens with blanks."""
        return b" ".join(map(self.spelled.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_encoders: dict[str, Encoder] = {}


def _encoder(handle) -> Encoder:
    """One encoder for each vocabulary in a worker."""
    if handle.key not in _encoders:
        _encoders[handle.key] = Encoder(handle.tables.value)
    return _encoders[handle.key]


class _Handle:
    """The broadcast tables (some MB, bounded by the vocabulary) and the name that workers keep them under."""

    def __init__(self, spark: SparkSession, path: str):
        self.key = path
        self.tables = spark.sparkContext.broadcast(Vocabulary(path))


def encode(df: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds `ids`, the token ids packed as little-endian unsigned 32-bit integers, and, if named, the text decoded from them."""
    spark = df.sparkSession
    bounded_batches(spark)
    handle = _Handle(spark, path or vocabulary_path())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(handle)
        for whole in batches:
            for batch in slices(whole, text):
                packed = encoder.encode(batch.column(text).to_pylist())
                more = {ids: pa.array(packed, pa.binary())}
                if decoded:
                    more[decoded] = pa.array(map(encoder.decode, packed), pa.binary(), size=len(packed)).cast(pa.string())
                yield with_columns(batch, **more)
        encoder.known.clear()  # what the worker does next needs the memory

    schema = schema_with(df, **{ids: T.BinaryType()}, **({decoded: T.StringType()} if decoded else {}))
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str | None = None, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the text of packed token ids (null: '')."""
    spark = df.sparkSession
    bounded_batches(spark)
    handle = _Handle(spark, path or vocabulary_path())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(handle)
        for whole in batches:
            for batch in slices(whole, ids, 1 << 20):
                texts = [encoder.decode(x or b"") for x in batch.column(ids).to_pylist()]
                yield with_columns(batch, **{decoded: pa.array(texts, pa.binary()).cast(pa.string())})

    return df.mapInArrow(run, schema_with(df, **{decoded: T.StringType()}))


def op1_bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def digests(docs: DataFrame) -> DataFrame:
    coded = encode(docs.select("doc_id", "text"), decoded="decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
