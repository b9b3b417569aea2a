"""BPE, token counts, licences, shards and Ogg against libraries, brute force and round trips."""

import hashlib
import heapq
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from milldam.llm import bpe, licenses, ogg, shards, tokens
from milldam.llm.common import durable

EDGE = [None, "", " ", "a", "Hello,  WORLD!\n\tdon't", "x" * 3000, "<|endoftext|> and <|startoftext|>x", "ΑΣ Σ ΟΔΟΣ İstanbul", "é é ﬁ ½ ٣", "日本語テキスト 🙂🙂", "\x1c\x1d a\x85b c", "ab " * 5000, "▁ a▁b", "123 4567 !!!???", "a"]


def frame(spark, texts, schema="doc_id long, text string"):
    return spark.createDataFrame(list(enumerate(texts)), schema).repartition(3)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_is_the_librarys(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digests(frame(spark, EDGE)).collect()}
    assert got == {i: expected(library, t) for i, t in enumerate(EDGE)}


def test_bpe_over_a_table(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in bpe.op1_bpe_encode(spark, sf_dir).collect()}
    assert got == {i: expected(library, t) for i, t in texts.items()}


_known = {}


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_bpe_any_text(text):
    if not _known:
        _known["ours"] = bpe.Encoder(bpe.Vocabulary(bpe.vocabulary_path()))
        _known["theirs"] = Tokenizer.from_file(bpe.vocabulary_path())
    text = text.encode("utf-8", "ignore").decode()
    ids = _known["theirs"].encode(text, add_special_tokens=False).ids
    assert np.frombuffer(_known["ours"].encode([text])[0], "<u4").tolist() == ids


def test_bpe_extra_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "a b", "kept", 7), (1, "a b", "kept", 7)], "doc_id long, text string, ids string, extra int")
    out = bpe.encode(df, decoded="decoded")
    assert out.columns == ["doc_id", "text", "ids", "extra", "decoded"] and out.count() == 2
    assert bpe.digests(df.limit(0)).count() == 0
    assert {r.again for r in bpe.decode(out, decoded="again").collect()} == {r.decoded for r in out.collect()}


def test_token_counts(spark, sf_dir):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = EDGE + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(frame(spark, rows), public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got == {i: len(sp.encode(t or "")) for i, t in enumerate(rows)}
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(frame(spark, EDGE), public_tokenizers.path("word_bpe_49k.json")).collect()}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert got == {i: len(lib.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(EDGE)}
    out = tokens.op2_token_counts(spark, sf_dir)
    assert out.where(F.col("over_limit") != (F.col("n_tokens") > 4096)).count() == 0 and out.columns[:4] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_alignment():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.randrange(12) for _ in range(rng.randrange(20))] for _ in range(2))
        found = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in found) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))
        pairs = [(i, rng.randrange(30)) for i in range(12)]
        best = max((sum(1 for _ in s) for m in range(1 << 12) if (s := [pairs[k] for k in range(12) if m >> k & 1]) and all(x[1] < y[1] for x, y in zip(s, s[1:]))), default=0) if rng.random() < 0.02 else None
        assert best is None or len(licenses.rising(pairs)) == best
    assert licenses.align(list(range(50)), list(range(50))) == [(i, i) for i in range(50)]


def brute_regions(template, words, begin=0):
    """All parts are tried: the one that ends first, the latest start for that end, then what is behind it."""
    out = []
    while True:
        found = None
        for e in range(begin + 1, len(words) + 1):
            for f in range(e - 1, max(begin, e - template.width) - 1, -1):
                if template.fits(licenses.align(words[f:e], template.ids)):
                    found = (f, e)
                    break
            if found:
                break
        if not found:
            return out
        out.append(found)
        begin = found[1]


def test_license_regions_are_those_of_all_parts():
    rng = random.Random(11)
    some = 0
    for _ in range(120):
        ids = [rng.randrange(9) for _ in range(rng.randrange(4, 13))]
        spelled = [f"word{i:02}" for i in range(9)]
        template = licenses.Template("t", ids, spelled, " ".join(spelled[i] for i in ids), 0.8)
        words = [rng.choice([-1, rng.randrange(9)]) for _ in range(rng.randrange(21))]
        for _ in range(rng.randrange(1, 6)):
            copy = list(ids)
            if rng.random() < 0.5:
                copy[rng.randrange(len(copy))] = -1
            if rng.random() < 0.5:
                at = rng.randrange(len(copy))
                copy[at:at] = [-1] * rng.randrange(1, len(ids))
            words += copy + [rng.choice([-1, -1, rng.randrange(9)]) for _ in range(rng.randrange(8))]
        want = brute_regions(template, words)
        assert [(f, e) for f, e, _ in template.cores(words, 0, len(words))] == want
        regions = template.regions(words, 0, len(words))
        assert len(regions) == len(want) and all(a[-1][0] < b[0][0] for a, b in zip(regions, regions[1:]))
        assert all(r[0][0] < e <= r[-1][0] + 1 and template.fits(r) for r, (f, e) in zip(regions, want))
        some += len(want) > 2
    assert some > 20


def test_every_licence_is_found():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    mit, text, notice = (licenses.TEMPLATES[k] for k in ("MIT", "MIT text", "GPL-3.0 notice"))
    for n in range(1, 6):
        for k in range(21):
            lead = "".join(f"w{i} " for i in range(k))
            for name, template in (("MIT", mit), ("MIT text", text)):
                found = scanner.scan(lead + " ".join([template] * n))
                assert [(x[0], x[1]) for x in found] == [(name, 1.0)] * n and found[0][3] == k
    assert [x[0] for x in scanner.scan(f"{notice} and {mit} then {text} {notice} {mit}")] == ["GPL-3.0 notice", "MIT", "MIT text", "GPL-3.0 notice", "MIT"]
    words = text.split()
    for gap in (50, 120, 200, 400):
        assert [x[:2] for x in scanner.scan(" ".join([*words[:80], *["other"] * gap, *words[80:]]))] == [("MIT text", 1.0)]
    for name, template in licenses.TEMPLATES.items():
        assert [x[:2] for x in scanner.scan(f"some words {template} more words")] == [(name, 1.0)]
    assert [x[0] for x in scanner.scan("Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0. GNU General Public License version 2")] == ["CC-BY-NC-4.0", "CC-BY-4.0 short"]


def test_license_scan(spark):
    notice = licenses.TEMPLATES["Apache-2.0 notice"]
    words = notice.split()
    edited = " ".join(w for i, w in enumerate(words) if i % 9)
    texts = [None, "", "plain words only " * 50, "lead in " * 300 + licenses.TEMPLATES["MIT text"].upper() + " tail" * 900, edited, licenses.TEMPLATES["MIT"], licenses.TEMPLATES["MIT"], " ".join(words[: len(words) // 2])]
    got = {}
    for r in licenses.license_scan(frame(spark, texts)).collect():
        got.setdefault(r.doc_id, []).append((r.license, round(r.coverage, 2), r.first_word))
    assert got[3] == [("MIT text", 1.0, 600)]
    assert "Apache-2.0 notice" in {x[0] for x in got[4]} and got[5] == got[6] == [("MIT", 1.0, 0)]
    assert not {0, 1, 2} & set(got) and "Apache-2.0 notice" not in {x[0] for x in got.get(7, [])}
    assert licenses.license_scan(frame(spark, texts).limit(0)).count() == 0


def test_sharding(spark, sf_dir):
    rows = shards.op4_sharding(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    loads, slots, where = [0] * 8, [[] for _ in range(8)], {}
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert where.setdefault(docs[r.doc_id], r.shard) == r.shard
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    counts = Counter(docs.values())
    assert sorted(loads) == longest_first([n * (len((t or "").encode()) + 1) for t, n in counts.items()], 8)


def longest_first(sizes, n):
    """Loads by plain longest-processing-time scheduling, one group at a time."""
    heap = [0] * n
    for size in sorted(sizes, reverse=True):
        heapq.heapreplace(heap, heap[0] + size)
    return sorted(heap)


def test_sizes_are_dealt_as_the_heap_deals_them():
    rng = random.Random(3)
    for _ in range(200):
        sizes = {rng.randrange(0, 60): rng.randrange(1, 400) for _ in range(rng.randrange(1, 12))}
        if rng.random() < 0.3:
            sizes[rng.randrange(3000, 90000)] = rng.randrange(1, 3)
        n = rng.randrange(1, 9)
        loads = [0] * n
        for size, upto in shards.dealt(sizes.items(), n):
            assert upto[-1] == sizes[size]
            for i in range(n):
                loads[i] += size * (upto[i] - (upto[i - 1] if i else 0))
        assert sorted(loads) == longest_first([s for s, c in sizes.items() for _ in range(c)], n)


@pytest.mark.parametrize(("heavy", "sizes"), [(8, 1000), (1 << 20, 0)])
def test_sharding_is_longest_first(spark, heavy, sizes):
    texts = [None, None, "", "a", "a", "bb" * 400] + [f"t{i % 90}" for i in range(400)] + ["hot"] * 200
    df = frame(spark, texts).withColumns({"shard": F.lit("x"), "_unit": F.lit(1), "slot": F.lit("y")})
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    got = shards.number(durable(shards.assign(df, 4, F.col("text"), size, heavy, sizes)), "doc_id").collect()
    where, loads, slots = {}, [0] * 4, [[] for _ in range(4)]
    for r in got:
        assert where.setdefault(r.text, r.shard) == r.shard
        loads[r.shard] += len(r.text or "") + 1
        slots[r.shard].append(r.slot)
    assert len(got) == 606 and all(sorted(s) == list(range(len(s))) for s in slots)
    assert sorted(loads) == longest_first([c * (len(t or "") + 1) for t, c in Counter(texts).items()], 4)
    assert shards.assign(df.limit(0), 4, F.col("text"), size).count() == 0


def bitwise_crc(data):
    r = 0
    for b in data:
        r ^= b << 24
        for _ in range(8):
            r = ((r << 1) ^ 0x04C11DB7 if r & 0x80000000 else r << 1) & 0xFFFFFFFF
    return r


def test_ogg_pages():
    rng = random.Random(3)
    data = bytes(rng.randrange(256) for _ in range(700))
    assert ogg.checksum(data) == bitwise_crc(data)
    for sizes in ([1, 0, 254, 255, 256, 70000], [255 * 128], [0], [510, 510]):
        packets = [(bytes(rng.randrange(256) for _ in range(n)), i) for i, n in enumerate(sizes)]
        assert [x for x, _ in ogg.streams(b"".join(x for _, x in ogg.pages(packets, 9)))[9]] == [x for x, _ in packets]


def test_ogg_round_trip_and_damage(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in ogg.op5_ogg_columns(spark, sf_dir).collect():
        want = ogg.padded((texts[r.doc_id] or "").encode())
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-16:]))
        assert len(want) % 192 == 0 and r.n_bytes == len((texts[r.doc_id] or "").encode())
    assert ogg.padded(b"") == b" " * 192 and len(ogg.padded(b"x" * 192)) == 192
    media = ogg.write(ogg.padded(b"some words " * 3000))
    found = ogg.read(media)
    assert found["n_streams"] == 2 and found["duration_s"] == len(found["payload"]) / 8000
    assert found["starts_s"] == [i * ogg.PACKET / 8000 for i in range(found["n_packets"])]
    df = spark.createDataFrame([(1, bytearray(media)), (2, bytearray(media[:-1])), (3, bytearray(media[:500] + b"\xff" + media[501:])), (4, None), (5, bytearray(b""))], "doc_id long, media binary")
    assert {r.doc_id: r.probe.ok for r in ogg.probe(df).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_ogg_times_come_from_granule_positions():
    sound = [(bytes(10), -1), (bytes(20), 30), (bytes(5), -1), (b"", -1), (bytes(7), 42)]
    assert ogg.timed(sound) == [(0, 10), (10, 30), (30, 35), (35, 35), (35, 42)] and ogg.timed([]) == []
    for wrong in ([(bytes(10), 11)], [(bytes(10), 10), (bytes(5), 16)], [(bytes(10), -1)], [(bytes(10), 4)]):
        with pytest.raises(ValueError):
            ogg.timed(wrong)


def test_ogg_features_against_plain_loops(spark):
    texts = [None, "", "some words", "é" * 300, "x" * 9000]
    for r in ogg.probe(ogg.store(frame(spark, texts))).collect():
        data = ogg.padded((texts[r.doc_id] or "").encode())
        c = [b - 128 for b in data]
        want = f"s={len(data)};ms={1000 * len(data) // 8000};mean={sum(c)};energy={sum(x * x for x in c)};cross={sum((x < 0) != (y < 0) for x, y in zip(c, c[1:]))};lo={min(data)};hi={max(data)}"
        assert r.probe.feature == want and r.probe.payload == data


def test_clashing_columns_and_empty_tables(spark):
    """Extra columns with the names of results are replaced where columns pass through, and left out elsewhere."""
    names = "n_tokens media probe license coverage first_word".split()
    df = frame(spark, [None, "", "Released under the MIT License."]).select("doc_id", "text", *[F.lit("old").alias(n) for n in names])
    counted = tokens.count_tokens(df, public_tokenizers.path("piece_bpe_32k.model"))
    assert counted.columns == df.columns and {r.doc_id: r.n_tokens > 0 for r in counted.collect()} == {0: False, 1: False, 2: True}
    read = ogg.probe(ogg.store(df))
    assert read.columns == df.columns and all(r.probe.ok and r.license == "old" for r in read.collect())
    assert [(r.doc_id, r.license) for r in licenses.license_scan(df).collect()] == [(2, "MIT")]
    assert licenses.license_scan(df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))).first().doc_id == "d2"
    for out in (counted, read, licenses.license_scan(df)):
        assert out.where("1 = 0").count() == 0
    none = df.limit(0)
    assert tokens.count_tokens(none, public_tokenizers.path("piece_bpe_32k.model")).count() == ogg.probe(ogg.store(none)).count() == licenses.license_scan(none).count() == 0
