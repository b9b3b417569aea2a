"""Pseudonyms, lattice scores, decontamination, near-dedup, toxicity and the pipeline."""

import datetime
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from milldam.llm import components, decontaminate, lattice, pii, simhash, toxicity

pipeline = pytest.importorskip("corpus_pipeline")


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10


def test_pseudonyms(spark):
    texts = [
        None, "", "nothing to see, 12 apples", "mail jane.doe+x@example.org or call +1 (212) 555-0147", "jane.doe+x@example.org", "card 4111111111111111 and 4111 1111 1111 1111",
        "from 10.1.2.3 on 2024-02-29 and 31.12.1999", "ssn 123-45-6789", "token 0123456789abcdef0123456789abcdef", "word " * 20000 + "a@b.org", "4111111111111112",
    ]
    got = {r.doc_id: r for r in pii.pseudonymise(frame(spark, texts), "k", found="n_found").collect()}
    assert got[0].text is None and [got[i].text for i in (1, 2)] == texts[1:3] and got[2].n_found == 0
    mail = re.search(r"\S+@\S+", got[3].text)[0]
    assert mail == got[4].text != texts[4] and mail.endswith("@example.org") and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[3].text) and "555-0147" not in got[3].text
    a, b = got[5].text[5:21], got[5].text[26:].replace(" ", "")
    assert a == b != "4111111111111111" and luhn(a) == 0 and got[10].text == texts[10]  # a wrong check digit: no card
    assert re.fullmatch(r"from (\d{1,3}\.){3}\d{1,3} on \d{4}-\d{2}-\d{2} and \d{2}\.\d{2}\.\d{4}", got[6].text) and got[6].text != texts[6]
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4}", got[7].text) and got[7].text != texts[7] and re.fullmatch("token [0-9a-f]{32}", got[8].text)
    assert "a@b.org" not in got[9].text and len(got[9].text) == len(texts[9])
    assert pii.pseudonymise(frame(spark, texts).limit(0), "k").count() == 0
    other = {r.doc_id: r.text for r in pii.pseudonymise(frame(spark, texts), "another key").collect()}
    assert other[7] != got[7].text


def test_pseudonyms_are_permutations(spark):
    df = spark.range(10000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("x"))
    assert df.select(pii.by_digits(F.col("x"), "k", "t").alias("y")).distinct().count() == 10000
    days = spark.range(0, 146097, 7).select(pii.pair(F.col("id"), 189, 773, "k", "date").alias("y"))
    assert days.distinct().count() == days.count() and days.where("y < 0 or y >= 146097").count() == 0


def network(values, radixes, key, kind):
    """The Feistel network in plain Python."""
    h = len(values) // 2
    left, right, rl, rr = list(values[:h]), list(values[h:]), radixes[:h], radixes[h:]

    def shifted(half, other, radix, k):
        seen = ",".join(map(str, other))
        draw = lambda i: int(hashlib.sha256(f"{key}|{kind}|{k}|{seen}|{i // 16}".encode()).hexdigest()[i % 16 * 4 : i % 16 * 4 + 4], 16)
        return [(x + draw(i)) % radix[i] for i, x in enumerate(half)]

    for k in range(pii.ROUNDS):
        left, right = (shifted(left, right, rl, k), right) if k % 2 == 0 else (left, shifted(right, left, rr, k))
    return left + right


def test_pseudonyms_are_the_plain_network(spark):
    def card(s):
        d = [int(c) for c in s if c.isdigit()]
        body = network(d[:-1], [10] * len(d[:-1]), "k", "number")
        check = next(c for c in range(10) if luhn("".join(map(str, [*body, c]))) % 10 == 0)
        return "".join(map(str, [*body, check]))

    def date(s):
        n = (datetime.date.fromisoformat(s) - datetime.date(1800, 1, 1)).days
        a, b = network([n // 773, n % 773], [189, 773], "k", "date")
        return (datetime.date(1800, 1, 1) + datetime.timedelta(a * 773 + b)).isoformat()

    def address(s):
        p = [int(x) for x in s.split(".")]
        a, b = network([p[0] * 256 + p[1], p[2] * 256 + p[3]], [65536] * 2, "k", "address")
        return f"{a >> 8}.{a & 255}.{b >> 8}.{b & 255}"

    def social(s):
        a, g, n = map(int, s.split("-"))
        a, g, n = network([a - 1 - (a > 666), g - 1, n - 1], [898, 99, 9999], "k", "social")
        return f"{a + 1 + (a >= 665):03}-{g + 1:02}-{n + 1:04}"

    def secret(s):
        return "".join("0123456789abcdef"[v] for v in network([int(c, 16) for c in s], [16] * len(s), "k", "secret"))

    values = {"4111111111111111": card, "378282246310005": card, "2024-02-29": date, "1999-12-31": date, "10.1.2.3": address, "255.0.0.9": address, "123-45-6789": social, "899-99-9999": social, "0123456789abcdef" * 2: secret}
    got = [r.text for r in pii.pseudonymise(frame(spark, list(values)), "k").orderBy("doc_id").collect()]
    assert got == [f(v) for v, f in values.items()]
    left = ["4111111111111112", "000-12-3456", "666-12-3456", "901-12-3456", "123-00-6789", "+830 123 456 7890", "2024-02-30", "+0 123 456 789"]
    assert [r.text for r in pii.pseudonymise(frame(spark, left), "k").orderBy("doc_id").collect()] == left
    every = spark.range(1, 900).where("id != 666").select(pii.social(F.concat(F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("-12-3456")), "k").alias("x"))
    assert every.distinct().count() == 898 and every.where("not x rlike '^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$'").count() == 0


def test_pseudonyms_stay_native(spark, sf_dir):
    plan = pii.op6_pii_pseudonyms(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def all_segmentations(pieces, word):
    word, out = lattice.MARK + word, -math.inf
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate((*cuts, 1), 1):
            if c:
                parts.append(word[at:i])
                at = i
        logs = [pieces.logs[pieces.index[p]] if p in pieces.index else pieces.spare(p) if len(p) == 1 else -math.inf for p in parts]
        out = np.logaddexp(out, sum(logs))
    return float(out)


def test_lattice_is_the_sum_over_segmentations():
    pieces = lattice.Pieces.start(public_tokenizers.path("piece_bpe_32k.model"))
    words = ["a", "the", "lattice", "straße", "日本", "zq🙂x", "the"]
    assert pieces.marginal(words).tolist() == pytest.approx([all_segmentations(pieces, w) for w in words], rel=1e-9)
    long = "abß🙂" * 100
    total = np.zeros(len(pieces.logs))
    short = "straße🙂the"
    pieces.use(lattice.MARK + short, 2.0, total)  # the way of long words, over a short one
    assert total == pytest.approx(pieces.expected([short], np.array([2.0])), abs=1e-9)
    assert pieces.expected([long], np.array([1.0])).sum() > len(long) / 8
    assert pieces.marginal([long])[0] == pytest.approx(pieces.forward(pieces.arcs(np.frombuffer((lattice.MARK + long).encode("utf-32-le"), "<u4").astype(np.uint64)[None, :]), 1, 401)[0, -1], rel=1e-9)
    assert math.exp(pieces.end) + np.exp(pieces.logs).sum() == pytest.approx(1, abs=1e-6)


def test_lattice_scores(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    split = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for i, t in texts.items()}
    taught = [i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for i in taught for w in split[i])
    n, v = sum(c.values()) + len(taught), len(c) + 1
    rows = lattice.op7_lattice_score(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = split[r.doc_id]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws) + math.log10((len(taught) + 0.5) / (n + 0.5 * (v + 1)))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id not in taught, len(ws) + 1, sum(w in c for w in ws) + 1, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 1.6 * sum(r.base_score for r in held)


def test_lattice_edges(spark):
    df = spark.createDataFrame([(1, None, True), (2, "", True), (2, "", True), (3, "x" * 900, False)], "doc_id long, text string, taught boolean")
    got = lattice.score(df, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(1, 1, 1, 3), (2, 1, 1, 3), (2, 1, 1, 3), (3, 2, 1, 3)]
    assert lattice.score(df.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_wand_is_exhaustive():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(80)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(4, 60))) + ". " + " ".join(rng.choices(words, k=6)) + ".") for i in range(60)]
    df = Counter(t for _, x in items for t in set(decontaminate.terms(x)))
    index = decontaminate.Index(items, df, len(items), decontaminate.PART)
    for _ in range(60):
        query = set(rng.sample(range(len(index.vocabulary)), rng.randrange(1, 60)))
        scores = Counter()
        for t in query:
            for part, s in zip(*index.postings[t]):
                scores[part] += s
        assert {p for p, _ in index.retrieve(query)} == {p for p, s in scores.items() if s >= index.least[p] - 1e-9}
    finder = decontaminate.Finder(index)
    for _ in range(40):  # no passage that some part is retrieved for is left out
        ids = np.array(rng.choices(range(len(index.vocabulary)), k=400))
        _, planted = rng.choice(items)
        at = rng.randrange(300)
        ids = np.insert(ids, at, [index.vocabulary[t] for t in decontaminate.terms(planted)])
        last = max(0, -(-(len(ids) - decontaminate.PASSAGE) // decontaminate.STRIDE))
        passages = [set(ids[k * decontaminate.STRIDE : k * decontaminate.STRIDE + decontaminate.PASSAGE].tolist()) for k in range(last + 1)]
        assert {k for k, q in enumerate(passages) if index.retrieve(q)} <= set(finder.passages(ids))


def test_contamination(spark, sf_dir):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    plain = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    texts = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = {(d, i) for d, t in texts.items() for i, b in items.items() if plain(b) and f" {plain(b)} " in f" {t} "}
    got = {(r.doc_id, r.item_id) for r in decontaminate.op8_decontamination(spark, sf_dir).collect()}
    assert want <= got and len(got) <= len(want) + 1
    item = min(items)
    docs = frame(spark, [None, "", "filler " * 5000 + items[item] + " filler" * 9000, items[item].split(".")[0], items[item], items[item]])
    found = decontaminate.contamination(docs, spark.createDataFrame([(item, items[item]), (-1, None), (-2, "")], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(2, item), (4, item), (5, item)]
    assert decontaminate.contamination(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(sorted(values), 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
            root[find(a)] = find(b)
    return {frozenset(w for w in values if find(w) == r) for r in {find(v) for v in values}}


def test_simhash(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    groups = {v: g for g in brute_components(set(fps.values())) for v in g}
    least = {}
    for i, v in fps.items():
        least[groups[v]] = min(i, least.get(groups[v], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op9_simhash_near_dedup(spark, sf_dir).collect()}
    assert got == {i: (f"{v:016x}", least[groups[v]]) for i, v in fps.items()}


@pytest.mark.parametrize("bucket", [24, 2, 1])
def test_crowded_keys_lose_no_link(spark, bucket):
    rng = random.Random(bucket)
    values = {0}
    for _ in range(6):
        base = rng.getrandbits(64) - 2**63
        for _ in range(12):
            values.add(base)
            for _ in range(rng.randrange(1, 4)):
                base ^= (1 << rng.randrange(63))
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    rooted = {r.u: r.root for r in components.components(simhash.links(df, bucket)).collect()}
    found = {frozenset(w for w in values if rooted.get(w, w) == r) for r in {rooted.get(v, v) for v in values}}
    assert found == brute_components(values)


def test_near_duplicate_edges(spark):
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(frame(spark, [None, "", " \t", "a b", "a  B", "one two three four"])).collect()}
    assert [got[i] for i in range(3)] == [(0, 0)] * 3 and got[3][1] == got[4][1] == 3 and got[5][1] == 5
    assert simhash.near_duplicates(frame(spark, ["x"]).limit(0)).count() == 0


@pytest.fixture(scope="module")
def machine(spark):
    base = "/root/testdata/sf0.01"
    return toxicity.learned(spark, spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet"))


def found_of_held_out(spark, machine, base):
    """(toxic found, toxic, clean rejected, clean) among held-out rows."""
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{base}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    rows = [r for r in toxicity.scored(spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text"), machine).collect() if r.doc_id in labels]
    assert all(0 <= r.score <= 1 for r in rows)
    toxic, clean = ([r.score >= 0.3 for r in rows if labels[r.doc_id] == k] for k in (1, 0))
    return sum(toxic), len(toxic), sum(clean), len(clean)


def test_toxicity_held_out(spark, machine):
    found, toxic, rejected, clean = found_of_held_out(spark, machine, "/root/testdata/sf0.01")
    assert found >= 0.5 * toxic and rejected <= 0.02 * clean


def test_toxicity_held_out_of_more_rows(spark):
    base = "/root/testdata/sf0.1"
    learned = toxicity.learned(spark, spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet"))
    found, toxic, rejected, clean = found_of_held_out(spark, learned, base)
    assert found >= 0.85 * toxic and rejected <= 0.02 * clean
    hidden = ["id.iot", "i.d.i.o.t", "st*upid", "stuupid", "s t u p i d", "garden", "winter"]
    tops = toxicity.Scorer(learned).tops([f"a {w} of it" for w in hidden])[:, 0]
    assert min(tops[:5]) > max(tops[5:]) + 0.5


def brute_kernel(a, b):
    """Gapped subsequences within words, counted one by one."""

    def subsequences(piece):
        out = Counter()
        for chunk in toxicity.chunks(piece):
            for f in toxicity.forms(chunk):
                word = f"\1{f}\2"
                for offsets in toxicity._OFFSETS:
                    for i in range(len(word) - offsets[-1]):
                        out[tuple(word[i + o] for o in (0, *offsets))] += toxicity.DECAY ** (offsets[-1] + 1)
        return out

    norm = lambda p: math.sqrt(sum(toxicity.norms(np.array([len(f)]))[0] for c in toxicity.chunks(p) for f in toxicity.forms(c)))
    x, y = subsequences(a), subsequences(b)
    return sum(x[k] * y[k] for k in x.keys() & y.keys()) / norm(a) / norm(b)


def test_toxicity_kernel_is_the_table():
    """A decision through the table is the weighted sum of kernels with landmarks."""
    landmarks, pieces, w = ["you idiot", "i.d.i.o.t!", "a green garden"], ["such an idiot", "gardener", "x", "i d i o t"], [1.0, -0.5, 0.25]
    weights = np.zeros(toxicity.TABLE)
    for piece, v in zip(landmarks, w):
        listed = [f for c in toxicity.chunks(piece) for f in toxicity.forms(c)]
        codes, _ = toxicity.letters(listed)
        for _, entry, weight in toxicity.subsequences(codes):
            np.add.at(weights, entry, v * weight / math.sqrt(toxicity.norms(np.array([len(f) for f in listed])).sum()))
    scorer = toxicity.Scorer(toxicity.Machine(weights, 0.1, np.zeros(toxicity.TOP + 1)))
    got = [float(value[0]) for _, _, value in scorer.rated(pieces)]
    want = [0.1 + sum(v * brute_kernel(p, x) for x, v in zip(landmarks, w)) for p in pieces]
    assert got == pytest.approx(want, abs=0.01)  # some subsequences share a table entry
    assert want[0] > 0.4 > want[1]


def test_toxicity_pieces():
    words = toxicity.Words()
    at = words.numbers("One two three four. Five! Six seven, eight s t u p i d nine")
    words.fresh()
    spelled = list(words.place)
    begins = [*words.pieces(at).tolist(), len(at)]
    assert [" ".join(spelled[i] for i in at[p:q]) for p, q in zip(begins, begins[1:])] == ["one two three", "four.", "five!", "six seven, eight", "stupid nine"]


def test_toxicity_edges(spark, machine):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "word " * 30000, "x"), (3, "word " * 30000, "x")], "doc_id long, text string, score string")
    got = toxicity.scored(df, machine)
    assert got.columns == ["doc_id", "text", "score"] and len({r.score for r in got.where("doc_id < 3").collect()}) == 1 and got.count() == 4
    assert toxicity.scored(df.limit(0), machine).count() == 0
    nothing = toxicity.fit(frame(spark, ["a"]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert 0 <= toxicity.scored(frame(spark, ["a"]), nothing).first().score < 0.3


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"]
    kept = docs
    for name, stage in pipeline.STAGES[:-1]:
        before, kept = kept, spark.createDataFrame(stage(spark, kept, sf_dir).collect(), docs.schema)
        assert kept.columns == docs.columns
        gone = {r[0] for r in before.select("doc_id").collect()} - {r[0] for r in kept.select("doc_id").collect()}
        if name == "near_dedup":
            assert simhash.near_duplicates(kept).where("doc_id != component_id").count() == 0
            assert gone == {r[0] for r in simhash.near_duplicates(before).where("doc_id != component_id").select("doc_id").collect()}
        if name == "decontamination":
            assert decontaminate.contamination(kept, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).count() == 0
        if name == "pii":
            assert not gone and kept.where(F.length("text") != F.col("n_chars")).count() == 0
    last = pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert sorted(map(tuple, pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, last.collect()))


def test_pipeline_on_nothing_and_nulls(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (7, None, "en", "s", 0), (7, None, "en", "s", 0)], docs.schema)
    for rows, least in ((docs.limit(0), 0), (odd, 2)):
        for _, stage in pipeline.STAGES:
            rows = stage(spark, rows, sf_dir)
        assert rows.count() == least


@pytest.mark.parametrize("heads", [8, 1])
def test_lightly_edited_copies_are_near_duplicates(spark, heads):
    """Of two texts that stay none have 5-word similarity 0.8; each that goes has it to the one it is named after."""
    rng = random.Random(7)
    texts = [None, "", "one two"]
    for _ in range(6):
        base = [f"w{rng.randrange(4000)}" for _ in range(150)]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(4000)}"
            texts.append(" ".join(copy))
    sets = [set(simhash.shingles((t or "").encode(), 5)) for t in texts]
    similar = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    kept, want = [], {}
    for i in range(len(texts)):
        want[i] = next((k for k in kept if similar(i, k)), i)
        if want[i] == i:
            kept.append(i)
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, texts), heads=heads).collect()} == want
    assert 10 < len(kept) < len(texts) - 20


def test_fingerprint_group_edges(spark):
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.fingerprint_groups(frame(spark, [None, "", " \t", "a b", "a  B", "one two three four"])).collect()}
    assert [got[i] for i in range(3)] == [(0, 0)] * 3 and got[3][1] == got[4][1] == 3 and got[5][1] == 5
    assert simhash.fingerprint_groups(frame(spark, ["x"]).limit(0)).count() == 0


def test_cut_and_edited_items_are_found(spark):
    item = "A farmer has seventeen sheep and sells all but nine of them before the cold winter comes. How many sheep are left to feed on the farm? It is nine sheep."
    question, words = item.rsplit("? ", 1)[0] + "?", item.split()
    edited = [" ".join(words[:i] + ["changed"] + words[i + 1 :]) for i in range(len(words))]
    docs = frame(spark, ["filler " * 80 + t + " filler" * 80 for t in (question, *edited, "nothing of it")])
    found = {r.doc_id: r for r in decontaminate.contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert set(found) == set(range(len(edited) + 1)) and found[0].item_overlap > 0.8 > 0.5 > found[0].answer_overlap


def test_clashing_columns_of_models(spark, sf_dir):
    """Extra columns with names of results or of steps on the way."""
    names = "fp component_id n x key block word c taught item_id bm25 first_word n_found tops".split()
    df = frame(spark, [None, "", "mail a@b.org now", "mail a@b.org now"]).select("doc_id", "text", *[F.lit("old").alias(n) for n in names])
    out = pii.pseudonymise(df, "k", found="n_found")
    assert out.columns == df.columns and {r.doc_id: r.n_found for r in out.collect()} == {0: 0, 1: 0, 2: 1, 3: 1}
    assert {r.doc_id: r.component_id for r in simhash.fingerprint_groups(df).collect()} == {0: 0, 1: 0, 2: 2, 3: 2}
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()} == {0: 0, 1: 0, 2: 2, 3: 2}
    scores = lattice.score(df.withColumn("taught", F.lit(True)), public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert sorted(r.n_tokens for r in scores) == [1, 1, 4, 4]
    named = df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    items = spark.createDataFrame([("i", "mail a@b.org now")], "item_id string, text string")
    found = decontaminate.contamination(named, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [("d2", "i"), ("d3", "i")]
    assert lattice.score(named.withColumn("taught", F.lit(True)), public_tokenizers.path("piece_bpe_32k.model")).count() == 4


def test_rows_without_an_id_are_not_held_out(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for op in (lattice.op7_lattice_score, toxicity.op10_toxicity):
        rows = {r.doc_id: r for r in op(spark, str(tmp_path)).collect()}
        assert rows[None].held_out is False and len(rows) == 2


def test_large_keys_are_joined_by_broadcast(spark):
    from milldam.llm.common import join_named

    rows = spark.createDataFrame([(i, 0 if i < 50 else i) for i in range(100)], "doc_id long, k long")
    named = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
    for heavy in (1, 3, 1000):
        assert sorted((r.doc_id, r.least) for r in join_named(rows, named, "k", heavy=heavy).collect()) == [(i, 0 if i < 50 else i) for i in range(100)]
