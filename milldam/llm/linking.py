"""Links between sets that share keys, without pairing out a key that many share.

Only connected components matter, so pairs that links found so far already connect need no look:

1. every set meets the heads of its keys (a key's head is its least set),
2. in keys with few strays (sets outside of the key's largest component), the strays meet all others.

Keys with many strays are crowded and handed back, for the caller to split them by better keys, or for exhausted(), which
compares some heads, then more, with all sets outside of their components until each group is done. There bitmaps, which can
only understate how far two sets differ, leave few pairs over.
Pairs are verified by their whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import compact, durable, join_named
from .components import components

#: Strays of a key that meet all of its sets.
STRAYS = 16
#: Heads that a group is compared with in the first round of exhausted(), which links most of it, and in a later one; sets that meet them in a task;
#: bytes of a set's bitmap at least, and at most.
HEADS, MOST, PART, BYTES, LARGEST = 64, 4096, 2048, 128, 8192
#: Ranks that the planner limits below a shuffle.
RANKS = 1000


@dataclass
class Sets:
    """The sets by their digests: sizes and bitmaps of all (fp, n, bits), and how those of some (fp) are got whole (fp, x)."""

    maps: DataFrame
    whole: Callable[[DataFrame], DataFrame]


def verified(pairs: DataFrame, sets: Sets, percent: int, told: bool = False) -> DataFrame:
    """Of pairs (u, v) those whose sets have at least this similarity, written. Only sets that bitmaps do not tell apart (told: as their
    pairs were chosen by bitmaps, all) are got whole."""
    pairs = pairs.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    near, n = compact(pairs if told else apart(pairs, sets.maps, percent))
    if not n:
        return near
    whole = sets.whole(near.select(F.explode(F.array("u", "v")).alias("fp")).distinct())
    held = near.join(whole.select(F.col("fp").alias("u"), F.col("x").alias("ux")), "u").join(whole.select(F.col("fp").alias("v"), F.col("x").alias("vx")), "v")
    common = held.select("u", "v", (F.size("ux") + F.size("vx")).alias("both"), F.size(F.array_intersect("ux", "vx")).alias("c"))
    return compact(common.where(100 * F.col("c") >= percent * (F.col("both") - F.col("c"))).select("u", "v"))[0]


def apart(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose sizes and bitmaps (fp, n, bits) do not tell them apart."""
    side = lambda x: maps.select(F.col("fp").alias(x), F.col("n").alias(f"{x}n"), F.col("bits").alias(f"{x}b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("un").to_numpy() + batch.column("vn").to_numpy()
            bits = differing(batch.column("ub").to_pylist(), batch.column("vb").to_pylist())
            yield batch.select(["u", "v"]).filter(pa.array(bits <= both * (100 - percent) // (100 + percent)))

    sized = 100 * F.least("un", "vn") >= percent * F.greatest("un", "vn")
    return pairs.join(side("u"), "u").join(side("v"), "v").where(sized).mapInArrow(run, "u long, v long")


def merged(stars: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components of stars (u, root) and links (u, v), as stars, written."""
    if stars is None:
        return compact(components(links))[0]
    if links.isEmpty():
        return stars
    return compact(components(stars.withColumnRenamed("root", "v").union(links)))[0]


def rooted(members: DataFrame, stars: DataFrame) -> DataFrame:
    """members with the component (comp) of each set; written."""
    roots = stars.withColumnRenamed("u", "fp")
    return compact(members.drop("comp").join(roots, "fp", "left").withColumn("comp", F.coalesce("root", "fp")).drop("root"))[0]


def unsettled(members: DataFrame) -> DataFrame:
    """(key, main, n, size, strays) of keys whose sets are in several components: the largest of them, the sets (twice), and those outside of it."""
    sizes = members.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key")
    keys = sizes.agg(F.max(F.struct("c", "comp")).alias("m"), F.sum("c").alias("n"), F.count("*").alias("kinds")).where("kinds > 1")
    return keys.select("key", F.col("m.comp").alias("main"), "n", F.col("n").alias("size"), (F.col("n") - F.col("m.c")).alias("strays"))


def headed(members: DataFrame) -> DataFrame:
    """(u, v): each set with the head of each of its keys."""
    heads, _ = compact(members.groupBy("key").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1"))
    return join_named(members.select("key", F.col("fp").alias("u")), heads, "key").where("u != v").select("u", "v")


def linked(members: DataFrame, sets: Sets, percent: int, strays: int = STRAYS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """members (key, fp, ...), written, one row for a key and set -> components by the first step, the second's links, and the members of crowded
    keys with their comp."""
    stars = merged(None, verified(headed(members), sets, percent))
    placed = rooted(members, stars)
    open_, _ = compact(join_named(placed, compact(unsettled(placed))[0], "key"))
    few = open_.where(F.col("strays") <= strays)
    out = durable(few.where("comp != main").groupBy("key").agg(F.collect_list(F.struct("fp", "comp")).alias("out"), F.max("size").alias("n")))
    pairs = join_named(few, out, "key").select("fp", "comp", F.explode("out").alias("o")).where("comp != o.comp").select(F.col("fp").alias("u"), F.col("o.fp").alias("v"))
    return stars, verified(pairs, sets, percent), open_.where(F.col("strays") > strays).drop("main", "size", "strays")


def close(members: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """The links of all pairs of sets (fp) under keys that few sets have."""
    rows = members.groupBy("key").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    pairs = rows.select(F.explode("fps").alias("u"), "fps").select("u", F.explode("fps").alias("v")).where("u < v")
    return verified(pairs, sets, percent)


def bitmap(values: np.ndarray) -> bytes:
    """Parities of the set's members by slot: two sets differ in at least as many members as their bitmaps do in bits. There are two slots or
    more for a member, within the bounds, as fewer than the differences that similar sets may have tell nothing apart."""
    size = min(max(BYTES, 1 << max(0, (2 * len(values) - 1) // 8).bit_length()), LARGEST)
    odd = np.bincount((values.view(np.uint64) >> np.uint64(7)).astype(np.int64) % (8 * size), minlength=8 * size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (the last axis, in words) as they are with so many words: sizes are powers of two, and the parity of two slots is their sum's."""
    while bits.shape[-1] > size:
        bits = bits[..., : bits.shape[-1] // 2] ^ bits[..., bits.shape[-1] // 2 :]
    return bits


def differing(us: list[bytes], vs: list[bytes]) -> np.ndarray:
    """Bits that the bitmaps of each pair differ in, at the size of the smaller one."""
    out = np.zeros(len(us), np.int64)
    sizes = np.array([(len(u), len(v)) for u, v in zip(us, vs, strict=True)], np.int64).reshape(-1, 2)
    for m, n in np.unique(sizes, axis=0).tolist():
        at = np.flatnonzero((sizes == (m, n)).all(axis=1))
        a, b = (np.frombuffer(b"".join([x[i] for i in at]), np.uint64).reshape(len(at), -1) for x in (us, vs))
        out[at] = np.bitwise_count(folded(a, min(m, n) // 8) ^ folded(b, min(m, n) // 8)).sum(axis=1)
    return out


def _near(percent: int):
    def run(rows: pa.Table, heads: pa.Table) -> pa.Table:
        """(u, v): rows and heads of different components whose bitmaps do not tell them apart."""
        (a, an, ac), (b, bn, bc) = ([t.column(c).to_numpy() for c in ("fp", "n", "comp")] for t in (rows, heads))
        ab, bb = ([np.frombuffer(x, np.uint64) for x in t.column("bits").to_pylist()] for t in (rows, heads))
        us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        sizes = np.array(list(map(len, ab)))
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            own = {size: np.stack([ab[i] for i in at])}
            for k, head in enumerate(bb):
                least = min(size, len(head))
                if least not in own:
                    own[least] = folded(own[size], least)
                most = (an[at] + bn[k]) * (100 - percent) // (100 + percent)
                near = at[(np.bitwise_count(own[least] ^ folded(head, least)).sum(axis=1) <= most) & (ac[at] != bc[k])]
                us.append(a[near])
                vs.append(np.full(len(near), b[k]))
        return pa.table({"u": np.concatenate(us), "v": np.concatenate(vs)})

    return run


def met(rows: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """(u, v): rows (key, fp, n, comp, bits, size) of a group (key) and its chosen ones (fp) that may be similar, of different components. A group
    meets them in parts of bounded size."""
    columns = ("key", "part", "fp", "n", "comp", "bits")
    parts = F.ceil(F.col("size") / PART).cast("int")
    own = rows.withColumn("part", F.pmod(F.xxhash64("fp"), parts).cast("int")).select(*columns)
    spread = rows.join(chosen, "fp", "left_semi").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select(*[F.col(c).alias(c) for c in columns])
    return own.groupBy("key", "part").cogroup(spread.groupBy("key", "part")).applyInArrow(_near(percent), "u long, v long")


def leading(rows: DataFrame, sets: Sets, percent: int, heads: int = HEADS) -> DataFrame:
    """rows (key, fp, at): components of similar sets and the sets' rank in them -> (fp, kept): those that go, and the rank of the first that stays for
    them. In order of rank a set stays unless it is similar to one that stays. The first of a component meet all of it, more each round."""
    members = durable(rows.join(sets.maps, "fp"))
    gone, order = None, F.struct("at", "fp")
    while not members.isEmpty():
        sizes, _ = compact(members.groupBy("key").agg(F.count("*").alias("n"), F.count("*").alias("size")))
        here = durable(join_named(members, sizes.select("key", F.col("n").alias("many"), "size"), "key", "many").withColumn("comp", F.col("fp")))
        place = F.row_number().over(Window.partitionBy("key").orderBy("at", "fp"))  # a limit of ranks reaches below the shuffle
        first, _ = compact(here.select("key", "at", "fp").withColumn("place", place).where(F.col("place") <= heads).drop("place"))
        links = verified(met(here, first.select("fp"), percent), sets, percent, True)
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ranked = both.join(first.select(F.col("fp").alias("v"), order.alias("before")), "v").join(here.select(F.col("fp").alias("u"), order.alias("mine")), "u")
        ranked, _ = compact(ranked.where("before < mine").select("u", "v", F.col("before.at").alias("at")))
        stay, _ = compact(first.select("fp").join(ranked.select(F.col("u").alias("fp")), "fp", "left_anti"))
        goes, _ = compact(ranked.join(stay.withColumnRenamed("fp", "v"), "v", "left_semi").groupBy(F.col("u").alias("fp")).agg(F.min("at").alias("kept")))
        gone = goes if gone is None else compact(gone.union(goes))[0]
        members, heads = durable(members.join(stay.union(goes.select("fp")), "fp", "left_anti")), min(4 * heads, RANKS)
    return rows.select("fp", F.lit(None).cast(rows.schema["at"].dataType).alias("kept")).limit(0) if gone is None else gone


def exhausted(members: DataFrame, sets: Sets, percent: int, stars: DataFrame, heads: int = HEADS) -> DataFrame:
    """Components with the links of all pairs of sets that share a key (members: key, fp). Keys that share sets are one group, so that a
    pair is looked at once; heads are drawn by digests, and meet the group's sets in parts of bounded size."""
    groups = merged(None, headed(members).distinct()).select(F.col("u").alias("fp"), F.col("root").alias("key"))
    members, turn = rooted(groups.join(sets.maps, "fp"), stars), 0
    while True:
        keys, n = compact(unsettled(members).select("key", "n", "size"))
        if not n:
            return stars
        drawn = F.pmod(F.xxhash64("fp", F.lit(turn)), F.lit(1 << 20))
        here = durable(join_named(members, keys, "key").withColumn("drawn", drawn))
        first = here.groupBy("key").agg(F.min(F.struct("drawn", "fp")).alias("f")).select(F.col("f.fp").alias("fp"))
        chosen, _ = compact(here.where(F.col("drawn") * F.col("size") < heads << 20).select("fp").union(first).distinct())
        stars = merged(stars, verified(met(here, chosen, percent), sets, percent, True))
        rest = here.join(chosen, "fp", "left_anti").select("key", "fp", "n", "bits")
        members, heads, turn = rooted(rest, stars), MOST, turn + 1
