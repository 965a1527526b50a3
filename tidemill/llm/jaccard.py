"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct five-word shingles. Two documents a <= b (sizes) with a Jaccard similarity of at least 75 %
differ in at most (a + b) / 7 <= a / 3 shingles. Sets are cut into blocks by hash, and the XOR of a block's hashes is its parity: each
differing shingle changes one block at most, so of a document's d + 1 first blocks, d being its largest allowed difference, at least
one equals a block among the partner's first ones (pigeonhole, with one order of blocks for all). Blocks are made per size band.
Shingles that very many documents share stand alone, after all blocks, so they are keys only of documents that have little else;
which shingles those are changes the work and never the result. Candidates pass if the Hamming distance of parity sketches (two bits or
more for each shingle, as a power of two; the wider of two is folded), a lower bound of the difference, allows it. They are then verified
on all shingles of both texts, as 64-bit hashes.

Links are wanted up to connectivity: documents with the same words are one node, each bucket's members are first compared with its
smallest, and then only members that are still in different components are compared with each other.

Defined results: null, empty and blank texts have no shingles and no links; texts under five words are one shingle; rows
with one doc_id are one document; a null doc_id has no links and no component; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import bounded, bucketed, discard, documents, partitions, swept, text_of, trimmed, written
from tidemill.llm.graph import components
from tidemill.llm.shingles import canonical, common, mixed, shingles

NUMERATOR, DENOMINATOR = 75, 100
LEAST_SKETCH, MOST_SKETCH = 8, 512  # 64-bit words of a sketch
RATIO = 4  # of a size band's ends
SINGLE = 512  # bands from under this size have one shingle to a block
PLAIN, FEW, MANY = 0, 1, 2  # keys of shingles that aren't frequent; of frequent ones, in sets with few or many others
OFTEN_HERE = 3  # of a task's documents: what counts as frequent there
TALLY = 200_000  # shingles that a task counts at a time
OFTEN = 400_000  # frequent shingles that are told apart, the most frequent ones (6.4 MB with their ranks)
BLOCK = 3000  # members that meet as many others in one task
WORDS = 4_000_000  # of sketches that are compared at a time
SALTS = 64  # parts of a frequent shingle's bucket
SMALL = 8  # members of a bucket that meet by a join
ROWS, BUCKETS = 150_000, 10_000  # members to a bucket of their tables (some 4 MB), and most buckets; beyond, buckets grow and sorts spill
ROUNDS = 2  # of comparing each bucket with one of its members


def size_band(s: int) -> int:
    band, low = 0, 1
    while s >= low * RATIO:
        band, low = band + 1, low * RATIO
    return band


def bands(s: int) -> list[tuple[int, int]]:
    """(band, allowed difference) of the bands in which a set of s shingles takes part: its own, and the one below if a partner can lie there."""
    own = size_band(s)
    out = [(own, s // 3)]
    low = RATIO**own
    if own and (low - 1) * 4 >= s * 3:  # the largest set of the band below reaches 75 % of s
        out.append((own - 1, 2 * s // 7))
    return out


def keys(tokens: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket keys of a set (sorted hashes) and their kinds. often: frequent shingles, sorted, and their ranks, the rarer first.

    Two sets that share no plain key, each having more plain shingles than a seventh of its size, differ in more than (a + b) / 7: so
    of two MANY keys nothing follows, and only pairs with a FEW or PLAIN one are candidates.
    """
    values, rank = often
    at = np.minimum(np.searchsorted(values, tokens), max(0, len(values) - 1))
    hot = values[at] == tokens if len(values) else np.zeros(len(tokens), bool)
    cold = tokens[~hot]
    late = tokens[hot][np.argsort(rank[at[hot]], kind="stable")] if len(values) else tokens[:0]
    out, kinds = [], []
    for band, allowed in bands(len(tokens)):
        low = np.uint64(RATIO**band)
        salt = mixed(np.array([band + 1], np.uint64))[0]
        block = mixed(cold ^ salt)
        if low >= SINGLE:
            block = block % (low * np.uint64(8))
        order = np.argsort(block, kind="stable")
        block, value = block[order], mixed(cold[order])
        first = np.flatnonzero(np.diff(block, prepend=block[:1] + np.uint64(1)))
        parity = np.bitwise_xor.reduceat(value, first) if len(first) else value
        items = mixed(mixed(block[first] + salt) + parity)[: allowed + 1]
        kind = np.zeros(len(items), np.int8)
        if len(items) <= allowed:
            kind = np.concatenate([kind, np.full(allowed + 1 - len(items), MANY if low < SINGLE and len(cold) * 7 > len(tokens) else FEW, np.int8)])
            items = np.concatenate([items, mixed(late[: allowed + 1 - len(items)] ^ mixed(np.array([~salt]))[0])])
        if len(items) <= allowed:
            raise ValueError("too few blocks for the pigeonhole; another hash is needed")
        out.append(items)
        kinds.append(kind)
    return np.concatenate(out), np.concatenate(kinds)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity bits as 64-bit words: each shingle flips one of at least two bits a shingle (within the bounds of a sketch's size)."""
    words = min(MOST_SKETCH, max(LEAST_SKETCH, 1 << max(0, (len(tokens) - 1) // 32).bit_length()))
    bit = (mixed(tokens + np.uint64(77)) % np.uint64(64 * words)).astype(np.int64)
    odd = (np.bincount(bit, minlength=64 * words) & 1).astype(np.uint64).reshape(words, 64)
    return (odd << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)


def halved(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows) folded to a smaller width: what they would have been at it."""
    while sketches.shape[-1] > words:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    words = min(x.shape[-1], y.shape[-1])
    return np.bitwise_count(halved(x, words) ^ halved(y, words)).sum(-1, dtype=np.int64)


def packed(words: bytes) -> bytes:
    """Words for storage and shuffles; none stay none, and equal words become equal bytes."""
    return zstandard.ZstdCompressor(level=3, write_checksum=False).compress(words) if words else b""


def unpacked(words: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(words) if words else b""


def _addressed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for lo in range(0, len(b), 500):
            part = b.iloc[lo : lo + 500]
            rows = []
            for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                words = canonical(text)
                digest = hashlib.blake2b(words, digest_size=16).digest()
                rows.append((doc_id, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True), packed(words)))
            yield pd.DataFrame(rows, columns=["doc_id", "k", "k2", "words"])


def tallied(values: np.ndarray, counts: np.ndarray, new: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """values (sorted, distinct) and their counts, which are changed, with each item of new added. Takes little beyond the result: a sort of all
    values, as np.unique would make, takes several times their memory."""
    items = np.concatenate(new)
    items.sort()
    first = np.flatnonzero(np.diff(items, prepend=items[:1] + np.uint64(1)))
    found, times = items[first], np.diff(first, append=len(items)).astype(counts.dtype)
    at = np.searchsorted(values, found)
    known = np.zeros(len(found), bool)
    inside = at < len(values)
    known[inside] = values[at[inside]] == found[inside]
    counts[at[known]] += times[known]
    return np.insert(values, at[~known], found[~known]), np.insert(counts, at[~known], times[~known])


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each node its size and sketch; then, as rows without k, the shingles of at least OFTEN_HERE of this task's nodes, with their
    number there. Counts are merged in rounds, so memory is bounded."""
    values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int32)
    parts, waiting, size = [values], 0, 0
    for b in batches:
        sizes, sketches = [], []
        for words in b["words"]:
            s = shingles(unpacked(words))
            sizes.append(len(s))
            sketches.append(sketch(s).tobytes())
            parts.append(s)
            waiting, size = waiting + len(s), size + len(s)
            if waiting > TALLY or size > 1_000_000:
                values, counts = tallied(values, counts, parts)
                parts, waiting = [values[:0]], 0
            if size > 1_000_000:
                size = 0
                if len(values) > 2_000_000:
                    values, counts = values[counts > 1], counts[counts > 1]
        yield pd.DataFrame({"k": b["k"], "n": sizes, "t": 0, "sketch": sketches})
    values, counts = tallied(values, counts, parts)
    keep = counts >= OFTEN_HERE
    values, counts = values[keep].astype(np.int64), counts[keep].astype(np.int64)
    for lo in range(0, max(1, len(values)), TALLY):
        part = slice(lo, lo + TALLY)
        yield pd.DataFrame({"k": pd.array([None] * len(values[part]), "Int64"), "n": counts[part], "t": values[part], "sketch": None})


def _keys(often):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found, size = [], 0
            for k, text in zip(b["k"], b["words"], strict=True):
                tokens = shingles(unpacked(text))
                if len(tokens):
                    items, kinds = keys(tokens, often.value)
                    found.append((items.astype(np.int64), np.full(len(items), k, np.int64), kinds))
                    size += len(items)
                if size > 200_000:
                    yield pd.DataFrame(dict(zip("bkt", map(np.concatenate, zip(*found, strict=True)), strict=True)))
                    found, size = [], 0
            if found:
                yield pd.DataFrame(dict(zip("bkt", map(np.concatenate, zip(*found, strict=True)), strict=True)))

    return run


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs that the sketches allow: their Hamming distance isn't over the largest difference of a linked pair."""
    for b in batches:
        for (wa, wb), part in b.groupby([b["sketcha"].str.len() // 8, b["sketchb"].str.len() // 8]):
            x, y = (np.frombuffer(b"".join(part[c]), np.uint64).reshape(len(part), w) for c, w in (("sketcha", wa), ("sketchb", wb)))
            yield part.loc[distances(x, y) * 7 <= (part["na"] + part["nb"]).to_numpy(), ["ka", "kb"]]


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs that link. Few sets are remembered, pairs with one partner being neighbours."""
    kept: OrderedDict[int, np.ndarray] = OrderedDict()

    def of(k: int, text: str) -> np.ndarray:
        if k not in kept:
            kept[k] = shingles(unpacked(text))
            if len(kept) > 16:
                kept.popitem(last=False)
        return kept[k]

    for b in batches:
        linked = []
        for ka, kb, ta, tb in zip(b["ka"], b["kb"], b["words_a"], b["words_b"], strict=True):
            x, y = of(ka, ta), of(kb, tb)
            both = common(x, y)
            linked.append(DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both))
        yield b.loc[linked, ["ka", "kb"]]


def verified(pairs: DataFrame, nodes: DataFrame, facts: DataFrame) -> DataFrame:
    """Of pairs (ka, kb: distinct), those that link. nodes: k, words, and facts: k, n and the sketch, both bucketed by k."""
    side = lambda x: facts.select(*[F.col(c).alias(f"{c}{x}") for c in facts.columns])
    near = pairs.join(side("a"), "ka").join(side("b"), "kb").where(F.least("na", "nb") * 4 >= F.greatest("na", "nb") * 3)
    near = near.mapInPandas(trimmed(_near), "ka long, kb long")
    near = written(near.select("ka", "kb"), "jaccard-near")
    full = near.join(nodes.select(F.col("k").alias("ka"), F.col("words").alias("words_a")), "ka").join(nodes.select(F.col("k").alias("kb"), F.col("words").alias("words_b")), "kb")
    found = written(full.mapInPandas(trimmed(_verified), "ka long, kb long"), "jaccard-links")
    discard(near)
    return found


def _apart(rest: DataFrame, comps: DataFrame, buckets: int) -> DataFrame:
    """rest (b, k, n, t, weight: members that haven't met all others), with components, of the buckets that still hold several; bucketed by b."""
    whole = Window.partitionBy("b")
    x = rest.join(bounded(comps), "k", "left").select("b", "k", "n", "t", "weight", F.coalesce("component", "k").alias("c"))
    x = x.withColumns({"c1": F.min("c").over(whole), "c2": F.max("c").over(whole), "one": F.min("t").over(whole)})
    return bucketed(x.where(f"c1 != c2 and one < {MANY}").select("b", "k", "n", "t", "weight", "c"), "b", "jaccard_apart", buckets)


def _several(buckets: DataFrame) -> DataFrame:
    """(b, k, size, t), stored: members of buckets that hold several, of which one isn't a MANY key. Plain keys are rare. Keys of frequent
    shingles may have any number of members: these are dealt by SALTS, counted in each part, and join their buckets' totals, a join that Spark
    splits where it is skewed."""
    part = Window.partitionBy("b", "salt")
    salted = buckets.withColumn("salt", F.when(F.col("t") == PLAIN, 0).otherwise(F.pmod(F.xxhash64("k"), F.lit(SALTS)).cast("int")))
    stats = salted.withColumns({"least": F.min("k").over(part), "most": F.max("k").over(part), "size": F.count("*").over(part)})
    found = written(stats.where(f"t != {PLAIN} or least != most").select("b", "k", "size", "t"), "jaccard-keys")
    hot = found.where(f"t != {PLAIN}")
    totals = hot.groupBy("b").agg(F.min("k").alias("least"), F.max("k").alias("most"), F.min("t").alias("one"), F.count("*").alias("size"))
    totals = totals.where(f"least != most and one < {MANY}").select("b", "size")
    out = written(found.where(f"t = {PLAIN}").unionAll(hot.drop("size").join(totals, "b").select("b", "k", "size", "t")), "jaccard-buckets")
    discard(found)
    return out


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one cell of the grid, the pairs of its two blocks (or within its one) that the sketches allow."""
    pdf = pdf.assign(w=pdf["sketch"].str.len() // 8).sort_values(["w", "k"])
    first, second = pdf[pdf["chunk"] == pdf["x"]], pdf[pdf["chunk"] == pdf["y"]]
    out = []
    for w, part in second.groupby("w"):
        sketches = np.frombuffer(b"".join(part["sketch"]), np.uint64).reshape(len(part), w)
        folded = {w: sketches}
        n, k, c, few = part["n"].to_numpy(np.int64), part["k"].to_numpy(np.int64), part["c"].to_numpy(np.int64), part["t"].to_numpy() < MANY
        for kx, cx, tx, nx, sx in zip(first["k"], first["c"], first["t"], first["n"], first["sketch"], strict=True):
            at = np.flatnonzero((c != cx) & (k != kx) & (few | (tx < MANY)) & (4 * np.minimum(n, nx) >= 3 * np.maximum(n, nx)))
            if len(at):
                own = np.frombuffer(sx, np.uint64)
                width = min(w, len(own))
                if width not in folded:
                    folded[width] = halved(sketches, width)
                distance = distances(folded[width][at], own)
                out += [(min(kx, x), max(kx, x)) for x in k[at[distance * 7 <= n[at] + nx]].tolist()]
    return pd.DataFrame(out, columns=["ka", "kb"]).astype("int64").drop_duplicates()


def _grid(members: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs (ka, kb) of members (b, k, t, c) that buckets connect, as far as sketches allow them. A group of connected members is cut into
    blocks of about BLOCK, and each two blocks meet in a task of their own: no pair is a row unless it may link."""
    sides = members.select(F.xxhash64("b", F.lit("bucket")).alias("u"), F.xxhash64("k", F.lit("member")).alias("v"))
    group = components(sides).withColumnRenamed("node", "__m")
    x = members.groupBy("k", "c").agg(F.min("t").alias("t")).withColumn("__m", F.xxhash64("k", F.lit("member"))).join(group, "__m").drop("__m")
    x = written(x, "jaccard-groups")
    sizes = x.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    x = x.join(sizes, "component").withColumn("chunk", F.pmod(F.xxhash64("k"), F.col("chunks")).cast("int")).join(facts, "k")  # facts: k, n, sketch
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    x = x.select("component", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "chunk", "k", "c", "t", "n", "sketch")
    return x.groupBy("component", "x", "y").applyInPandas(_block, "ka long, kb long")


def _met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs of each bucket (or of two of its blocks) that the sketches allow. Rows come by bucket and block, then by n; a cell's rows fit in memory."""
    rest = None
    for b in batches:
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        cell = b[["b", "x", "y"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(1)])
        whole, rest = b.iloc[: starts[-1]], b.iloc[starts[-1] :]
        if len(whole):
            yield from _cells(whole, starts)
    if rest is not None:
        yield from _cells(rest, np.zeros(1, np.int64))


def _cells(rows: pd.DataFrame, starts: np.ndarray) -> Iterator[pd.DataFrame]:
    n, k, c, x, y, chunk = (rows[name].to_numpy(np.int64) for name in ("n", "k", "c", "x", "y", "chunk"))
    cell = np.searchsorted(starts, np.arange(len(rows)), side="right") << 40
    # Each row's partners are those after it in its cell, as far as their sizes allow a link.
    first = np.arange(1, len(rows) + 1)
    counts = np.searchsorted(cell + n, cell + 4 * n // 3, side="right") - first
    width = rows["sketch"].str.len().to_numpy(np.int64) // 8
    place, sketches = np.zeros(len(rows), np.int64), {}
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        place[at] = np.arange(len(at))
        sketches[w] = np.frombuffer(b"".join(rows["sketch"].iloc[at]), np.uint64).reshape(len(at), w)
    ends, lo = np.cumsum(counts), 0
    while lo < len(rows):
        done = ends[lo] - counts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, done + WORDS // LEAST_SKETCH, side="right")))
        i = np.repeat(np.arange(lo, hi), counts[lo:hi])
        j = np.arange(done, ends[hi - 1]) - np.repeat(ends[lo:hi] - counts[lo:hi], counts[lo:hi]) + first[i]
        lo = hi
        keep = (c[i] != c[j]) & (k[i] != k[j]) & ((x[i] == y[i]) | (chunk[i] != chunk[j]))
        i, j = i[keep], j[keep]
        out = []
        for wi, wj in {*zip(width[i].tolist(), width[j].tolist(), strict=True)}:
            here = np.flatnonzero((width[i] == wi) & (width[j] == wj))
            step = max(1, WORDS // max(wi, wj))
            for part in (here[at : at + step] for at in range(0, len(here), step)):
                a, b = i[part], j[part]
                near = distances(sketches[wi][place[a]], sketches[wj][place[b]]) * 7 <= n[a] + n[b]
                out.append(np.stack([k[a][near], k[b][near]], 1))
        if out:
            yield pd.DataFrame(np.unique(np.sort(np.concatenate(out), 1), axis=0), columns=["ka", "kb"])


def _within(members: DataFrame, facts: DataFrame, parts: int) -> DataFrame:
    """Pairs (ka, kb) of members (b, k, c, size) of one bucket, as far as sketches allow them. Rows are members with their sketches, as often as their
    bucket has blocks of BLOCK: no pair is a row unless it may link, and a chain of buckets is no larger group."""
    x = members.withColumn("chunks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("chunk", F.pmod(F.xxhash64("k"), F.col("chunks")).cast("int")).join(facts, "k")
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    x = x.select("b", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "chunk", "k", "c", "n", "sketch")
    return x.repartition(parts, "b", "x", "y").sortWithinPartitions("b", "x", "y", "n").mapInPandas(trimmed(_met), "ka long, kb long")


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text"))
    addressed = rows.mapInPandas(trimmed(_addressed), "doc_id long, k long, k2 long, words binary")
    # Documents of the same words collapse before the shuffle: one row of each task for a group of copies.
    grouped = addressed.groupBy("k").agg(F.min("k2").alias("k2"), F.max("k2").alias("other"), F.min("words").alias("words"))
    nodes = bucketed(grouped, "k", "jaccard", partitions(spark))
    swept(spark)
    if not nodes.where("k2 != other").isEmpty():
        raise ValueError("two texts share a 64-bit address; another hash is needed")
    nodes = nodes.select("k", "words").where("octet_length(words) > 0")
    described = bucketed(nodes.mapInPandas(trimmed(_described), "k long, n long, t long, sketch binary"), "k", "jaccard_facts", partitions(spark))
    facts = described.where("k is not null").select("k", "n", "sketch")
    often = described.where("k is null").groupBy("t").agg(F.sum("n").alias("n"))
    top = often.orderBy(F.desc("n"), "t").limit(OFTEN).toPandas()
    values = top["t"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(values)
    shared = spark.sparkContext.broadcast((values[order], (len(values) - order).astype(np.int64)))
    keyed = nodes.mapInPandas(trimmed(_keys(shared)), "b long, k long, t byte")
    found = _several(keyed)
    swept(spark)
    # The member that shares most buckets is compared with all others first: the text that others are copies of has no edits of its own.
    central = found.groupBy("k").agg(F.sum("size").alias("weight")).join(facts.select("k", "n"), "k")
    # Bucketed by b, they aren't shuffled again in the rounds.
    parts = min(BUCKETS, max(1, -(-found.count() // ROWS)))
    many = bucketed(found.join(central, "k").select("b", "k", "n", "t", "weight").repartition(parts, "b"), "b", "jaccard_members", parts)
    discard(found)
    links = tried = None
    near_size = lambda x, y: F.least(x, y) * 4 >= F.greatest(x, y) * 3
    for _ in range(ROUNDS):
        leader = many.groupBy("b").agg(F.max(F.struct(-F.col("t"), "weight", "k", "n")).alias("leader")).select("b", F.col("leader.k").alias("leader"), F.col("leader.n").alias("leader_n"))
        pairs = many.join(leader, "b").where("k != leader").where(near_size("n", "leader_n")).select(F.least("leader", "k").alias("ka"), F.greatest("leader", "k").alias("kb")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["ka", "kb"], "left_anti")
        pairs = written(pairs, "jaccard-pairs")
        tried = pairs if tried is None else tried.unionAll(pairs)
        new = verified(pairs, nodes, facts)
        links = new if links is None else links.unionAll(new)
        comps = components(links.select(F.col("ka").alias("u"), F.col("kb").alias("v"))).withColumnRenamed("node", "k")
        before, many = many, _apart(many.join(leader, "b").where("k != leader").select("b", "k", "n", "t", "weight"), comps, parts)
        discard(before)
        swept(spark)
    # Members of one bucket that are still in different components, and weren't compared yet, meet each other: those of small
    # buckets by a join, of which each row makes SMALL at most, those of larger ones in their bucket. Buckets of frequent shingles, whose members
    # are few documents that share many of them, meet in a grid of blocks.
    large = many.groupBy("b").agg(F.count("*").alias("size"), F.max("t").alias("kind")).where(f"size > {SMALL} or kind != {PLAIN}")
    large = written(large, "jaccard-large")
    rest = many.join(large, "b", "left_anti")
    side = lambda x: rest.select("b", F.col("k").alias(f"k{x}"), F.col("c").alias(f"c{x}"), F.col("n").alias(f"n{x}"))
    pairs = side("a").join(side("b"), "b").where("ka < kb and ca != cb").where(near_size("na", "nb")).select("ka", "kb").distinct()
    pairs = pairs.unionAll(_within(many.join(large.where(f"kind = {PLAIN}"), "b").select("b", "k", "c", "size"), facts, parts))
    hot = many.join(large.where(f"kind != {PLAIN}"), "b").select("b", "k", "t", "c")
    pairs = pairs.unionAll(_grid(hot, facts)).distinct().join(tried, ["ka", "kb"], "left_anti")
    more = verified(pairs, nodes, facts)
    discard(many, large)
    linked = links.unionAll(more)
    # From words to doc_ids: a node's smallest doc_id, then a component's.
    everyone = written(addressed.select("doc_id", "k", (F.octet_length("words") == 0).alias("blank")), "jaccard-members")
    members = everyone.where("not blank")
    of_node = members.groupBy("k").agg(F.min("doc_id").alias("id"))
    comps = components(linked.select(F.col("ka").alias("u"), F.col("kb").alias("v"))).withColumnRenamed("node", "k")
    ids = of_node.join(comps, "k", "left").withColumn("component", F.coalesce("component", "k"))
    smallest = ids.groupBy("component").agg(F.min("id").alias("component_id"))
    answers = ids.join(smallest, "component").select("k", "component_id").join(facts.select("k", "n"), "k")
    found = members.join(answers, "k").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    blank = everyone.where("blank").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionAll(blank)


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those whose component has a smaller doc_id; all columns are kept, and so are rows without doc_id."""
    ids = joined(docs, key, text).where("doc_id != component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(written(ids, "jaccard-gone"), F.col(key).cast("long") == F.col("__gone"), "left_anti")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(documents(spark, sf_dir).select("doc_id", "text"))
