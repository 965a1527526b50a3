"""Exact removal of repeated byte strings by suffix arrays.

Each byte goes that is covered by a WIDTH-byte string which also starts earlier (smaller doc_id, or earlier in the same document).

Documents of the same bytes are one node: of these only the first can keep anything. In each node's text the WIDTH-byte
windows are dealt into fragments by their smallest GRAM-byte hash (and its place), so that equal windows, wherever they are, have one
anchor. Only fragments whose anchor occurs twice or more can repeat; each different fragment goes once, with its first place, to the
shard of its anchor. A shard sorts its fragments in blocks, each by a suffix array that Larsson-Sadakane refinement builds in
numpy; windows that are neighbours there and have a common prefix of WIDTH are equal (prefixes are compared by the refinement's
ranks, which is what Kasai's pass would find, without its loop over bytes in Python); blocks are merged by binary search of their
sorted windows. An anchor with very many fragments (the edges of a passage that many documents share) isn't given to one shard:
its windows meet by digest, with partial aggregation.

Defined results: a null text is the empty text; texts under WIDTH bytes lose nothing; of repeated rows, the first keeps its bytes;
rows without doc_id come last; rows with one doc_id and different texts are ordered by address; an empty table gives an empty
result; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import bucketed, documents, partitions, text_of, written
from tidemill.llm.shingles import coefficients, mixed, powers

WIDTH = 100
GRAM = 32
SHARD_BYTES = 3_000_000
BLOCK_BYTES = 1_000_000
MOST_FRAGMENTS = 30_000  # of one anchor in one shard (4 MB)
PIECE = (1 << 20) - 256  # bytes of a text whose windows are hashed at a time
LAST = (1 << 63) - 1
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def prefix_sums(raw: np.ndarray, which: int) -> np.ndarray:
    """Prefix sums of the polynomial hash with the given table of coefficients."""
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(coefficients(which)[raw] * powers(len(raw))[0], out=total[1:])
    return total


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash for each GRAM bytes."""
    total = prefix_sums(raw, 1)
    h = total[GRAM:] - total[:-GRAM]
    h *= powers(len(h))[1]
    return mixed(h)


def fragment_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of raw[s:e] for each s and e (fragments are under 200 bytes). Prefix sums are those of a piece of the text at a time."""
    out = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
    length = (e - s).astype(np.uint64)
    for lo in range(0, len(raw), PIECE):
        at = np.flatnonzero((s >= lo) & (s < lo + PIECE))
        if len(at):
            piece = raw[lo : lo + PIECE + 256]
            inverse = powers(len(piece) + 1)[1][s[at] - lo]
            for h, which in zip(out, (2, 3), strict=True):
                t = prefix_sums(piece, which)
                h[at] = mixed((t[e[at] - lo] - t[s[at] - lo]) * inverse + length[at]).astype(np.int64)
    return out


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a text of at least WIDTH bytes: runs of windows with one anchor, as (anchor, first window, last window)."""
    out = []
    for lo in range(0, len(raw) - WIDTH + 1, PIECE):
        h = gram_hashes(raw[lo : lo + PIECE + WIDTH - 1])
        # Least by the upper 44 bits, the first of equal ones; windows with one such place are a run. Equal windows have it at the same
        # offset, so no run holds two of them, and equal windows in different runs (of a periodic text, too) have the same anchor.
        span, width = 1, WIDTH - GRAM + 1
        least = (h >> np.uint64(20) << np.uint64(20)) | np.arange(len(h), dtype=np.uint64)
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = width - span
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        ends = np.concatenate([starts[1:], [len(least)]]) - 1
        out.append((h[(least[starts] & np.uint64((1 << 20) - 1)).astype(np.int64)], starts + lo, ends + lo))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def suffix_array(buf: np.ndarray, depth: int = WIDTH) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffixes of buf in order of their first depth bytes at least, the ranks of prefixes of h bytes, h being the largest power of two under depth."""
    n = len(buf)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n].astype(np.uint64)
    sa = np.argsort(key, kind="stable")
    k = key[sa]
    # Ranks are group starts, as in Larsson and Sadakane's refinement; a group of one is sorted for good.
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    rank = np.empty(n, np.int64)
    rank[sa] = np.repeat(first, np.diff(np.append(first, n)))
    h, at_h = 8, None
    while True:
        if h * 2 > depth and at_h is None:
            at_h = rank.copy()
            reached = h
        if h >= depth:
            break
        sizes = np.diff(np.append(first, n))
        slots = np.flatnonzero(np.repeat(sizes > 1, sizes))  # only groups that aren't sorted yet
        if len(slots):
            s = sa[slots]
            after = np.full(len(s), -1, np.int64)
            inside = s + h < n
            after[inside] = rank[s[inside] + h]
            group = rank[s]
            order = np.lexsort((after, group))
            s, g, a = s[order], group[order], after[order]
            sa[slots] = s
            new = np.concatenate([[True], (g[1:] != g[:-1]) | (a[1:] != a[:-1])])
            heads = np.maximum.accumulate(np.where(new, slots, 0))
            rank = rank.copy()
            rank[s] = heads
            mark = np.zeros(n, bool)
            mark[first] = True
            mark[slots[new]] = True
            first = np.flatnonzero(mark)
        h *= 2
    return sa, at_h, reached


def same_prefix(at_h: np.ndarray, reached: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether WIDTH bytes from i and from j are equal: two overlapping prefixes of `reached` bytes are."""
    more = WIDTH - reached
    return (at_h[i] == at_h[j]) & (at_h[i + more] == at_h[j + more])


def windows_of(fragments: list[bytes], places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one block: its different windows in order (S<WIDTH>) with their smallest place, and each window's place with its class.
    places: of each fragment's first byte."""
    lengths = np.array([len(f) for f in fragments])
    buf = np.frombuffer(b"".join(fragments), np.uint8)
    starts = np.cumsum(lengths) - lengths
    sa, at_h, reached = suffix_array(buf)
    offset = np.arange(len(buf)) - np.repeat(starts, lengths)
    whole = offset + WIDTH <= np.repeat(lengths, lengths)
    place = np.repeat(places, lengths) + offset
    sa = sa[whole[sa]]  # windows that lie in one fragment
    new = np.concatenate([[True], ~same_prefix(at_h, reached, sa[1:], sa[:-1])])
    heads = np.flatnonzero(new)
    texts = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buf, WIDTH)[sa[heads]]).view(f"S{WIDTH}").ravel()
    return texts, np.minimum.reduceat(place[sa], heads), place[sa], np.cumsum(new) - 1


def repeats(fragments: list[bytes], docs: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """(index into docs' order, first, end) of bytes that go, fragments being first occurrences. docs: each fragment's document as its rank."""
    places = docs.astype(np.int64) << 36 | starts
    blocks, lo, size = [], 0, 0
    for i, f in enumerate(fragments):
        size += len(f)
        if size >= BLOCK_BYTES or i == len(fragments) - 1:
            blocks.append(windows_of(fragments[lo : i + 1], places[lo : i + 1]))
            lo, size = i + 1, 0
    # Across blocks: each block's windows are looked up in every other's by binary search.
    least = [b[1].copy() for b in blocks]
    for x in range(len(blocks)):
        for y in range(x + 1, len(blocks)):
            at = np.minimum(np.searchsorted(blocks[x][0], blocks[y][0]), len(blocks[x][0]) - 1)
            same = blocks[x][0][at] == blocks[y][0]
            both = np.minimum(least[x][at[same]], least[y][same])
            np.minimum.at(least[x], at[same], both)
            least[y][same] = both
    gone = np.sort(np.concatenate([b[2][b[2] > m[b[3]]] for b, m in zip(blocks, least, strict=True)]))
    if not len(gone):
        return []
    cut = np.flatnonzero(np.concatenate([[True], np.diff(gone) > 1]))
    last = gone[np.append(cut[1:], len(gone)) - 1]
    return [(int(a >> 36), int(a & ((1 << 36) - 1)), int(b & ((1 << 36) - 1)) + WIDTH) for a, b in zip(gone[cut], last, strict=True)]


def _addressed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for lo in range(0, len(b), 500):
            part = b.iloc[lo : lo + 500]
            raws = [t.encode("utf-8", "surrogatepass") for t in part["text"]]
            shas = [hashlib.sha256(r) for r in raws]
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "k": [int.from_bytes(s.digest()[:8], "little", signed=True) for s in shas], "sha": [s.hexdigest() for s in shas], "n_bytes": [len(r) for r in raws], "raw": raws})


def _anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found, size = [], 0
        for k, raw in zip(b["k"], b["raw"], strict=True):
            h, s, e = anchors(np.frombuffer(raw, np.uint8))
            found.append((h.astype(np.int64), np.full(len(h), k, np.int64), s.astype(np.int64) << 32 | (e - s)))
            size += len(h)
            if size > 100_000:
                yield pd.DataFrame(dict(zip(("h", "k", "at"), map(np.concatenate, zip(*found, strict=True)), strict=True)))
                found, size = [], 0
        if found:
            yield pd.DataFrame(dict(zip(("h", "k", "at"), map(np.concatenate, zip(*found, strict=True)), strict=True)))


def _fragments(with_bytes: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found, parts, size = [], [], 0
            for k, doc, raw, runs in zip(b["k"], b["id"], b["raw"], b["runs"], strict=True):
                h = np.fromiter((x["h"] for x in runs), np.int64, len(runs))
                at = np.fromiter((x["at"] for x in runs), np.int64, len(runs))
                s = at >> 32
                e = s + (at & 0xFFFFFFFF) + WIDTH
                f1, f2 = fragment_hashes(np.frombuffer(raw, np.uint8), s, e)
                found.append((h, f1, f2, np.full(len(s), doc, np.int64), np.full(len(s), k, np.int64), s, e))
                size += len(s)
                if with_bytes:
                    parts += [raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)]
                if size > 20_000:
                    yield frame(found, parts)
                    found, parts, size = [], [], 0
            if found:
                yield frame(found, parts)

    def frame(found: list, parts: list) -> pd.DataFrame:
        out = pd.DataFrame(dict(zip(("h", "f1", "f2", "id", "k", "s", "e"), map(np.concatenate, zip(*found, strict=True)), strict=True)))
        if with_bytes:
            out["part"] = parts
        return out

    return run


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    nodes = pdf[["id", "k"]].drop_duplicates().sort_values(["id", "k"]).reset_index(drop=True)
    rank = {x: i for i, x in enumerate(nodes.itertuples(index=False, name=None))}
    docs = np.array([rank[x] for x in zip(pdf["id"], pdf["k"], strict=True)])
    found = repeats(list(pdf["part"]), docs, pdf["s"].to_numpy(np.int64))
    return pd.DataFrame([(int(nodes["k"][d]), a, b) for d, a, b in found], columns=["k", "s", "e"])


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for doc, k, s, part in zip(b["id"], b["k"], b["s"], b["part"], strict=True):
            for o in range(len(part) - WIDTH + 1):
                f = hashlib.blake2b(part[o : o + WIDTH], digest_size=16).digest()
                rows.append((int.from_bytes(f[:8], "little", signed=True), int.from_bytes(f[8:], "little", signed=True), doc, k, s + o))
            if len(rows) > 100_000:
                yield pd.DataFrame(rows, columns=["w1", "w2", "id", "k", "s"])
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["w1", "w2", "id", "k", "s"])


def _left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for k, raw, gone in zip(b["k"], b["raw"], b["gone"], strict=True):
            kept, at, n_spans, last = [], 0, 0, -1
            for s, e in sorted((x["s"], x["e"]) for x in gone):
                if s > last:
                    n_spans += 1
                if s > at:
                    kept.append(raw[at:s])
                at, last = max(at, e), max(last, e)
            kept.append(raw[at:])
            left = b"".join(kept)
            rows.append((k, len(raw) - len(left), n_spans, hashlib.sha256(left).hexdigest(), left))
        yield pd.DataFrame(rows, columns=["k", "n_removed", "n_spans", "kept_sha256", "kept"])


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of docs; with keep_bytes also kept (binary)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text"))
    addressed = rows.mapInPandas(_addressed, "doc_id long, k long, sha string, n_bytes long, raw binary")
    order = F.coalesce("doc_id", F.lit(LAST))
    grouped = addressed.where(F.col("n_bytes") >= WIDTH).groupBy("k").agg(F.min(order).alias("id"), F.min("sha").alias("sha"), F.max("sha").alias("other"), F.min("raw").alias("raw"))
    nodes = bucketed(grouped, "k", "suffix", partitions(spark))
    if not nodes.where("sha != other").isEmpty():
        raise ValueError("two texts share a 64-bit address; another part of their digests is needed")
    runs = nodes.select("k", "raw").mapInPandas(_anchored, "h long, k long, at long")
    often = runs.withColumn("n", F.count("*").over(Window.partitionBy("h"))).where("n > 1").select("h", "k", "at")
    by_node = written(often.groupBy("k").agg(F.collect_list(F.struct("h", "at")).alias("runs")), "suffix-runs")  # of one text
    source = nodes.select("k", "id", "raw").join(by_node, "k")
    places = "h long, f1 long, f2 long, id long, k long, s long, e long"
    occurrences = written(source.mapInPandas(_fragments(False), places), "suffix-places")
    first = F.min(F.struct("id", "k", "s")).alias("first")
    kinds = source.mapInPandas(_fragments(True), f"{places}, part binary").groupBy("h", "f1", "f2").agg(first, F.min("part").alias("part"))
    kinds = written(kinds.select("h", "f1", "f2", "first.*", "part"), "suffix-kinds")
    # Every place of a fragment but its first repeats as a whole.
    later = occurrences.join(kinds.select("f1", "f2", *[F.col(c).alias(f"first_{c}") for c in ("id", "k", "s")]), ["f1", "f2"])
    later = later.where("k != first_k or s != first_s").select("k", "s", "e")
    # First places: equal windows of different fragments, in the shard of their anchor.
    sizes = kinds.groupBy("h").agg(F.count("*").alias("n"))
    crowded = written(sizes.where(F.col("n") > MOST_FRAGMENTS).select("h"), "suffix-crowded")
    apart = kinds.join(crowded, "h", "left_anti")
    total = kinds.agg(F.sum(F.octet_length("part"))).first()[0] or 0
    shards = max(1, int(total / SHARD_BYTES) + 1)
    one = apart.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(max(shards, partitions(spark))))).groupBy("shard").applyInPandas(_shard, "k long, s long, e long")
    parts = [later, one]
    if not crowded.isEmpty():
        windows = written(kinds.join(crowded, "h").select("id", "k", "s", "part").mapInPandas(_digested, "w1 long, w2 long, id long, k long, s long"), "suffix-windows")
        least = windows.groupBy("w1", "w2").agg(F.min(F.struct("id", "k", "s")).alias("first"), F.count("*").alias("n")).where("n > 1")
        parts.append(windows.join(least, ["w1", "w2"]).where("k != first.k or s != first.s").select("k", "s", (F.col("s") + WIDTH).alias("e")))
    gone = parts[0]
    for p in parts[1:]:
        gone = gone.unionAll(p)
    gone = gone.groupBy("k").agg(F.collect_list(F.struct("s", "e")).alias("gone"))  # of one text
    out = "k long, n_removed long, n_spans long, kept_sha256 string, kept binary" if keep_bytes else "k long, n_removed long, n_spans long, kept_sha256 string"
    cut = lambda it: (b if keep_bytes else b.drop(columns="kept") for b in _left(it))
    left = written(nodes.select("k", "raw").join(gone, "k").mapInPandas(cut, out), "suffix-left")
    # Back to rows: of each node's rows, one of those with its smallest doc_id is the first, and all others go as a whole.
    light = written(addressed.select("doc_id", "k", "sha", "n_bytes"), "suffix-members")
    short = light.where(F.col("n_bytes") < WIDTH)
    long_ = light.where(F.col("n_bytes") >= WIDTH).groupBy("k", "doc_id").agg(F.min("sha").alias("sha"), F.min("n_bytes").alias("n_bytes"), F.count("*").alias("n"))
    long_ = long_.join(nodes.select("k", "id"), "k").withColumn("is_first", order == F.col("id"))
    firsts = long_.where("is_first").select("doc_id", "k", "sha", "n_bytes").join(left, "k", "left")
    none = F.lit(0).cast("long")
    copies = long_.withColumn("n", F.col("n") - F.col("is_first").cast("int")).where("n > 0").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    result = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    a = short.select("doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), F.col("sha").alias("kept_sha256"))
    b = firsts.select("doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
    c = copies.select("doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(EMPTY_SHA).alias("kept_sha256"))
    if not keep_bytes:
        return a.unionAll(b).unionAll(c).select(*result)
    texts = rows.select("doc_id", F.col("text").cast("binary").alias("raw")).distinct()
    b = firsts.join(nodes.select("k", "raw"), "k").select(*[F.coalesce(x, none).alias(x) if x in ("n_removed", "n_spans") else F.col(x) for x in result[:4]], F.coalesce("kept_sha256", "sha").alias("kept_sha256"), F.coalesce("kept", "raw").alias("kept"))
    a = a.join(texts.where(F.octet_length("raw") < WIDTH).select(F.sha2("raw", 256).alias("kept_sha256"), F.col("raw").alias("kept")).distinct(), "kept_sha256").select(*result, "kept")
    return a.unionAll(b).unionAll(c.withColumn("kept", F.lit(b"")))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(documents(spark, sf_dir).select("doc_id", "text"))
