"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Texts are read as terms (white-space runs; runs of single characters are joined, so "i d i o t" is one term, and so are the letters of
"i-d.i*o~t"). The kernel of two terms is the normalised gap-weighted subsequence kernel of length 3 with decay DECAY over a 64-symbol
alphabet with end marks; by definition its subsequences span at most SPAN symbols. Letters outside the alphabet are one symbol, OTHER.
Landmarks map a term to its Nyström features, K(term, landmarks) times the inverse square root of the landmarks' kernel matrix, and
a linear SVM on these tells insulting terms from others.

Labels are those of whole texts, so the SVM learns by multiple instances. Witnesses are chosen by covering: again and again the term
that stands in most toxic texts that lack DEPTH witnesses yet, among terms that clean texts hardly have; chance terms of copied
texts never lead, since frequent insults cover those texts first. Toxic texts that the SVM leaves uncovered add their highest term in each round, and
clean texts' highest terms are the hardest others. Witnesses are also learnt with one character inserted (VARIANTS of each), which
makes the kernel's tolerance of insertions part of the training. A text's score is a logistic function of its highest terms' margins.

The learner's input is bounded: the whole texts of at most SAMPLE labelled documents, by hash order of doc_id among those whose crc32
mod 5 isn't 0. Scores read every term of every text. Because the features are linear in the kernel, a trained model collapses
exactly to one weight for each 3-symbol subsequence (64 ** 3 numbers). Design and constants were chosen by splits of the training fold alone.

Defined results: null and empty texts have no terms and get the score of the lowest margin; terms longer than SLICE are read in
overlapping slices; repeated rows score alike; of several labels of one document the highest counts; labels without doc_id or value count as
none; a null doc_id is scored and is never learnt from; without labels of both kinds every score is the prior (0 without labels); an
empty table gives an empty result; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents, free, text_of, trim, trimmed

SAMPLE = 6000
LANDMARKS = 320
ROUNDS = 4
WITNESSES = 600
DEPTH = 2  # witnesses that each toxic text should have
LEAST_COVER = 2  # texts that a witness must cover anew
LEAST_ODDS = 3.0  # log odds of a witness between toxic and clean texts
FORMS = 3  # highest terms of a toxic text that may join in a round
VARIANTS = 3
OTHERS = 3600
DECAY = 0.6
SPAN = 6
SLICE = 24
ALPHABET = 64
REMEMBERED = 150_000  # terms' margins a worker keeps before it starts afresh
START, END, OTHER = 62, 63, 61
LETTERS = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyzàáâäãçèéêëìíîïñòóôöùúûüß0123456789")}
SINGLES = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?!\S)")
INNER = re.compile(r"[\W_]+")
EDGES = re.compile(r"^[^\w]+|[^\w]+$")
INSERTS = "abcdefghijklmnopqrstuvwxyz0123456789"


def terms_of(text: str) -> list[str]:
    """Lower-case terms without outer punctuation; slices of long ones."""
    text = text.lower()
    words = (text if text.isascii() else unicodedata.normalize("NFC", text)).split()
    if SINGLES.search(text):
        words += ["".join(m.group().split()) for m in SINGLES.finditer(text)]
    out = []
    for w in words:
        if not w.isalnum():
            w = EDGES.sub("", w)
            inner = INNER.sub("", w)
            if inner != w:  # also as if nothing stood between the letters
                out += sliced(inner)
        out += sliced(w)
    return out


def sliced(term: str) -> list[str]:
    """term, or the overlapping slices of a long one."""
    if len(term) <= SLICE:
        return [term] if term else []
    return [term[i : i + SLICE] for i in range(0, len(term) - SLICE // 2, SLICE // 2)]


def codes(terms: list[str]) -> np.ndarray:
    """Terms of one length as rows of symbols with end marks."""
    return np.array([[START, *[LETTERS.get(c, OTHER) for c in t], END] for t in terms], dtype=np.int32)


def triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    i, j, k = (a.ravel() for a in np.meshgrid(*[np.arange(n)] * 3, indexing="ij"))
    keep = (i < j) & (j < k) & (k - i < SPAN)
    i, j, k = i[keep], j[keep], k[keep]
    return i, j, k, DECAY ** (k - i - 2.0)


def by_length(terms: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Positions and the (row, subsequence) weights of terms, a length at a time and in blocks of bounded size."""
    groups: dict[int, list[int]] = {}
    for at, t in enumerate(terms):
        groups.setdefault(len(t), []).append(at)
    for n, at in groups.items():
        for b in range(0, len(at), 500):
            yield at[b : b + 500], codes([terms[x] for x in at[b : b + 500]])


def features(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, its subsequences and their weights, normalised to length 1 (weights of equal subsequences lie side by side)."""
    i, j, k, w = triples(c.shape[1])
    sub = (c[:, i] * ALPHABET + c[:, j]) * ALPHABET + c[:, k]
    order = np.argsort(sub, axis=1, kind="stable")
    s, v = np.take_along_axis(sub, order, 1), np.broadcast_to(w, sub.shape)
    v = np.take_along_axis(v, order, 1)
    if s.shape[1] == 0:
        return s, v
    # Sums over runs of equal subsequences: each run's total stands at its end.
    last = np.ones(s.shape, bool)
    last[:, :-1] = s[:, 1:] != s[:, :-1]
    cum = np.cumsum(v, axis=1)
    at_end = np.where(last, cum, 0.0)
    before = np.zeros_like(cum)
    before[:, 1:] = np.maximum.accumulate(at_end, axis=1)[:, :-1]
    v = np.where(last, cum - before, 0.0)
    return s, v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-12)


class Space:
    """The subsequences that landmarks have, numbered from 1, and the landmarks as rows over them. All others add nothing to a kernel value."""

    def __init__(self, marks: list[str]):
        found = [(at, *features(c)) for at, c in by_length(marks)]
        self.subs = np.unique(np.concatenate([s.ravel() for _, s, _ in found]))
        self.number = np.zeros(ALPHABET**3, np.int32)
        self.number[self.subs] = np.arange(1, len(self.subs) + 1)
        self.rows = np.zeros((len(marks), len(self.subs) + 1), np.float32)
        for at, s, v in found:
            for row, ss, vv in zip(at, s, v, strict=True):
                np.add.at(self.rows[row], self.number[ss], vv)
        self.columns = np.ascontiguousarray(self.rows.T)

    def kernel(self, terms: list[str]) -> np.ndarray:
        """Kernel values of terms against the landmarks."""
        out = np.zeros((len(terms), len(self.rows)), np.float32)
        for at, c in by_length(terms):
            s, v = features(c)
            v = v.astype(np.float32)
            for lo in range(0, len(at), 32):
                out[at[lo : lo + 32]] = np.einsum("rs,rsl->rl", v[lo : lo + 32], self.columns[self.number[s[lo : lo + 32]]])
        return out

    def weights(self, of_marks: np.ndarray) -> np.ndarray:
        """One weight for each possible subsequence, from one for each landmark."""
        out = np.zeros(ALPHABET**3, np.float32)
        out[self.subs] = (of_marks @ self.rows)[1:]
        return out


def margins(terms: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(terms), bias)
    for at, c in by_length(terms):
        s, v = features(c)
        out[at] += (weights[s] * v).sum(1)
    return out


def svm(x: np.ndarray, y: np.ndarray, cost: float = 300.0, steps: int = 800) -> tuple[np.ndarray, float]:
    """A linear SVM (squared hinge) by accelerated gradient steps; classes weigh the same."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    del x  # a task's largest array
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * cost
    step = 1 / (1e-3 + 2 * np.linalg.norm(x1 * np.sqrt(weight)[:, None], 2) ** 2)
    w = z = np.zeros(x1.shape[1])
    for n in range(steps):
        slack = np.maximum(0, 1 - y * (x1 @ z))
        grad = 1e-3 * z - 2 * x1.T @ (weight * y * slack)
        new = z - step * grad
        z, w = new + n / (n + 3) * (new - w), new
    return w[:-1], float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Logistic regression by Newton steps; classes weigh the same."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * len(y)
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        h = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(h, x1.T @ (weight * (p - y)) + 1e-2 * w)
    return w


def summary(values: np.ndarray) -> list[float]:
    """Of a text's term margins: the highest, and how many (up to three) are on the insulting side."""
    if not len(values):
        return [-3.0, 0.0]
    top = np.clip(np.sort(values)[::-1][:3], -3, 3)
    return [float(top[0]), float(np.clip(top * 2, 0, 1).sum())]


def bag(text: str) -> list[str]:
    """A text's distinct terms, in order."""
    return list(dict.fromkeys(terms_of(text)))


def packed(terms: list[str]) -> bytes:
    """Terms (none has white space) as compressed bytes; as strings a sample's terms take ten times the memory."""
    return zlib.compress("".join(f"{t}\n" for t in terms).encode())


def unpacked(terms: bytes) -> list[str]:
    return zlib.decompress(terms).decode().split("\n")[:-1]


def covering(bags: list[np.ndarray], allowed: np.ndarray) -> list[int]:
    """Terms, the best first, that cover the bags DEPTH times as far as allowed terms (by index) do; each covers LEAST_COVER bags anew at least."""
    out: list[int] = []
    left = [(b, DEPTH) for b in bags if len(b)]
    while left and len(out) < WITNESSES:
        n = np.bincount(np.concatenate([b for b, _ in left]), minlength=len(allowed)) * allowed
        best = int(n.argmax())
        if n[best] < LEAST_COVER:
            break
        out.append(best)
        allowed = allowed.copy()
        allowed[best] = False
        hit = [bool((b == best).any()) for b, _ in left]
        left = [(b, d - h) for (b, d), h in zip(left, hit, strict=True) if d - h]
    return out


def inserted(term: str) -> list[str]:
    """VARIANTS of term with one character inserted, the same each time."""
    out = []
    for n in range(VARIANTS if len(term) > 2 else 0):
        h = zlib.crc32(f"{n} {term}".encode())
        at = 1 + h % (len(term) - 1)
        out.append(term[:at] + INSERTS[(h >> 8) % len(INSERTS)] + term[at:])
    return out


def separated(marks: list[str], insults: list[str], others: list[str]) -> tuple[np.ndarray, float]:
    """Weights of subsequences and bias of the SVM that tells insults from others by the landmarks' Nyström features."""
    space = Space(marks)
    values, vectors = np.linalg.eigh((space.rows @ space.columns).astype(float))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))  # kernel values @ root = Nyström features
    w, bias = svm(space.kernel(insults + others) @ root, np.array([1.0] * len(insults) + [-1.0] * len(others)))
    return space.weights(root @ w), bias


def train(bags: Iterable[list[str]], labels: list[int]) -> dict:
    """A model of texts' bags: weights of subsequences, bias, and the logistic that turns a text's summary into a score."""
    y = np.array(labels, dtype=float)
    prior = float(y.mean()) if len(y) else 0.0
    if not 0 < y.sum() < len(y):
        return {"weights": np.zeros(ALPHABET**3, np.float32), "bias": 0.0, "score": np.array([0.0, 0.0, -30.0 if prior < 0.5 else 30.0])}
    index: dict[str, int] = {}
    of_bag = [np.unique(np.array([index.setdefault(t, len(index)) for t in terms], dtype=np.int32)) for terms in bags]
    vocabulary = list(index)
    texts = lambda label: [b for b, x in zip(of_bag, labels, strict=True) if x == label]
    shown = lambda label: np.bincount(np.concatenate(texts(label)), minlength=len(vocabulary))
    toxic, clean = shown(1), shown(0)
    odds = np.log((toxic + 0.5) / (y.sum() + 1)) - np.log((clean + 0.5) / (len(y) - y.sum() + 1))
    witnesses = covering(texts(1), odds > LEAST_ODDS)
    if not witnesses:
        witnesses = sorted(np.flatnonzero(toxic).tolist(), key=lambda i: (-odds[i], vocabulary[i]))[:20]
    positive = [vocabulary[i] for i in witnesses]
    # Others: the most frequent terms of clean texts, and as many by hash.
    calm = np.flatnonzero(clean)
    often = sorted(calm.tolist(), key=lambda i: (-clean[i], vocabulary[i]))[: OTHERS // 3]
    spread = sorted(set(calm.tolist()) - set(often), key=lambda i: (zlib.crc32(vocabulary[i].encode()), vocabulary[i]))[: OTHERS - OTHERS // 3]
    negative = [vocabulary[i] for i in often + spread]
    hard: list[str] = []
    weights, bias = np.zeros(ALPHABET**3, np.float32), 0.0
    for _ in range(ROUNDS):
        insults = set(positive)
        more = [t for p in positive for t in inserted(p) if t not in index]
        others = [t for t in dict.fromkeys(hard + negative) if t not in insults]
        marks = positive[: LANDMARKS // 2]
        marks = marks + others[: LANDMARKS - len(marks)]
        weights, bias = separated(marks, positive + more, others)
        trim()  # each round's arrays are larger than the last round's and don't fit in their place
        m = margins(vocabulary, weights, bias)
        # Each toxic text's highest terms are witnesses too, if clean texts hardly have them (the highest one in any case, the others if they
        # aren't far from insulting), so that other forms of an insult are learnt; clean texts' highest terms are the hardest others.
        found: set[int] = set()
        for b in texts(1):
            top = b[np.argsort(-m[b], kind="stable")[:FORMS]]
            found.update(top[(m[top] > -0.2) | ((np.arange(len(top)) == 0) & (m[top].max(initial=0) < 0))].tolist())
        new = sorted(vocabulary[i] for i in found if odds[i] > LEAST_ODDS - 1 and vocabulary[i] not in insults)
        worst = sorted(calm[m[calm] > -0.5].tolist(), key=lambda i: (-m[i], vocabulary[i]))[:OTHERS]
        fresh = [vocabulary[i] for i in worst if vocabulary[i] not in insults and vocabulary[i] not in set(hard)]
        if not new and not fresh:
            break
        positive, hard = positive + new, (fresh + hard)[:OTHERS]
    score = logistic(np.array([summary(m[b]) for b in of_bag]), y)
    return {"weights": weights, "bias": bias, "score": score}


def score_texts(model: dict, texts: list[str], known: dict[str, float]) -> list[float]:
    """Scores of whole texts; known remembers terms' margins."""
    bags = [set(terms_of(t)) for t in texts]
    new = list({t for bag in bags for t in bag if t not in known})
    known.update(zip(new, margins(new, model["weights"], model["bias"]).tolist(), strict=True))
    x = np.array([[*summary(np.array([known[t] for t in bag])), 1.0] for bag in bags]).reshape(-1, 3)
    if len(known) > REMEMBERED:
        known.clear()
    return (1 / (1 + np.exp(-np.clip(x @ model["score"], -30, 30)))).tolist()


def fitted(docs: DataFrame, labels: DataFrame) -> dict:
    """The model of at most SAMPLE labelled training texts (the operator's documented bound). Executors cut texts to bags, and one task
    learns from these; the driver sees the model alone."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    train_ids = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sample = train_ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(sample), "doc_id")

    @F.pandas_udf("binary")
    def bags_of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: packed(bag(t)))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = {(d, h): (bytes(b), y) for x in batches for d, h, b, y in zip(x["doc_id"], x["text"], x["bag"], x["toxic"], strict=True)}
        rows = [got[k] for k in sorted(got)]  # repeated rows count once
        yield pd.DataFrame({"model": [pickle.dumps(train((unpacked(b) for b, _ in rows), [int(y) for _, y in rows]))]})

    bags = rows.select("doc_id", F.xxhash64("text").alias("text"), bags_of("text").alias("bag"), "toxic")
    model = bags.repartition(1).mapInPandas(trimmed(learn), "model binary").collect()
    return pickle.loads(model[0]["model"]) if model else train([], [])  # without rows there may be no task


def scored(docs: DataFrame, model: dict, text: str = "text", name: str = "__score") -> DataFrame:
    """docs with name, the score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 1 MB

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        try:
            for texts in batches:
                got = texts.tolist()
                yield pd.Series([s for b in range(0, len(got), 64) for s in score_texts(shared.value, got[b : b + 64], known)], dtype="float64")
        finally:
            known.clear()
            trim()

    return docs.select("*", score(text_of(text)).alias(name))


def kept(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """docs without those scored 0.5 or more."""
    name = free("score", docs)
    return scored(docs, model, text, name).where(F.col(name) < 0.5).drop(name)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    x = scored(docs, fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    return x.select("doc_id", held_out.alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))
