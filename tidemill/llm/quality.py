"""Quality by distribution divergence (native: DataFrame functions only).

Each document's histogram of character classes, and of the common words of its language, is compared with the histogram of all
documents of that language by Jensen-Shannon distance (base 2). The references are pooled over the whole corpus. Guards: under
LEAST_CHARS characters, or LEAST_WORDS words, the histogram is too small to judge and that comparison passes.

Defined results: a null text has no words (base_failed); a null language is a language of its own; repeated rows are judged alike;
an empty table gives an empty result; a column of docs that has the name of a result column is replaced by it, all others are left alone. A language's reference is at most CLASSES plus COMMON numbers; references are a table with a
row for each language, joined by language, so there may be any number of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import WORD, bounded, documents, let, written

CLASSES = ("upper", "lower", "digit", "symbol", "mark", "space", "other")
SYMBOLS = r"[#*$%&|<>]"
COMMON = 20
LEAST_CHARS = 200
LEAST_WORDS = 80
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.30
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULTS = (*BASE, "class_distance", "word_distance", "base_failed", "kept")


def total(xs: Column, kind: str = "bigint") -> Column:
    return F.aggregate(xs, F.lit(0).cast(kind), lambda a, v: a + v)


def kept_by(text: Column, unwanted: str) -> Column:
    """How many code points remain without the matches of unwanted."""
    return F.length(F.regexp_replace(text, unwanted, "")).cast("long")


def windows(words: Column) -> Column:
    """A hash for each 3-word window, in order. words must be a plain column."""
    at = F.sequence(F.lit(0), F.size(words) - 3)
    return F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(F.transform(at, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])))


def repeat_words(hashes: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more. hashes: its windows, a plain column, so that most texts, which repeat
    none, are told by generated code over a set of longs."""

    def covered(marks: Column) -> Column:
        # marks: (hash, position) in order; a window repeats if a neighbour has its hash
        last = F.size(marks) - 1
        hit = F.filter(marks, lambda m, i: ((i > 0) & (marks[F.greatest(i - 1, F.lit(0))]["h"] == m["h"])) | ((i < last) & (marks[F.least(i + 1, last)]["h"] == m["h"])))
        places = F.sort_array(F.transform(hit, lambda m: m["i"]))
        first = F.struct(F.lit(-1).alias("end"), F.lit(0).cast("bigint").alias("n"))
        step = lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + (p + 3 - F.greatest(a["end"], p))).alias("n"))
        return F.aggregate(places, first, step, lambda a: a["n"])

    marks = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(let(marks, covered))


def dup_lines(text: Column) -> Column:
    def counted(lines: Column) -> Column:
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")

    return F.when(F.contains(text, F.lit("\n")), let(F.filter(F.split(text, "\n", -1), lambda v: v.rlike(WORD)), counted)).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """docs with __t, __w (words), __g (language), the base columns and __classes (counts in the order of CLASSES)."""
    x = docs.withColumn("__t", F.coalesce(F.col(text), F.lit(""))).withColumn("__g", F.coalesce(F.col(lang), F.lit("")))
    x = x.withColumn("__w", F.regexp_extract_all("__t", F.lit(WORD), F.lit(0)))
    t, w, rest, bare = F.col("__t"), F.col("__w"), F.col("__rest"), F.col("__bare")
    # Lower-case letters, then white space, leave each text once; all other classes are counted in the little that remains.
    x = x.withColumn("__windows", windows(w)).withColumn("__rest", F.regexp_replace(t, r"\p{Ll}+", ""))
    x = x.withColumn("__bare", F.regexp_replace(rest, r"[\x20\x09-\x0D]+", ""))
    x = x.withColumns({
        "n_words": F.size(w).cast("long"), "word_chars": (F.length(t) - F.length(rest) + F.length(bare)).cast("long"), "n_symbols": kept_by(bare, r"[^#*$%&|<>]+"),
        "n_dup_lines": dup_lines(t), "n_repeat_words": repeat_words(F.col("__windows")),
        "__u": kept_by(bare, r"\P{Lu}+"), "__l": (F.length(t) - F.length(rest)).cast("long"), "__d": kept_by(bare, "[^0-9]+"),
        "__m": kept_by(bare, r"[^.,;:!?'\"()-]+"), "__n": F.length(t).cast("long"),
    })
    space = F.col("__n") - F.col("word_chars")
    other = F.col("word_chars") - F.col("__u") - F.col("__l") - F.col("__d") - F.col("__m") - F.col("n_symbols")
    gone = ("__u", "__l", "__d", "__m", "__n", "__windows", "__rest", "__bare")
    return x.withColumn("__classes", F.array("__u", "__l", "__d", "n_symbols", "__m", space, other)).drop(*gone)


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """A row for each language that has words: __g, its COMMON most frequent words (by count, then word) as __common, and as __word_shares their shares of its words and the rest's."""
    x = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("__g"), F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0)).alias("w"))
    counts = written(x.select("__g", F.explode("w").alias("word")).groupBy("__g", "word").agg(F.count("*").alias("n")), "quality-words")
    sums = counts.groupBy("__g").agg(F.sum("n").alias("n"))
    # Spark keeps the first COMMON of a language in each task before it deals them out.
    top = counts.withColumn("rank", F.row_number().over(Window.partitionBy("__g").orderBy(F.desc("n"), "word"))).where(F.col("rank") <= COMMON)
    top = top.groupBy("__g").agg(F.sort_array(F.collect_list(F.struct("rank", "word", F.col("n").alias("k")))).alias("top"))
    shares = F.transform("top", lambda s: s["k"] / F.col("n"))
    out = top.join(sums, "__g").select("__g", F.transform("top", lambda s: s["word"]).alias("__common"), shares.alias("shares"))
    return written(out.select("__g", "__common", F.concat("shares", F.array(1 - total(F.col("shares"), "double"))).alias("__word_shares")), "quality-references")


def jsd(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two distributions; both array<double>."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), total(terms, "double") / 2))


def common_hits() -> Column:
    """How often the document has each common word of its language."""
    # Lower case is never shorter, so longer words than the longest common one needn't be looked up.
    widest = F.array_max(F.transform("__common", lambda c: F.length(c)))
    short = let(widest, lambda most: F.filter("__w", lambda v: F.length(v) <= most))
    places = F.filter(F.transform(short, lambda v: F.array_position(F.col("__common"), F.lower(v))), lambda i: i > 0)
    hits = let(places, lambda found: F.transform("__common", lambda _, i: (F.size(found) - F.size(F.array_remove(found, (i + 1).cast("long")))).cast("long")))
    return F.when(F.col("__common").isNull(), F.array().cast("array<bigint>")).otherwise(hits)


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """The carried columns of docs (all, if none are named) with the base columns, class_distance, word_distance, base_failed and kept."""
    refs = references(docs, text, lang)
    docs = docs.drop(*[c for c in docs.columns if c in RESULTS and c not in (text, lang)])
    x = docs.withColumn("__g", F.coalesce(F.col(lang), F.lit(""))).join(bounded(refs.select("__g", "__common")), "__g", "left")
    x = measured(x, text, lang)
    carried = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry) if c not in RESULTS]
    # Texts are read once for all measures; what follows works on a few numbers for each document.
    x = written(x.select(*carried, *BASE, "__g", "__classes", common_hits().alias("__hits")), "quality-measures")
    sums = x.groupBy("__g").agg(*[F.sum(F.col("__classes")[i]).alias(c) for i, c in enumerate(CLASSES)])
    n_all = F.greatest(F.lit(1), total(F.array(*CLASSES)))
    pooled = sums.select("__g", F.array(*[F.col(c) / n_all for c in CLASSES]).alias("__class_shares"))
    shares = written(pooled.join(refs.select("__g", "__word_shares"), "__g", "left"), "quality-shares")
    x = x.join(bounded(shares), "__g")
    n_chars, n = total(F.col("__classes")), F.col("n_words")
    class_d = jsd(F.transform("__classes", lambda v: v / n_chars), F.col("__class_shares"))
    word_d = jsd(F.concat(F.transform("__hits", lambda h: h / n), F.array((n - total(F.col("__hits"))) / n)), F.col("__word_shares"))
    x = x.withColumn("class_distance", F.when(n_chars < LEAST_CHARS, 0.0).otherwise(class_d)).withColumn("word_distance", F.when(n < LEAST_WORDS, 0.0).otherwise(word_d))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    x = x.withColumn("base_failed", failed)
    x = x.withColumn("kept", ~F.col("base_failed") & (F.col("class_distance") <= MAX_CLASS_DISTANCE) & (F.col("word_distance") <= MAX_WORD_DISTANCE))
    return x.drop("__g", "__classes", "__hits", "__class_shares", "__word_shares")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = judged(documents(spark, sf_dir).select("doc_id", "text", "lang"), carry=["doc_id"])
    return x.select("doc_id", *BASE, "base_failed", "kept", F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"))
