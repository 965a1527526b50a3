"""Canonical exact digests (native: DataFrame functions only).

A text's canonical form is its NFKC normalisation (ICU, which Spark ships), lower-cased, with white space folded. The digest is two
seeded 64-bit xxhashes of it. Texts whose digests are equal are compared byte by byte inside their bucket; should two different
canonical forms share a digest, the later ones (by bytes) get a suffix, so equal fingerprints mean equal canonical forms.

Defined results: a null text is the empty text; rows are ordered by doc_id (nulls first) and then text; with one row the next
document is itself; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import bounded, documents, partitions, text_of, written

ICU = "com.ibm.icu.text.Normalizer"


def normalised(text: Column) -> Column:
    """NFKC; plain ASCII is left as it is, being normal already."""
    return F.when(text.rlike(r"^\p{ASCII}*+$"), text).otherwise(F.reflect(F.lit(ICU), F.lit("compose"), text, F.lit(True)))


def folded(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\u0085\p{Z}]+", " "))


def digest(canonical: Column) -> Column:
    wide = F.concat(F.lpad(F.hex(F.xxhash64(F.lit(1), canonical)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(2), canonical)), 16, "0"))
    return F.lower(wide)


def with_next(docs: DataFrame, carry: list[str], ranges: int) -> DataFrame:
    """docs with next_<c>, for c in carry, of the next document by doc_id (after the last: the first). No single task sees all rows:
    they are dealt to ranges of doc_id, and the ends of the ranges meet through a table of one row a range."""
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], F.lit(20 * ranges)).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    at = F.lit(0)
    if cuts:
        at = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("doc_id"))))
    x = docs.withColumn("__range", at.cast("int"))
    ends = x.groupBy("__range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text", *[c for c in carry if c != "text"])).alias("__first"))
    order = sorted(r["__range"] for r in ends.select("__range").collect())  # one small number a range
    if not order:
        return x.drop("__range").withColumns({f"next_{c}": F.col(c) for c in carry})
    after = docs.sparkSession.createDataFrame([(order[i - 1], r) for i, r in enumerate(order)], "__range int, __after int")
    edge = ends.withColumnRenamed("__range", "__after").join(after, "__after").drop("__after")
    w = Window.partitionBy("__range").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    lead = x.select("*", *[F.lead(c).over(w).alias(f"__lead_{c}") for c in carry])
    return lead.join(edge, "__range").select(*docs.columns, *[F.coalesce(f"__lead_{c}", f"__first.{c}").alias(f"next_{c}") for c in carry])


def digested(df: DataFrame, column: str) -> DataFrame:
    """df with <column>_form, the canonical form, and <column>_fp, its digest."""
    x = df.withColumn("__normal", normalised(F.col(column))).withColumn(f"{column}_form", folded(F.col("__normal"))).drop("__normal")
    return x.withColumn(f"{column}_fp", digest(F.col(f"{column}_form")))


def clashes(digests: DataFrame, forms: list[DataFrame]) -> DataFrame:
    """(fp, form, suffix) where one digest stands for several canonical forms. digests: fp, one row for each text; each of forms: fp, form."""
    often = bounded(written(digests.groupBy("fp").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("fp"), "fp-often"))
    # Equal forms collapse before the shuffle, so a large group of copies is one row of each task.
    kinds = reduce(DataFrame.unionByName, [f.join(often, "fp", "left_semi").groupBy("fp", "form").agg(F.lit(1).alias("one")) for f in forms])
    w = Window.partitionBy("fp").orderBy("form")
    split = kinds.groupBy("fp").agg(F.min("form").alias("a"), F.max("form").alias("b")).where(F.col("a") != F.col("b")).select("fp")
    found = written(split, "fp-split")  # the byte comparison; only a digest that fails it needs an order of its forms
    return kinds.select("fp", "form").distinct().join(bounded(found), "fp", "left_semi").select("fp", "form", (F.row_number().over(w) - 1).alias("suffix"))


def settled(df: DataFrame, column: str, clash: DataFrame) -> DataFrame:
    """df (from digested) with the suffixes of clash in <column>_fp."""
    c = bounded(clash).select(F.col("fp").alias(f"{column}_fp"), F.col("form").alias(f"{column}_form"), "suffix")
    more = F.when(F.col("suffix") > 0, F.concat(F.lit("-"), F.col("suffix").cast("string"))).otherwise("")
    return df.join(c, [f"{column}_fp", f"{column}_form"], "left").withColumn(f"{column}_fp", F.concat(f"{column}_fp", more)).drop("suffix")


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with a column fingerprint. Equal fingerprints: equal canonical forms."""
    x = digested(docs.withColumn("__t", text_of(text)), "__t")
    clash = written(clashes(x.select(F.col("__t_fp").alias("fp")), [x.select(F.col("__t_fp").alias("fp"), F.col("__t_form").alias("form"))]), "fp-clash")
    if not clash.isEmpty():
        x = settled(x, "__t", clash)
    return x.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__t_fp").alias("fingerprint"))


def edits(own: DataFrame, ranges: int) -> DataFrame:
    """doc_id, n_chars, text_fp, next_fp, edited (with its form and digest) and unedited, of documents with text and text_fp."""
    x = with_next(own.select("doc_id", "text", "text_fp"), ["text", "text_fp"], ranges)
    x = x.withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    return digested(x.select("doc_id", "n_chars", "text_fp", F.col("next_text_fp").alias("next_fp"), edited.alias("edited"), (edited == F.col("text")).alias("unedited")), "edited")


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", text_of().alias("text"))
    return compared(docs, min(256, max(4, partitions(spark))))


def compared(docs: DataFrame, ranges: int) -> DataFrame:
    """Fingerprints of docs (doc_id, text), of their edited texts, and their likeness."""
    own = digested(docs, "text")
    x = edits(own, ranges)
    light = ["doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "text_fp", "edited_fp", "next_fp"]
    d = written(x.select(*light, "unedited"), "fp-digests")
    forms = [own.select(F.col("text_fp").alias("fp"), F.col("text_form").alias("form")), x.where(~F.col("unedited")).select(F.col("edited_fp").alias("fp"), F.col("edited_form").alias("form"))]
    digests = d.select(F.col("text_fp").alias("fp")).unionAll(d.where(~F.col("unedited")).select("edited_fp"))
    clash = written(clashes(digests, forms), "fp-clash")
    if not clash.isEmpty():  # the whole way again, with the digests told apart: rows need no key
        d = settled(edits(settled(own, "text", clash), ranges), "edited", clash).select(*light)
    same = lambda a, b: (F.col(a) == F.col(b)).cast("double")
    return d.select(
        "doc_id", "n_chars", "edited_sha256", F.col("text_fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"),
        same("text_fp", "edited_fp").alias("near_edited"), same("text_fp", "next_fp").alias("near_next"),
    )
