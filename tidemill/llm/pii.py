"""Information-theoretic sanitisation of personal data (native: DataFrame functions only).

Base spans (email, ip, card, phone) are found by pattern and always protected. What they may be known by are entities: the value itself, an
email's domain, and the kind. Around each span, the terms of a context window are counted over the whole corpus. All probabilities are
over one space, the term places of different texts outside base spans: p(t) is term t's share of the places, p(e) that of the places near
entity e, p(e, t) that of t's places near e. A term discloses e when it gives away most of e's information content,
PMI(e; t) >= DISCLOSURE * IC(e) with IC(e) = -log2 p(e), that is p(e given t) >= p(e) ** (1 - DISCLOSURE), in at least SUPPORT different
contexts (copies of one passage are one context). Such terms are generalised to [TERM] at all their places in all texts.

Defined results: a null text is the empty text; empty texts have no spans; repeated rows are treated alike; an empty table gives an
empty result; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import bounded, count_kind, discard, documents, free, let, rendered, running, spans, written

KINDS = ("email", "ip", "card", "phone")
#: Each is the contract's pattern, anchored where a run begins (or the last match ended) and possessive, so that Java needs linear
#: time and no recursion. Matching is the same: a match that begins inside a run also begins at the run's start.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Runs of under 12 digits fail in any case, so they needn't be matched; runs don't touch each other.
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
TERM = r"\p{L}+"

CONTEXT = 64  # code points on either side
CHUNK = 1024
WINDOW = 3  # terms on either side
SUPPORT = 3
DISCLOSURE = 0.8


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether value has 12 to 19 digits that pass Luhn."""
    d = F.reverse(digits(value))
    doubled = F.expr("array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9)")
    digit = lambda i: F.substring(d, i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda acc, i: acc + F.when(i % 2 == 0, doubled[digit(i)]).otherwise(digit(i)))
    return F.when(F.length(d).between(12, 19), total % 10 == 0).otherwise(False)


def base_spans(text: Column) -> Column:
    """All base spans, by start and then kind."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    email = F.when(F.contains(text, F.lit("@")), spans(text, EMAIL, "email", 0)).otherwise(none)
    ip = spans(text, IP, "ip", 1, lambda v: v.rlike(rf"^{OCTET}(\.{OCTET}){{3}}$"))
    card = spans(text, CARD, "card", 2, luhn)
    phone = F.when(F.contains(text, F.lit("+")), spans(text, PHONE, "phone", 3, lambda v: F.length(digits(v)).between(9, 15))).otherwise(none)
    return F.sort_array(F.concat(email, ip, card, phone))


def entities(s: Column) -> Column:
    """What a base span may be known by: its value, an email's domain, its kind."""
    value = F.when(s["kind"] == "email", F.lower(s["value"])).when(s["kind"] == "ip", s["value"]).otherwise(digits(s["value"]))
    of = lambda v: F.concat(s["kind"], F.lit(":"), v)
    domain = F.array(of(F.concat(F.lit("@"), F.lower(F.substring_index(s["value"], "@", -1)))))
    return F.concat(F.array(s["kind"], of(value)), F.when(s["kind"] == "email", domain).otherwise(F.array().cast("array<string>")))


def chunked(text: Column) -> Column:
    """text in chunks of CHUNK code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def piece(chunks: Column, start: Column, end: Column) -> Column:
    """Code points start to end of a chunked text; a long text isn't read from its start each time."""
    first = F.floor(start / CHUNK).cast("int")
    some = F.array_join(F.slice(chunks, first + 1, F.floor(end / CHUNK).cast("int") - first + 1), "")
    return F.substring(some, start - first * CHUNK + 1, end - start)


def replaced(text: Column, found: Column, by) -> Column:
    """text with each span (overlapping ones joined) replaced by by(its first span, its length)."""
    ends = running(F.transform(found, lambda s: s["end"]), F.lit(0), lambda x, y: F.greatest(x, y))

    def whole(chunks: Column) -> Column:
        def joined(groups: Column) -> Column:
            end = F.array_max(F.transform(found, lambda s: s["end"]))
            until = lambda i: F.coalesce(F.get(groups, i + 1)["e"], end)
            pieces = F.transform(groups, lambda x, i: F.concat(piece(chunks, x["e"], x["s"]["start"]), by(x["s"], until(i) - x["s"]["start"])))
            return F.concat(F.array_join(pieces, ""), F.substring(text, end + 1, F.length(text)))

        # A span that begins before an earlier one ends is part of that one.
        return let(F.filter(F.zip_with(found, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e"))), lambda x: x["s"]["start"] >= x["e"]), joined)

    return let(chunked(text), whole)


def masked(text: Column, base: Column) -> Column:
    """text with blanks for what base spans cover; places stay."""
    return F.when(F.size(base) > 0, replaced(text, base, lambda _, n: F.repeat(F.lit(" "), n))).otherwise(text)


def terms(text: Column, base: Column) -> Column:
    """The lower-case terms outside base spans, in order."""
    return F.transform(F.regexp_extract_all(masked(text, base), F.lit(TERM), F.lit(0)), F.lower)


def contexts(found: DataFrame) -> DataFrame:
    """One row for each base span: its entities, a hash of its context (without base spans), and the spans of the terms near it. found: __row, __text, __base."""
    x = found.select("__row", "__base", F.length("__text").alias("__n"), chunked(masked(F.col("__text"), F.col("__base"))).alias("__chunks"))

    def around(s: Column) -> Column:
        from_, to = F.greatest(s["start"] - CONTEXT, F.lit(0)), F.least(s["end"] + CONTEXT, F.col("__n"))
        cut = piece(F.col("__chunks"), F.greatest(from_ - 1, F.lit(0)), from_), piece(F.col("__chunks"), to, F.least(to + 1, F.col("__n")))
        window = piece(F.col("__chunks"), from_, s["start"]), piece(F.col("__chunks"), s["end"], to)
        return F.struct(
            entities(s).alias("entities"), s["end"].alias("end"), from_.alias("from"), to.alias("to"), window[0].alias("left"), window[1].alias("right"),
            cut[0].rlike(TERM).alias("cut_left"), cut[1].rlike(TERM).alias("cut_right"),
        )

    x = x.select("__row", F.explode(F.transform("__base", around)).alias("c")).select("__row", "c.*")
    moved = lambda xs, by: F.transform(xs, lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), F.lower(s["value"]).alias("value")))
    # What the context's ends cut isn't a term.
    left = F.filter(moved(F.slice(F.reverse(spans(F.col("left"), TERM, "term", 4)), 1, WINDOW), F.col("from")), lambda s: ~(F.col("cut_left") & (s["start"] == F.col("from"))))
    right = F.filter(moved(F.slice(spans(F.col("right"), TERM, "term", 4), 1, WINDOW), F.col("end")), lambda s: ~(F.col("cut_right") & (s["end"] == F.col("to"))))
    return x.select("__row", F.col("entities").alias("__entities"), F.xxhash64("left", "right").alias("__context"), F.concat(left, right).alias("__terms"))


def _scored(found: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What disclosing() returns, and (__row, __term, __n) of all places of some terms, those that disclose among them: __n counts each copy of a text."""
    # Rows of one text count once: their terms here, and copies by division below.
    outside_base = F.regexp_count(masked(F.col("__text"), F.col("__base")), F.lit(TERM))
    texts = written(found.select("__row", outside_base.alias("n")).groupBy("__row").agg(F.count("*").alias("__copies"), F.max("n").alias("n")), "pii-texts")
    close = near.select("__row", "__entities", "__context", F.explode("__terms").alias("__t"))
    close = close.select("__row", F.explode("__entities").alias("__entity"), "__context", F.col("__t.start").alias("__at"), F.col("__t.value").alias("__term"))
    support = close.select("__entity", "__context", "__term").distinct().groupBy("__entity", "__term").agg(F.count("*").alias("n_contexts")).where(F.col("n_contexts") >= SUPPORT)
    sites = written(close.select("__row", "__at", "__entity", "__term").distinct(), "pii-places")
    pairs = sites.groupBy("__entity", "__term").agg(F.count("*").alias("n_pair")).join(support, ["__entity", "__term"], "left_semi")
    known = sites.groupBy("__entity").agg(F.count("*").alias("n_entity")).crossJoin(F.broadcast(texts.agg(F.sum("n").alias("n_all"))))  # one row
    known = written(known.select("__entity", F.pow(F.col("n_entity") / F.col("n_all"), 1 - DISCLOSURE).alias("least")), "pii-entities")
    # A term's places near any entity, and those in texts that have entities, are some of its places; pairs that fail by these alone need no corpus count.
    some = sites.select("__row", "__at", "__term").distinct().groupBy("__term").agg(F.count("*").alias("n_some"))
    pairs = written(pairs.join(known, "__entity").join(some, "__term").where(F.col("n_pair") / F.col("n_some") >= F.col("least")).drop("n_some"), "pii-pairs")
    words = lambda x: x.select("__row", F.explode(terms(F.col("__text"), F.col("__base"))).alias("__term"))
    sought = lambda x: bounded(x.select("__term").distinct())
    holders = found.where(F.size("__base") > 0).dropDuplicates(["__row"])
    some = words(holders).join(sought(pairs), "__term", "left_semi").groupBy("__term").agg(F.count("*").alias("n_some"))
    pairs = written(pairs.join(some, "__term").where(F.col("n_pair") / F.col("n_some") >= F.col("least")).drop("n_some"), "pii-rarer")
    places = written(words(found).join(sought(pairs), "__term", "left_semi").groupBy("__row", "__term").agg(F.count("*").alias("__n")), "pii-terms")
    counts = places.join(texts.where("__copies > 1"), "__row", "left").groupBy("__term").agg(F.sum(F.expr("__n div coalesce(__copies, 1)")).alias("n_term"))
    scored = pairs.join(counts, "__term").withColumn("given", F.col("n_pair") / F.col("n_term"))
    return scored.where("given >= least").select("__entity", "__term", "given", "least"), places


def disclosing(found: DataFrame, near: DataFrame) -> DataFrame:
    """(__entity, __term, given, least) of the pairs over the thresholds. found has __row, __text and __base, near comes from contexts()."""
    return _scored(found, near)[0]


def _annotated(docs: DataFrame, text: str) -> DataFrame:
    """own (all columns), __text, __base and __spans (base spans and disclosing terms, by start)."""
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    found = found.withColumns({"__base": base_spans(F.col("__text")), "__row": F.sha2("__text", 256)})
    light = written(found.select("__row", "__text", "__base"), "pii-light")
    # What has no entity needs no context, and what has none of the same text twice needs only one context row.
    near = written(contexts(light.where(F.size("__base") > 0)).distinct(), "pii-contexts")
    pairs, places = _scored(light, near)
    pairs = written(pairs, "pii-disclosing")
    # The texts that have such terms, anywhere, and which.
    hits = places.join(bounded(pairs.select("__term").distinct()), "__term", "left_semi")
    hits = written(hits.groupBy("__row").agg(F.collect_set("__term").alias("__hits")), "pii-hits")
    discard(light)
    out = found.join(bounded(hits, 64_000_000), "__row", "left")
    out = out.withColumn("__masked", F.when(F.col("__hits").isNotNull(), masked(F.col("__text"), F.col("__base"))))
    shown = F.filter(spans(F.col("__masked"), TERM, "term", 4), lambda s: F.array_contains("__hits", F.lower(s["value"])))
    more = F.transform(shown, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), F.lower(s["value"]).alias("value")))
    return out.withColumn("__spans", F.when(F.col("__hits").isNull(), F.col("__base")).otherwise(F.sort_array(F.concat("__base", more))))


def annotate(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with __base (base spans) and __spans (base spans and disclosing terms, by start); names that docs has get a "_" more."""
    return _annotated(docs, text).select("own.*", F.col("__base").alias(free("base", docs)), F.col("__spans").alias(free("spans", docs)))


def sanitised(text: Column, found: Column) -> Column:
    """text with entities removed as [KIND] and terms generalised as [TERM]."""
    return replaced(text, found, lambda s, _: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with text sanitised; all other columns, and rows, as they are. A null text stays null."""
    out = _annotated(docs, text)
    clean = F.when(F.size("__spans") > 0, sanitised(F.col("__text"), F.col("__spans"))).otherwise(F.col("own").getField(text))
    return out.select([clean.alias(c) if c == text else F.col("own").getField(c).alias(c) for c in docs.columns])


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _annotated(documents(spark, sf_dir).select("doc_id", "text"), "text")
    return found.select(
        "own.doc_id", *[count_kind(F.col("__base"), k).alias(f"n_{k}") for k in KINDS], F.sha2(rendered(F.col("__base")), 256).alias("base_sha256"),
        rendered(F.col("__spans")).alias("spans"), count_kind(F.col("__spans"), "term").alias("n_term"),
    )
