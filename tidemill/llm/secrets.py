"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its UTF-8 text). The ledger holds the (blob, rule version) pairs that
were scanned and their findings; a scan reads the text of each unseen blob once, however many paths or versions share it, adds a
batch to the ledger, and joins the findings back to all paths.

Rules: the three base kinds, and private-key blocks, signed web tokens and well-known prefixed tokens.

Defined results: a null text is the empty text (a blob like any other); repeated rows each get their findings; an empty table gives
an empty result and adds an empty batch; other columns are left alone.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents, shared_dir, text_of

RULES_VERSION = "1"
KINDS = ("assign", "access", "hex", "pem", "jwt", "prefixed")
ASSIGN = re.compile(r"""(?P<name>(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?(?P<value>[A-Za-z0-9+/_.=-]+)""")
#: A run that is too short fails and touches no other run, so only long ones need to match.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*-----END [A-Z ]*PRIVATE KEY-----")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")
PREFIXED = re.compile(r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{16,})")
FINDING = "array<struct<start:int,rank:int,end:int,kind:string>>"


def find(text: str) -> list[tuple[int, int, int, str]]:
    """(start, rank of kind, end, kind) of all findings, in order; offsets in code points."""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m["value"]) >= 12]
    for rank, rule in enumerate((ACCESS, HEX, PEM, JWT, PREFIXED), 1):
        out += [(m.start(), rank, m.end(), KINDS[rank]) for m in rule.finditer(text)]
    return sorted(out)


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found = [find(t) for t in b["text"]]
        yield pd.DataFrame({"blob": b["blob"], "found": [[{"start": a, "rank": r, "end": e, "kind": k} for a, r, e, k in xs] for xs in found]})


def empty_ledger(spark: SparkSession) -> str:
    """A new ledger's folder, shared by driver and executors."""
    return f"{shared_dir(spark)}/tidemill/ledger-{uuid.uuid4().hex}"


def ledger_rows(spark: SparkSession, ledger: str, batches: list[str]) -> DataFrame:
    schema = f"blob string, rules string, found {FINDING}"
    return spark.read.schema(schema).parquet(*[f"{ledger}/{b}" for b in batches]) if batches else spark.createDataFrame([], schema)


def scan(versions: DataFrame, ledger: str, batches: list[str], text: str = "text", rules: str = RULES_VERSION) -> tuple[DataFrame, list[str]]:
    """versions (any columns, one row for each version of each path) with __blob and __found, and the ledger's batches with the new one."""
    spark = versions.sparkSession
    addressed = versions.withColumn("__blob", F.sha2(text_of(text), 256))
    known = ledger_rows(spark, ledger, batches).where(F.col("rules") == rules)
    # Copies of a blob collapse before the shuffle, so each text crosses it about once.
    blobs = addressed.groupBy(F.col("__blob").alias("blob")).agg(F.min(text_of(text)).alias("text"))
    unseen = blobs.join(known.select("blob"), "blob", "left_anti") if batches else blobs
    batch = f"batch-{len(batches):06d}-{uuid.uuid4().hex}"
    scanned = unseen.mapInPandas(_scan, f"blob string, found {FINDING}").select("blob", F.lit(rules).alias("rules"), "found")
    scanned.write.parquet(f"{ledger}/{batch}")
    batches = [*batches, batch]
    all_found = ledger_rows(spark, ledger, batches).where((F.col("rules") == rules) & (F.size("found") > 0)).select(F.col("blob").alias("__blob"), F.col("found").alias("__found"))
    out = addressed.join(all_found, "__blob", "left")
    return out.withColumn("__found", F.coalesce("__found", F.array().cast(FINDING))), batches


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = scan(documents(spark, sf_dir).select("doc_id", "text"), empty_ledger(spark), [])
    text = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("__found", lambda s: s["rank"] < 3)
    n = lambda k: F.size(F.filter("__found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("__found")).alias("spans"))
