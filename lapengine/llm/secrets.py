"""Secret scanner with an incremental blob ledger.

Every version of every file (here: every row) is addressed by the SHA-256 of
its content, its blob.  The ledger is a table of blobs with the rule versions
that have been run on them and the spans those rules found.  ``update`` scans
the (blob, rule version) pairs that the ledger lacks, and only those; copies
of a blob are scanned once.  ``findings`` joins the spans back to all rows.
All of it is DataFrame expressions: rows never leave the JVM.

Defined cases: a null text is the empty blob, which has no span.  Repeated
rows share a blob and each get its spans.  Other columns are kept, but for
``secret_spans`` and names that begin with an underscore, which are reserved.  A run
that dies before its ledger batch is committed leaves no entry, so the next
run scans those blobs again; a blob scanned twice gets its spans once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table
from lapengine.llm.storage import shared_dir, written

SPAN = "struct<rule:string,kind:string,rank:int,start:bigint,end:bigint>"
BLOCK, RUN = 64, 1024
LEDGER_SCHEMA = f"blob binary, rules array<string>, spans array<{SPAN}>"


@dataclass(frozen=True)
class SecretRule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    ``gate``: lower-case strings of which the lower-cased text holds one if the pattern can match at all.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    gate: tuple[str, ...] = ()

    @property
    def version(self) -> str:
        said = f"{self.kind}\n{self.pattern}\n{self.least}\n{self.group}"
        return f"{self.kind}@{hashlib.sha256(said.encode()).hexdigest()[:12]}"


# hex and access: runs are maximal, so asking for the length inside the pattern finds the same spans.
BASE_RULES = (
    SecretRule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               12, 2, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    SecretRule("access", r"AKIA[A-Z0-9]{14,}", 18, 0, ("akia",)),
    SecretRule("hex", r"[0-9a-f]{16,}", 16),
)
ADDED_RULES = (
    # to the END line over any characters but another key's header (escaped line ends, Proc-Type headers); where there is none, the plain body
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----(?:(?:(?!-----BEGIN [A-Z ]*PRIVATE KEY)[\s\S])*?"
                      r"-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----|[A-Za-z0-9+/=\x20\x09-\x0D]*)",
               gate=("private key-----", "private key block-----")),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}", gate=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", gate=("eyj",)),
)
RULES = BASE_RULES + ADDED_RULES


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` reads it."""
    return F.transform(F.array(value), body)[0]


def in_blocks(items: Column, zero: Column, carry: Callable[[Column, Column], Column], merge: Callable[[Column, Column], Column],
              each: Callable[[Column, Column], Column]) -> Column:
    """Concatenation of ``each(state, block)`` over blocks of ``BLOCK`` items; the state is ``carry`` over all items before the block.

    An array that grows item by item is copied for every item; here only one block's is, so the time is linear in the items
    (but for the blocks' own states, a thousandth of a square).  ``merge`` joins the states of two runs of items.
    """
    def run(own: Column) -> Column:
        index = F.when(F.size(own) > 0, F.sequence(F.lit(0), F.floor((F.size(own) - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))

        def block(b: Column) -> Column:
            return F.slice(own, b * BLOCK + 1, F.lit(BLOCK))
        states = F.transform(index, lambda b: F.aggregate(block(b), zero, carry))
        return let(states, lambda done: F.flatten(F.transform(index, lambda b: each(F.aggregate(F.slice(done, F.lit(1), b), zero, merge), block(b)))))
    return let(items, run)


def rule_spans(text: Column, rule: SecretRule, rank: int) -> Column:
    """Spans of one rule, in code points: the lengths of the text between matches and of the matches give the positions."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = found if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    pieces = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), found.alias("hit"), judged.alias("judged"))
    lengths = F.transform(pieces, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.length(x["judged"]).alias("judged")))
    none = F.array().cast(f"array<{SPAN}>")

    def passed(at: Column, x: Column) -> Column:
        return at + x["gap"] + F.coalesce(x["hit"], F.lit(0))

    def step(a: Column, x: Column) -> Column:
        start, end = a["at"] + x["gap"], passed(a["at"], x)
        span = F.struct(F.lit(rule.version).alias("rule"), F.lit(rule.kind).alias("kind"), F.lit(rank).alias("rank"),
                        start.alias("start"), end.alias("end"))
        keep = x["hit"].isNotNull() & (x["judged"] >= rule.least)
        return F.struct(end.alias("at"), F.when(keep, F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"))

    def spans(at: Column, block: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), none.alias("spans")), step, lambda a: a["spans"])
    return in_blocks(lengths, F.lit(0).cast("bigint"), passed, lambda x, y: x + y, spans)


def passes_gate(low: Column, rule: SecretRule) -> Column:
    return reduce(Column.__or__, [F.contains(low, F.lit(g)) for g in rule.gate])


def may_match(text: Column, rules=RULES) -> Column:
    """Whether any rule matches ``text``, whatever the length of the match; never null.  Other texts need not be moved to be scanned."""
    def of(low: Column) -> Column:
        return reduce(Column.__or__, [(passes_gate(low, r) if r.gate else F.lit(True)) & F.rlike(text, F.lit(r.pattern)) for r in rules])
    return F.coalesce(let(F.lower(text), of), F.lit(False)) if rules else F.lit(False)


def scan(blobs: DataFrame, rules=RULES) -> DataFrame:
    """``blob, text, missing`` (rule versions to run) -> a ledger batch; a null text is one that no rule matches."""
    low = blobs.withColumn("low", F.lower("text"))
    none = F.array().cast(f"array<{SPAN}>")
    parts = []
    for rank, r in enumerate(rules):
        due = F.array_contains("missing", r.version)
        if r.gate:
            due = due & passes_gate(F.col("low"), r)
        else:
            due = due & F.col("text").rlike(r.pattern)
        parts.append(F.when(due, rule_spans(F.col("text"), r, rank)).otherwise(none))
    return low.select("blob", F.col("missing").alias("rules"), F.concat(*parts).alias("spans"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; none yet counts as empty."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def update(versions: DataFrame, ledger: str, rules=RULES, text_col: str = "text") -> None:
    """Scan the unseen (blob, rule version) pairs of ``versions`` and append them to the ledger."""
    spark = versions.sparkSession
    known = (read_ledger(spark, ledger).select("blob", F.explode("rules").alias("rule"))
             .groupBy("blob").agg(F.collect_set("rule").alias("seen")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a text that no rule matches stays where it is; its blob alone is entered
    moved = F.when(may_match(text, rules), text)
    blobs = versions.select(blob_of(text).alias("blob"), moved.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    now = F.array(*[F.lit(r.version) for r in rules])
    missing = F.when(F.col("seen").isNull(), now).otherwise(F.array_except(now, "seen"))
    unseen = blobs.join(known, "blob", "left").withColumn("missing", missing).where(F.size("missing") > 0)
    scan(unseen.select("blob", "text", "missing"), rules).write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, rules=RULES, text_col: str = "text") -> DataFrame:
    """Every row of ``versions`` with ``secret_spans``: its blob's spans under the current rule
    versions, by start, then kind as listed."""
    current = [r.version for r in rules]
    of_blob = (read_ledger(versions.sparkSession, ledger).where(F.size("spans") > 0)
               .select("blob", F.filter("spans", lambda s: s["rule"].isin(current)).alias("spans"))
               .groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans")))
    ordered = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    # spans of a blob that was scanned twice stand side by side now
    once = let(ordered, lambda own: F.filter(own, lambda s, i: (i == 0) | (s != F.get(own, i - 1))))
    of_blob = of_blob.select(F.col("blob").alias("_blob"), once.alias("_found"))
    # written, so that the join is of two plain inputs and the rows of a blob with many copies can be split
    of_blob = written(of_blob, "findings")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    # rows that no rule matches have no spans and stay where they are; only the others are moved, texts and all
    may = may_match(F.col(text_col), rules)
    rows = versions.where(may).withColumn("_blob", blob_of(F.col(text_col)))
    found = rows.join(of_blob, "_blob", "left").withColumn("secret_spans", F.coalesce("_found", none)).drop("_blob", "_found")
    return found.union(versions.where(~may).withColumn("secret_spans", none))


def said(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, put: str = "[secret]") -> Column:
    """``text`` with each stretch covered by spans (sorted by start) replaced by ``put``.

    The text is cut into runs of ``RUN`` code points first: a substring is looked for from its run's start, not the text's.
    """
    start, none = F.lit(0).cast("bigint"), F.array().cast("array<struct<lo:bigint,hi:bigint>>")

    def step(a: Column, s: Column) -> Column:
        gap = F.struct(a["at"].alias("lo"), s["start"].alias("hi"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], F.concat(a["gaps"], F.array(gap))).otherwise(a["gaps"]).alias("gaps"))

    def gaps(at: Column, block: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), none.alias("gaps")), step, lambda a: a["gaps"])

    def covered(at: Column, s: Column) -> Column:
        return F.greatest(at, s["end"])
    between = in_blocks(spans, start, covered, lambda x, y: F.greatest(x, y), gaps)

    def whole(runs: Column) -> Column:
        def cut(lo: Column, hi: Column) -> Column:
            def part(k: Column) -> Column:
                a = F.greatest(lo - k * RUN, F.lit(0))
                return F.get(runs, k.cast("int")).substr((a + 1).cast("int"), (F.least(hi - k * RUN, F.lit(RUN)) - a).cast("int"))
            run = F.sequence(F.floor(lo / RUN).cast("bigint"), F.floor((hi - 1) / RUN).cast("bigint"))
            return F.when(hi > lo, F.array_join(F.transform(run, part), "")).otherwise(F.lit(""))
        last = cut(F.aggregate(spans, start, covered), F.length(text).cast("bigint"))
        return F.concat(F.array_join(F.transform(between, lambda g: F.concat(cut(g["lo"], g["hi"]), F.lit(put))), ""), last)
    redacted = let(F.regexp_extract_all(text, F.lit(rf"[\s\S]{{1,{RUN}}}"), F.lit(0)), whole)
    return F.when(F.size(spans) > 0, redacted).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of a frame with ``doc_id`` and ``secret_spans``."""
    base = F.filter("secret_spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))

    def count(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(r.kind) for r in BASE_RULES], F.sha2(said(base), 256).alias("base_sha256"),
                        said(F.col("secret_spans")).alias("spans"))


@register("op6_secret_scans")
def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of documents, through a ledger in the shared folder."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = shared_dir(spark, "ledger")
    update(docs, ledger)
    return digest(findings(docs, ledger))
