"""Operator 7: secret scan with an incremental blob ledger, in DataFrame functions only.

Texts are addressed by their SHA-256: a blob is scanned once, however many paths and versions hold it,
and never again by a rule version that has seen it. A run takes every row given (paths with all their
historical versions), leaves out the (blob, rule-version) pairs in the ledger, scans the rest, appends
findings and then scanned pairs to the ledger, and joins the findings of all blobs back to all rows.
If a run is lost between the two appends, the pairs are scanned again and the double findings merge.

Positions come from the lengths of the pieces between matches, summed over a blob's matches, so no
match list is walked by a task of its own; offsets count code points, ends are exclusive.

Defined results: null or empty text: the blob of the empty text, without findings. Null path: reported
as null. Repeated rows: reported each. Empty table: an empty report; the ledger is still written.
Other columns are kept out of the way, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import written


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose group ``group`` is shorter than
    ``least`` characters are dropped. ``hints``: a text without any of these strings has no match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    hints: tuple[str, ...] = ()
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules, as the contract lists them. A run of 24 hex digits is found at once, for a shorter
#: run holds no match; the same goes for access keys, which end where their run ends.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=6, hints=("=", ":"),
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}", hints=("AKIA",)),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Spans that the method adds: private key headers and forge tokens.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("PRIVATE KEY-----",)),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)
RULES = BASE_RULES + MORE_RULES
FINDINGS = "blob string, rule string, kind string, start long, end long"
SCANNED = "blob string, rule string"


def blob_of(text: str = "text") -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _matches(rule: Rule) -> Column:
    """For each match: the length of the piece before it, its own, and its group's."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    maybe = F.array_contains("todo", rule.name)
    if rule.hints:
        some = F.lit(False)
        for hint in rule.hints:
            some = some | F.contains(text, F.lit(hint))
        maybe = maybe & some
    lengths = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.char_length).alias("before"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length).alias("size"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length).alias("part"),
    )
    return F.when(maybe & F.rlike(text, pattern), lengths)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of ``blobs(blob, text, todo)``, one row for each blob; todo lists rules by name."""
    each = F.array(*(
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"), _matches(r).alias("found"))
        for r in rules
    ))
    by_rule = blobs.select("blob", F.inline(each)).where("found is not null")
    rows = by_rule.select("blob", "rule", "kind", "least", F.posexplode("found").alias("nth", "m")).where("m.size is not null")
    so_far = Window.partitionBy("blob", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.withColumn("end", F.sum(F.col("m.before").cast("long") + F.col("m.size")).over(so_far))
    return ends.where("m.part >= least").select("blob", "rule", "kind", (F.col("end") - F.col("m.size")).alias("start"), "end")


def _ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A part of the ledger; empty before the first run."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_versions(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path: str = "doc_id") -> DataFrame:
    """Scan what the ledger folder has not seen of ``versions(path, text)``.

    Returns (path, blob, findings) for every row given: findings is the array of (start, order, kind,
    end) of its blob under the rules, by start and then the order of the rules.
    """
    spark = versions.sparkSession
    refs = written(versions.select(F.col(path), blob_of().alias("blob")), "blob-refs")
    names = F.array(*(F.lit(r.name) for r in rules))
    seen = _ledger(spark, f"{ledger}/scanned", SCANNED).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    texts = versions.select(blob_of().alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    todo = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
    once = texts.dropDuplicates(["blob"])  # combined on the map side: many copies are a row for each task
    fresh = once.join(seen, "blob", "left").withColumn("todo", todo).where(F.size("todo") > 0)
    scan(fresh.select("blob", "text", "todo"), rules).write.mode("append").parquet(f"{ledger}/findings")
    pairs = refs.select("blob").distinct().join(seen, "blob", "left").select("blob", F.explode(todo).alias("rule"))
    pairs.write.mode("append").parquet(f"{ledger}/scanned")

    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)))
    found = _ledger(spark, f"{ledger}/findings", FINDINGS).where(F.col("rule").isin([r.name for r in rules])).distinct()
    spans = F.sort_array(F.collect_list(F.struct("start", order[F.col("rule")].alias("order"), "kind", "end")))
    return refs.join(found.groupBy("blob").agg(spans.alias("findings")), "blob", "left").select(
        path, "blob", F.coalesce("findings", F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint>>")).alias("findings")
    )
