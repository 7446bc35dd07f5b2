"""Secret scans over a ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger notes which
(blob, rule, rule version) triples have been scanned and what they held; a commit scans only
unseen ones, each blob once however many paths have it, and findings are joined back to paths.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import files

LEDGER = "blob string, rule string, version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern``, leftmost and apart; those whose ``group`` is shorter than ``least`` are dropped."""

    name: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key")))
# The base kinds and their lengths, then the kinds this scanner adds.
BASE_RULES = (
    SecretRule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    SecretRule("access", r"AKIA[A-Z0-9]+", 16),
    SecretRule("hex", r"[0-9a-f]+", 32),
)
ADDED_RULES = (
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20),
)
RULES = BASE_RULES + ADDED_RULES


def blob_id(text: str | Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def find_spans(text: Column, rule: SecretRule) -> Column:
    """Spans of a rule in code points, end exclusive: what lies between matches gives their places."""
    whole = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    state = "struct<at:int,spans:array<struct<start:int,end:int>>>"
    walked = F.aggregate(
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("match"), kept.alias("kept")),
        F.struct(F.lit(0).alias("at"), F.array().alias("spans")).cast(state),
        lambda acc, x: _step(acc, x, rule).cast(state),
        lambda acc: acc["spans"])
    # Most texts have no match: they are not cut up.
    return F.when(text.rlike(rule.pattern if rule.group else _long(rule)), walked).otherwise(
        F.array().cast("array<struct<start:int,end:int>>"))


def _long(rule: SecretRule) -> str:
    """A pattern that a text with a span of the rule must hold; cheaper to test where runs abound."""
    head, plus, rest = rule.pattern.rpartition("]+")
    return f"{head}]{{{rule.least},}}" if plus and not rest and head.startswith("[") else rule.pattern


def _step(acc: Column, x: Column, rule: SecretRule) -> Column:
    start = acc["at"] + F.length(x["gap"])
    end = start + F.coalesce(F.length(x["match"]), F.lit(0))
    fits = F.coalesce(F.length(x["kept"]) >= rule.least, F.lit(False))
    span = F.struct(start.alias("start"), end.alias("end"))
    return F.struct(end.alias("at"), F.when(fits, F.concat(acc["spans"], F.array(span))).otherwise(
        acc["spans"]).alias("spans"))


def read_ledger(spark, path: str) -> DataFrame:
    if files.holds_data(spark, path):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def scan_unseen(versions: DataFrame, ledger: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """New ledger rows: spans of every (blob, rule, version) of ``versions`` (blob, text) not in the ledger.

    A blob's copies meet after each task has dropped its own, so a blob with a third of all rows
    is a row per task.
    """
    wanted = sorted((r.name, r.version) for r in rules)
    seen = (
        ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "version")).alias("seen")))
    one = versions.groupBy("blob").agg(F.first("text").alias("text"))
    todo = one.join(seen, "blob", "left").withColumn(
        "todo", F.array_except(F.array(*[F.lit(f"{n}:{v}") for n, v in wanted]),
                               F.coalesce("seen", F.array().cast("array<string>"))))
    found = [
        F.when(F.array_contains("todo", f"{r.name}:{r.version}"), F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"),
            find_spans(F.col("text"), r).alias("spans")))
        for r in rules]
    return (
        todo.filter(F.size("todo") > 0)
        .select("blob", F.explode(F.array(*found)).alias("f")).filter(F.col("f").isNotNull())
        .select("blob", "f.rule", "f.version", "f.spans"))


def commit(versions: DataFrame, ledger_path: str, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """Scan what the ledger lacks, append it, and return the ledger rows of these rules.

    ``versions`` has blob and text: one row per historical version of a path. A commit that dies
    has appended nothing, one that is repeated finds nothing unseen.
    """
    spark = versions.sparkSession
    fresh = scan_unseen(versions, read_ledger(spark, ledger_path), rules)
    fresh.write.mode("append").parquet(ledger_path)
    now = F.array(*[F.lit(f"{r.name}:{r.version}") for r in rules])
    return read_ledger(spark, ledger_path).filter(F.array_contains(now, F.concat_ws(":", "rule", "version")))


def blob_findings(ledger: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """One row per blob that holds a secret: findings (start, place, rule, end) by start, then order of the rules."""
    place = F.array_position(F.array(*[F.lit(r.name) for r in rules]), F.col("rule"))
    return (
        ledger.filter(F.size("spans") > 0).select("blob", "rule", place.alias("place"), F.explode("spans").alias("s"))
        .groupBy("blob").agg(F.sort_array(F.collect_list(
            F.struct("s.start", "place", "rule", "s.end"))).alias("findings")))


def scan_documents(docs: DataFrame, ledger_path: str, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """Every document with its blob and findings (start, rule, end) by start, then order of the rules.

    NULL texts are empty blobs. Rows are documents, repeated ones too; a text without secrets
    has an empty array.
    """
    addressed = docs.select("doc_id", blob_id("text").alias("blob"), "text")
    ledger = commit(addressed.select("blob", F.coalesce("text", F.lit("")).alias("text")), ledger_path, rules)
    findings = blob_findings(ledger, rules)
    none = F.array().cast("array<struct<start:int,place:bigint,rule:string,end:int>>")
    return (
        docs.select("doc_id", blob_id("text").alias("blob")).join(findings, "blob", "left")
        .select("doc_id", "blob", F.coalesce("findings", none).alias("findings")))


def joined_spans(findings: Column, kinds: Sequence[str] | None = None) -> Column:
    """``kind:start:end``, comma-joined, of all findings or those of some kinds."""
    if kinds is not None:
        findings = F.filter(findings, lambda f: f["rule"].isin(*kinds))
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(
        ":", f["rule"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def count_kind(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["rule"] == kind)).cast("long")


def redact(docs: DataFrame, ledger_path: str, rules: Sequence[SecretRule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents, all columns as they came, with each secret of ``text`` replaced by a mark.

    Overlapping findings are replaced as one; where there is an ``n_chars`` column it is counted
    anew for the texts that change. NULL texts stay NULL.
    """
    addressed = docs.select(blob_id("text").alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    findings = blob_findings(commit(addressed, ledger_path, rules), rules).select(
        F.col("blob").alias("_blob"), F.col("findings").alias("_findings"))
    state = "struct<at:int,text:string>"
    cleaned = F.aggregate(
        "_findings", F.struct(F.lit(0).alias("at"), F.lit("").alias("text")).cast(state),
        lambda acc, f: F.when(f["start"] >= acc["at"], F.struct(f["end"].alias("at"), F.concat(
            acc["text"], F.substring("text", acc["at"] + 1, f["start"] - acc["at"]), F.lit(mark)).alias("text")))
        .otherwise(F.struct(F.greatest(acc["at"], f["end"]).alias("at"), acc["text"].alias("text"))).cast(state),
        lambda acc: F.concat(acc["text"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    joined = docs.withColumn("_key", blob_id("text")).join(findings, F.col("_key") == F.col("_blob"), "left")
    out = joined.withColumn("text", F.when(F.col("_findings").isNotNull(), cleaned).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col("_findings").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(
                docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
