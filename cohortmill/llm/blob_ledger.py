"""Secret scans over an incremental ledger of blobs.

Every version of every path is named by the digest of its content. The ledger keeps the versions (path, version, blob), which
blobs a version of a rule has seen, and what it found. A scan adds the versions it has not met, looks only at blobs with an unseen
pair of blob and rule version, each blob once however many paths hold it, adds to the ledger, and joins the findings of the
current rules back to all paths: to those of the scan (``scan``), or to every version there ever was (``history``), so that a secret
that was taken out of a file is still reported where it stood. Built-in functions only.

Findings are written before the marks that say a pair was seen: a run that breaks off between them is scanned
again, and findings that are there twice count once. The ledger holds places, not the secrets.

Defined results: null text is the empty blob. A path is a document id as text; rows without one share the null path. Rows that are equal in
id and text are reported each, and are one version. Very long texts are scanned whole; columns other than doc_id and text are not read. An empty
table adds nothing and gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.llm import spans
from cohortmill.llm.spans import Rule
from cohortmill.sources.checkpoints import written

# The patterns of the three kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

RULES = [
    Rule(
        "assign",
        ASSIGN,
        r"(?i:passw|secret|token|api_?key)",
        lambda value: F.length(F.regexp_extract(value, ASSIGN, 2)) >= 6,
    ),
    Rule("access", ACCESS, r"AKIA[A-Z0-9]{16}", lambda value: F.length(value) >= 20),
    # Runs are whole, so those of 24 and more are what is left of all runs after the check.
    Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
]
# The rules as they were before the shortest hexadecimal run was lowered: another version of one rule.
EARLIER_RULES = [*RULES[:2], Rule("hex", r"[0-9a-f]{32,}", r"[0-9a-f]{32}", version=0)]
VERSIONS = "path string, version bigint, blob string"
SEEN = "blob string, rule string"
FINDINGS = "blob string, rule string, spans array<struct<kind:string,start:bigint,end:bigint>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


class BlobLedger:
    """The tables of a ledger below a path that all executors share; made if they aren't there."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        for name, schema in (("versions", VERSIONS), ("seen", SEEN), ("findings", FINDINGS)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{name}")

    @property
    def seen(self) -> DataFrame:
        return self.spark.read.schema(SEEN).parquet(f"{self.path}/seen")

    @property
    def findings(self) -> DataFrame:
        return self.spark.read.schema(FINDINGS).parquet(f"{self.path}/findings")

    @property
    def versions(self) -> DataFrame:
        """Every content a path had, with the scan that first met it there."""
        return self.spark.read.schema(VERSIONS).parquet(f"{self.path}/versions").distinct()

    def _add_versions(self, paths: DataFrame, version: int | None) -> None:
        known = self.versions
        if version is None:
            version = 1 + (known.agg(F.max("version")).first()[0] or 0)
        own = paths.select(F.col("doc_id").cast("string").alias("path"), "blob").distinct()
        known = known.select(F.col("path").alias("_path"), F.col("blob").alias("_blob")).distinct()
        match = F.col("path").eqNullSafe(F.col("_path")) & (F.col("blob") == F.col("_blob"))
        new = own.join(known, match, "left_anti").select("path", F.lit(version).cast("bigint").alias("version"), "blob")
        new.write.mode("append").parquet(f"{self.path}/versions")

    def _found(self, rules: list[Rule]) -> DataFrame:
        """_blob and spans that the given rules have found in it so far."""
        current = self.findings.filter(F.col("rule").isin([rule.name for rule in rules]))
        # A rule's findings for a blob are equal however often they were written, and a blob has at most one per rule.
        own = current.dropDuplicates(["blob", "rule"]).groupBy(F.col("blob").alias("_blob"))
        return own.agg(F.flatten(F.collect_list("spans")).alias("spans"))

    @staticmethod
    def _ordered(rules: list[Rule]) -> Column:
        empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
        found = spans.ordered(F.coalesce("spans", empty), [rule.kind for rule in rules], by_start=True)
        return F.transform(found, lambda s: F.struct(s["kind"], s["start"], s["end"]))

    def history(self, rules: list[Rule] | None = None) -> DataFrame:
        """Every version of every path: path, version, blob, and the spans of the given rules, as far as they have seen it."""
        rules = RULES if rules is None else rules
        joined = self.versions.join(self._found(rules), F.col("blob") == F.col("_blob"), "left")
        return joined.select("path", "version", "blob", self._ordered(rules).alias("spans"))

    def unseen(self, paths: DataFrame, rules: list[Rule]) -> DataFrame:
        """blob, one id that holds it, and the rules (``missing``) that haven't seen it."""
        blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
        current = [rule.name for rule in rules]
        known = self.seen.filter(F.col("rule").isin(current)).groupBy(F.col("blob").alias("_blob"))
        known = known.agg(F.collect_set("rule").alias("known"))
        joined = blobs.join(known, F.col("blob") == F.col("_blob"), "left")
        wanted = F.array(*map(F.lit, current))
        missing = F.when(F.col("known").isNull(), wanted).otherwise(F.array_except(wanted, F.col("known")))
        return joined.select("blob", "doc_id", missing.alias("missing")).filter(F.size("missing") > 0)

    def scan(self, docs: DataFrame, rules: list[Rule] | None = None, version: int | None = None) -> DataFrame:
        """Per row of docs: doc_id, blob, and spans (by start, then rule) of the current rules. ``version`` numbers what is
        new at a path, one more than the last by default."""
        rules = RULES if rules is None else rules
        texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
        texts = texts.withColumn("blob", blob_of(F.col("text")))
        paths = written(texts.select("doc_id", "blob"))
        self._add_versions(paths, version)
        unseen = written(self.unseen(paths, rules)).withColumnsRenamed({"blob": "_blob", "doc_id": "_doc_id"})
        # The narrow side is the one kept in memory; texts pass by it unsorted.
        match = (F.col("blob") == F.col("_blob")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        new = texts.join(unseen.hint("shuffle_hash"), match).select("blob", "text", "missing")
        wanted = {rule.kind: F.array_contains("missing", rule.name) for rule in rules}
        searched = spans.found(new, "text", rules, wanted)
        each = F.array(*[F.struct(F.lit(rule.name).alias("rule"), F.col(f"_{rule.kind}").alias("spans")) for rule in rules])
        lists = searched.select("blob", F.explode(F.filter(each, lambda x: F.size(x["spans"]) > 0)).alias("x"))
        places = F.transform(F.col("x.spans"), lambda s: F.struct(s["kind"], s["start"], s["end"]))
        lists.select("blob", "x.rule", places.alias("spans")).write.mode("append").parquet(f"{self.path}/findings")
        marks = unseen.select(F.col("_blob").alias("blob"), F.explode("missing").alias("rule"))
        marks.write.mode("append").parquet(f"{self.path}/seen")
        joined = paths.join(self._found(rules), F.col("blob") == F.col("_blob"), "left")
        return joined.select("doc_id", "blob", self._ordered(rules).alias("spans"))


def report(scanned: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the spans, and the spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    text = spans.listed(F.col("spans"))
    return scanned.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(text.cast("binary"), 256).alias("base_sha256"),
        text.alias("spans"),
    )
