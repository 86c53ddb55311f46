"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Texts are content-addressed: a blob is a distinct text, named by its sha256. The ledger
is two tables in the shared folder: which (blob, rule version) pairs have been scanned, and
what was found. A scan reads the blobs of all versions handed in, takes only the pairs
the ledger does not have, appends them, and joins the findings of a blob back to
every path (document, file version) that holds it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tables import free_name, stored
from textloom.sources import workspace


@dataclass(frozen=True)
class Rule:
    """A kind of secret: pattern, what a match must reach, and a cheap test for texts without any.

    ``group`` must have ``least`` characters. ``needs``: if none of these (lower case) is
    in the lower-cased text, the pattern cannot match.
    """

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    needs: tuple[str, ...] = ()
    base: bool = False


# The kinds every scan has. A run shorter than asked for cannot hold a longer one,
# so the length of `access` and `hex` matches is part of the pattern.
BASE_RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, ("passw", "secret", "token", "api"), True),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20, ("akia",), True),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24, (), True),
)
#: Kinds that the method adds.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1, ("private key-----",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 30, ("eyj",)),
)
RULES = BASE_RULES + MORE_RULES

SCANNED = "blob string, kind string, version int"
FINDINGS = "blob string, kind string, version int, start long, end long"


def blob_of(text: Column) -> Column:
    """Name of a whole text; a null is the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _may_match(text: Column, rule: Rule) -> Column:
    """True wherever the pattern matches."""
    test = text.rlike(rule.pattern)
    if not rule.needs:
        return test
    lowered = F.lower(text)
    some = F.lit(False)
    for need in rule.needs:
        some = some | F.contains(lowered, F.lit(need))
    return some & test


def _pieces(text: Column, rule: Rule) -> Column:
    """Per match of a rule: length of the text before it (since the match before), its own, its group's."""
    pattern = F.lit(rule.pattern)
    def lengths(parts: Column) -> Column:
        return F.transform(parts, lambda part: F.length(part))

    return F.arrays_zip(lengths(F.split(text, rule.pattern, -1)).alias("gap"),
                        lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("own"),
                        lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("held"))


def scan_blobs(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Findings in ``blobs (blob, text)``: spans in code points, end exclusive.

    A blob is scanned once per rule. Matches are exploded with the length of the text
    before each, and a running sum gives the places, so a text with very many
    matches costs no more per match.
    """
    found = F.array_compact(F.array(*[
        F.when(_may_match(F.col("text"), r), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                                                     F.lit(r.least).alias("least"),
                                                     _pieces(F.col("text"), r).alias("pieces")))
        for r in rules]))
    by_rule = blobs.select("blob", F.explode(found).alias("f"))
    pieces = by_rule.select("blob", "f.kind", "f.version", "f.least", F.posexplode("f.pieces").alias("n", "p"))
    so_far = Window.partitionBy("blob", "kind", "version").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    ends = (pieces.where("p.own is not null")
            .withColumn("end", F.sum((F.col("p.gap") + F.col("p.own")).cast("long")).over(so_far)))
    return (ends.where("p.held >= least")
            .select("blob", "kind", "version", (F.col("end") - F.col("p.own")).alias("start"), "end"))


class Ledger:
    """The scanned pairs and the findings below one folder.

    Findings are written before the pairs: a run that dies in between leaves findings
    of pairs that count as unseen; they are scanned again, and reading drops repeats.
    """

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame:
        if not workspace.is_complete(self.spark, f"{self.path}/{name}"):
            columns = (column.split() for column in schema.split(", "))
            return self.spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in columns])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        return self._read("scanned", SCANNED)

    def findings(self, rules: Sequence[Rule]) -> DataFrame:
        """Findings of the present version of each rule."""
        present = F.lit(False)
        for r in rules:
            present = present | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
        return self._read("findings", FINDINGS).where(present).distinct()

    def unseen(self, versions: DataFrame, rule: Rule) -> DataFrame:
        """Rows of ``versions (blob, text)`` whose pair with this rule has not been scanned."""
        done = self.scanned().where((F.col("kind") == rule.kind) & (F.col("version") == rule.version))
        return versions.join(done.select("blob").distinct(), "blob", "left_anti")

    def scan(self, versions: DataFrame, rules: Sequence[Rule] = RULES) -> int:
        """Scan what is unseen in ``versions (text)``; returns the number of pairs scanned.

        Rules with the same unseen blobs are scanned together: texts are cut to one
        of each blob once for each set of rules that have been run equally far.
        """
        texts = versions.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", blob_of(F.col("text")))
        total = 0
        for group in self._rules_by_progress(rules):
            new = self.unseen(texts, group[0])
            blobs = new.groupBy("blob").agg(F.first("text").alias("text"))
            kinds = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
                              for r in group])
            pairs = stored(new.select("blob").distinct().select("blob", F.explode(kinds).alias("k"))
                           .select("blob", "k.kind", "k.version"), "unseen")
            total += pairs.count()
            scan_blobs(blobs, group).write.mode("append").parquet(f"{self.path}/findings")
            pairs.write.mode("append").parquet(f"{self.path}/scanned")
        return total

    def _rules_by_progress(self, rules: Sequence[Rule]) -> list[list[Rule]]:
        """Rules that have seen the same blobs, together."""
        mixed = F.xxhash64("blob")
        seen = {(row["kind"], row["version"]): (row["n"], row["x"]) for row in
                self.scanned().distinct().groupBy("kind", "version")
                .agg(F.count("*").alias("n"), F.bit_xor(mixed).alias("x"))
                .where(F.col("kind").isin([r.kind for r in rules])).collect()}
        groups: dict[tuple, list[Rule]] = {}
        for r in rules:
            groups.setdefault(seen.get((r.kind, r.version), (0, 0)), []).append(r)
        return list(groups.values())


def blob_spans(findings: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per blob with findings: ``(blob, found array<struct<start, kind_no, end>>)``, in order."""
    number = F.lit(len(rules))
    for i, r in reversed(list(enumerate(rules))):
        number = F.when(F.col("kind") == r.kind, i).otherwise(number)
    row = F.struct("start", number.alias("kind_no"), "end")
    return findings.groupBy("blob").agg(F.sort_array(F.collect_list(row)).alias("found"))


def merged_spans(findings: DataFrame) -> DataFrame:
    """One row per blob with findings: ``(blob, found array<struct<start, end>>)``, in order; spans that touch or overlap are one.

    Linear in the spans of a text but for their sort.
    """
    earlier = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.max("end").over(earlier) < F.col("start"), F.lit(True))
    runs = (findings.select("blob", "start", "end").withColumn("apart", apart.cast("long"))
            .withColumn("run", F.sum("apart").over(so_far))
            .groupBy("blob", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    return runs.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("found"))


def spans_text(found: Column, rules: Sequence[Rule]) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_documents(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs (doc_id, text)`` scanned; per row: counts of the base kinds, digest and spans.

    Null and empty texts have no spans. Repeated rows and copies get the same result,
    one row each; other columns are ignored; an empty table gives no rows. Ties of
    start are in the order of ``rules``.
    """
    ledger.scan(docs, rules)
    paths = stored(docs.select("doc_id", blob_of(F.col("text")).alias("blob")), "paths")
    per_blob = stored(blob_spans(ledger.findings(rules), rules), "spans")
    rows = paths.join(per_blob, "blob", "left").withColumn("found", F.coalesce(
        "found", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>")))
    base = [i for i, r in enumerate(rules) if r.base]
    base_found = F.filter("found", lambda s: s["kind_no"].isin(base))

    def count(kind: str) -> Column:
        at = [i for i, r in enumerate(rules) if r.kind == kind]
        return F.size(F.filter("found", lambda s: s["kind_no"].isin(at))).cast("long")

    return rows.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                       count("hex").alias("n_hex"),
                       F.sha2(spans_text(base_found, rules).cast("binary"), 256).alias("base_sha256"),
                       spans_text(F.col("found"), rules).alias("spans"))


def redact(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span of a finding replaced by ``mask``; all rows and columns stay.

    Overlapping spans are replaced as one. ``n_chars``, if there is one, is set to the new
    length. Texts without findings, nulls included, stay as they are. Spans are joined by a shuffle, however few they are:
    they grow with the texts, and disk is in proportion to the input at any size.
    """
    ledger.scan(docs, rules)
    spans = stored(merged_spans(ledger.findings(rules)).select(F.col("blob").alias("found_blob"), "found"), "spans")
    blob, found = free_name(docs, "blob"), free_name(docs, "found")
    spans = spans.withColumnRenamed("found", found)
    rows = docs.withColumn(blob, blob_of(F.col("text"))).join(spans.hint("merge"), F.col(blob) == F.col("found_blob"), "left")

    merged = F.col(found)
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(merged, lambda s: s["end"]))
    starts = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length("text").cast("long")))
    between = F.zip_with(ends, starts, lambda e, s: F.substring(F.col("text"), (e + 1).cast("int"), (s - e).cast("int")))
    clean = F.when(F.col(found).isNull(), F.col("text")).otherwise(F.array_join(between, mask))
    out = rows.withColumn("text", clean)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col(found).isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)
