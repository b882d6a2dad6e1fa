"""Secret scans over an incremental ledger of blobs.

A text version is addressed by the SHA-256 of its content.  The ledger records which rules, in which version,
have seen which blob, and what they found.  A scan reads only the blobs that some rule version has not seen, each
once however many paths have it, appends to the ledger, and joins the findings back to all paths.

Everything is DataFrame functions.  Places of matches come from the lengths of what a pattern parts and of what
it finds, summed up along the text.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import table
from siltstone.sources.files import exists
from siltstone.sources.stage import scratch_path, stage


class Rule(NamedTuple):
    """Leftmost non-overlapping matches of `pattern`; those whose `group` is shorter than `least` are dropped."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    holds: str = ""  # a text without this cannot match

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns of the contract.  The runs of the second and third are as long as they get from
# their first character on, so their least length stands in the pattern.
BASE = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)

#: Further kinds of secrets with fixed beginnings.
MORE = (
    Rule("key", 1, r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", 0, 1, "PRIVATE KEY-----"),
    Rule("github", 1, r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 40, "gh"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30, "eyJ"),
)

RULES = BASE + MORE


def digest(text: Column) -> Column:
    """The address of a text; null is the empty text."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def _cut(text: Column, rule: Rule) -> Column:
    """Of a text with matches: for each, the length of what stands before it, its own, and whether it stays; else null."""
    pattern = F.lit(rule.pattern)
    parts, whole = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    cut = F.transform(whole, lambda m, i: F.struct(F.length(parts[i]).alias("gap"), F.length(m).alias("size"), (F.length(judged[i]) >= rule.least).alias("stays")))
    there = text.rlike(rule.pattern)
    return F.when(text.contains(rule.holds) & there if rule.holds else there, cut)


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path: str = "doc_id", text: str = "text") -> DataFrame:
    """Scan what the ledger in folder `ledger` has not seen, and return `path`, `digest` and `spans` for every
    row of `docs`: kind, start and end (code points, end exclusive) by start, then in the order of the rules.

    Null texts are empty and have no spans.  Repeated rows and null paths are kept; texts of one content are one
    blob and are scanned once (again for rows that repeat its first path).  Findings are appended before the
    record that a blob was seen, so an interrupted scan is repeated, not lost.  Other columns are ignored.  Runs
    jobs.  One scan at a time may write to a ledger.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(path).alias("path"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    paths = stage(texts.select("path", digest(F.col("text")).alias("digest")), "paths")
    keys = F.array(*[F.lit(r.key) for r in rules])
    blobs = paths.groupBy("digest").agg(F.min("path").alias("first_path"))
    if exists(spark, f"{ledger}/seen/_SUCCESS"):
        seen = spark.read.parquet(f"{ledger}/seen").groupBy("digest").agg(F.flatten(F.collect_set("keys")).alias("seen"))
        blobs = blobs.join(seen, "digest", "left").withColumn("due", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))))
    else:
        blobs = blobs.withColumn("due", keys)
    due = stage(blobs.where(F.size("due") > 0).select("digest", "first_path", "due"), "due")
    # texts meet their few bytes of work by path and content, so a content that many paths have is no hot key
    found = (
        texts.withColumn("digest", digest(F.col("text"))).join(
            due.withColumnRenamed("digest", "due_digest").hint("shuffle_hash"),
            (F.col("digest") == F.col("due_digest")) & F.col("path").eqNullSafe(F.col("first_path")),
        ).select("digest", *[F.when(F.array_contains("due", r.key), _cut(F.col("text"), r)).alias(f"rule_{k}") for k, r in enumerate(rules)])
    )
    cuts = F.array_compact(F.array(*[F.when(F.col(f"rule_{k}").isNotNull(), F.struct(F.lit(r.key).alias("rule"), F.col(f"rule_{k}").alias("cuts"))) for k, r in enumerate(rules)]))
    written = stage(found.select("digest", cuts.alias("found")).where(F.size("found") > 0), "cuts")
    along = Window.partitionBy("digest", "rule", "scan").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        written.withColumn("scan", F.monotonically_increasing_id()).select("digest", "scan", F.explode("found").alias("f"))
        .select("digest", "scan", "f.rule", F.posexplode("f.cuts").alias("at", "cut"))
        .withColumn("end", F.sum(F.col("cut.gap") + F.col("cut.size")).over(along))
        .where("cut.stays").select("digest", "rule", (F.col("end") - F.col("cut.size")).alias("start"), "end").distinct()
    )
    placed.write.mode("append").parquet(f"{ledger}/findings")
    due.select("digest", F.col("due").alias("keys")).write.mode("append").parquet(f"{ledger}/seen")

    order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.key, k)])
    # written, so that the join has an exchange on either side and partitions of contents with many paths can be split
    by_blob = stage(
        spark.read.schema(placed.schema).parquet(f"{ledger}/findings").where(F.col("rule").isin([r.key for r in rules])).distinct()
        .groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", order[F.col("rule")].alias("order"), "end"))).alias("found")),  # of one text
        "by-blob",
    )
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform("found", lambda s: F.struct(F.element_at(kinds, s["order"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return paths.join(by_blob, "digest", "left").select("path", "digest", F.coalesce(spans, none).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]", doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """`docs` with each stretch that spans cover replaced by `mark`, and `n_chars`, if there, set anew for
    those texts.  All rows stay, repeated ones and those with null ids too, and so do all other columns, whatever
    their names; null and empty texts are unchanged, and an empty table gives one.  Long texts are cut and joined
    as a whole, within one row.  Runs jobs."""
    found = scan(docs, ledger, rules, doc_id, text).where(F.size("spans") > 0).groupBy(F.col("digest").alias("found_digest")).agg(F.first("spans").alias("spans"))
    found = stage(found, "found")  # small beside the texts; see by_blob in scan
    # spans come by start: one that begins before the reach of those before it goes on their stretch
    merged = F.aggregate(
        F.col("spans"), F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] < F.element_at(done, -1)["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    # the row travels as one struct, since its columns may have any names
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("content"))
    with_spans = rows.join(found.withColumn("merged", merged).select("found_digest", "merged"), digest(F.col("content")) == F.col("found_digest"), "left")
    bounds = F.concat(F.array(F.lit(0).cast("long")), F.col("merged.end"))
    nexts = F.concat(F.col("merged.start"), F.array(F.length("content").cast("long")))
    kept = F.transform(bounds, lambda end, i: F.substring(F.col("content"), (end + 1).cast("int"), (nexts[i] - end).cast("int")))
    out = with_spans.select("row", F.when(F.col("merged").isNotNull(), F.array_join(kept, mark)).alias("clean"))

    def column(c: str) -> Column:
        old = F.col("row").getField(c)
        new = F.col("clean") if c == text else F.length("clean").cast(docs.schema[c].dataType) if c == n_chars else None
        return old.alias(c) if new is None else F.when(F.col("clean").isNotNull(), new).otherwise(old).alias(c)

    return out.select(*[column(c) for c in docs.columns])


# --- query


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(kinds))
    base = of([r.kind for r in BASE])
    counts = [F.size(of([r.kind])).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def _sql() -> str:
    """The same spans in SQL.  Letters in either case are spelt out, since case folding there goes beyond ASCII."""
    cuts = []
    for order, rule in enumerate(RULES):
        pattern = rule.pattern
        if "(?i:" in pattern:
            inner, rest = pattern.removeprefix("(?i:(").split("))", 1)
            pattern = "(" + "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in inner) + ")" + rest
        quoted = pattern.replace("'", "''")
        cuts.append(f"""SELECT doc_id, {order} AS kind_order, '{rule.kind}' AS kind, {rule.least} AS least, string_split_regex(t, '{quoted}') AS parts,
        regexp_extract_all(t, '{quoted}', 0) AS whole, regexp_extract_all(t, '{quoted}', {rule.group}) AS judged FROM d WHERE regexp_matches(t, '{quoted}')""")
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cuts AS ({" UNION ALL ".join(cuts)}),
each AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM cuts),
placed AS (
  SELECT doc_id, kind_order, kind, length(whole[i]) AS size, CAST(list_sum(list_transform(parts[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM each WHERE length(judged[i]) >= least
), listed AS (SELECT *, kind || ':' || s || ':' || (s + size) AS span FROM placed),
found AS (
  SELECT doc_id, {counts}, string_agg(span, ',' ORDER BY s, kind_order) FILTER (kind IN ({base})) AS base_spans,
    string_agg(span, ',' ORDER BY s, kind_order) AS spans FROM listed GROUP BY doc_id
)
SELECT doc_id, {zeros}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN found USING (doc_id)
"""


OP5_SQL = _sql()
