"""Secret scans with an incremental blob ledger (JVM-side SQL functions only).

Every text is content-addressed: its blob id is the SHA-256 of the text, so
all versions and copies of one content are one blob.  A ledger in the shared
folder records which (blob, rule version) pairs were scanned and what was
found.  A run scans only blobs that lack a pair, each blob once, and joins
the findings back to all paths (rows) that hold the blob.  Raising a rule's
version makes every blob unseen for that rule alone.

Positions: Spark has no function that returns the positions of all matches,
but ``split`` on a pattern gives the texts between its matches, and
``regexp_extract_all`` the matches; running sums of both lengths give every
start and end in code points.

Defined cases: a null text is the empty text (its blob has no findings); an
empty table gives an empty result; repeated rows and copies each get the
blob's findings; null ids are kept; extra columns are ignored by
``findings_of`` and kept by ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ranklight.llm.common import prepare, scratch, table, written
from ranklight.llm.registry import register


@dataclass(frozen=True)
class Rule:
    """A span is a match of ``pattern`` whose ``group`` has ``min_len``
    characters or more; matches are leftmost and do not overlap."""

    kind: str
    pattern: str
    group: int = 0
    min_len: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

# Runs of one character class: a shorter run holds no longer one, so the
# least length can stand in the pattern.  In ``assign`` it cannot: a match
# with a short value still uses up its text.
BASE_RULES = (
    Rule("assign", ASSIGN, group=2, min_len=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
EXTRA_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("vcs_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + EXTRA_RULES

# One cheap pass that says whether any rule can match at all.
_ANCHORS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
}


def _anchor(rules) -> str:
    return "|".join(f"(?:{_ANCHORS.get(r.kind, r.pattern)})" for r in rules)


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _matches(text: Column, rule: Rule, index: int) -> Column:
    """Per match (and a last entry for the rest): lengths of the text before
    it, of the match and of the rule's group."""
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("val"))
    lengths = F.transform(zipped, lambda x: F.struct(
        F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.length(x["val"]).alias("val")))
    return F.struct(F.lit(index).alias("kind_no"), F.lit(rule.kind).alias("kind"),
                    F.lit(rule.min_len).alias("min_len"),
                    F.filter(lengths, lambda x: x["hit"].isNotNull()).alias("found"))


def scan_blobs(blobs: DataFrame, rules=RULES) -> DataFrame:
    """``blobs`` (blob_id, text, pending: keys of the rules to run) to one row
    per span: blob_id, rule_key, kind_no, kind, start, end.

    Only texts that pass the anchor pattern are taken apart.  The running sum
    is per blob and rule, so no group is larger than one text's matches.
    """
    # The condition names ``pending`` too, so it stays above the join that
    # found the unseen blobs: no pattern runs over a text already scanned.
    hot = blobs.where(F.when(F.size("pending") > 0, F.col("text").rlike(_anchor(rules))))
    per_rule = F.array(*[
        F.when(F.array_contains("pending", r.key), _matches(F.col("text"), r, i)) for i, r in enumerate(rules)])
    keys = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(i), F.lit(r.key))])
    rows = (hot.select("blob_id", F.explode(per_rule).alias("r")).where("r is not null and size(r.found) > 0")
            .select("blob_id", "r.kind_no", "r.kind", "r.min_len", F.posexplode("r.found").alias("no", "m"))
            .distinct())  # repeated rows of one path and text
    w = Window.partitionBy("blob_id", "kind_no").orderBy("no")
    ends = rows.withColumn("end", F.sum(F.col("m.gap") + F.col("m.hit")).over(w))
    return (ends.where("m.val >= min_len")
            .select("blob_id", keys[F.col("kind_no")].alias("rule_key"), "kind_no", "kind",
                    (F.col("end") - F.col("m.hit")).cast("long").alias("start"), F.col("end").cast("long").alias("end")))


class Ledger:
    """The tables under ``path``: ``scanned`` (blob_id, rule_key) and
    ``findings`` (blob_id, rule_key, kind_no, kind, start, end).

    ``findings`` is written before ``scanned``: a run that dies in between
    leaves its pairs unseen, they are scanned again, and readers drop the
    repeated findings."""

    SCANNED = "blob_id string, rule_key string"
    FINDINGS = "blob_id string, rule_key string, kind_no int, kind string, start long, end long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", self.SCANNED).distinct()

    def findings(self) -> DataFrame:
        return self._read("findings", self.FINDINGS).distinct()

    def update(self, documents: DataFrame, id_col: str = "doc_id", rules=RULES) -> int:
        """Scan every (blob, rule version) pair of ``documents`` that the
        ledger lacks; returns the number of blobs scanned."""
        prepare(documents, id_col, "text")
        manifest = documents.select(F.col(id_col).alias("path_id"), blob_id(F.col("text")).alias("blob_id"))
        wanted = F.array(*[F.lit(r.key) for r in rules])
        seen = self.scanned().groupBy("blob_id").agg(F.collect_set("rule_key").alias("seen"))
        # One row carries a blob: the smallest path.  Ids only are shuffled here.
        unseen = (manifest.groupBy("blob_id").agg(F.min("path_id").alias("path_id"))
                  .join(seen, "blob_id", "left")
                  .withColumn("pending", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
                  .where("size(pending) > 0").select("blob_id", "path_id", "pending"))
        unseen = written(unseen, "ledger-unseen")
        # Text joins the list of carriers on (blob, path), so the copies of one
        # blob spread over the tasks; the hash table is built from the ids.
        texts = documents.select(F.col(id_col).alias("path_id"), F.coalesce("text", F.lit("")).alias("text"))
        u = unseen.alias("u")
        carried = (texts.withColumn("blob_id", F.sha2("text", 256)).alias("t")
                   .join(u.hint("shuffle_hash"), (F.col("t.blob_id") == F.col("u.blob_id"))
                         & F.col("t.path_id").eqNullSafe(F.col("u.path_id")), "inner")
                   .select("t.blob_id", "t.text", "u.pending"))
        found = scan_blobs(carried, rules)
        found.write.mode("append").option("compression", "zstd").parquet(f"{self.path}/findings")
        (unseen.select("blob_id", F.explode("pending").alias("rule_key"))
         .write.mode("append").option("compression", "zstd").parquet(f"{self.path}/scanned"))
        return unseen.count()


def findings_of(documents: DataFrame, ledger: Ledger, id_col: str = "doc_id", rules=RULES) -> DataFrame:
    """One row per path: ``id_col``, blob_id, and found: its spans as
    (start, kind_no, end, kind), sorted; null where there are none."""
    keys = [r.key for r in rules]
    found = (ledger.findings().where(F.col("rule_key").isin(keys)).groupBy("blob_id")
             .agg(F.array_sort(F.collect_list(F.struct("start", "kind_no", "end", "kind"))).alias("found")))
    manifest = documents.select(id_col, blob_id(F.col("text")).alias("blob_id"))
    return manifest.join(found, "blob_id", "left")


def scan(documents: DataFrame, ledger_path: str | None = None, id_col: str = "doc_id", rules=RULES) -> DataFrame:
    """Bring the ledger up to date with ``documents`` and join its findings
    back to all of them.  Without a path the ledger is a new one."""
    spark = documents.sparkSession
    ledger = Ledger(spark, ledger_path or scratch(spark, "ledger"))
    ledger.update(documents, id_col, rules)
    return findings_of(documents, ledger, id_col, rules)


def redact(documents: DataFrame, ledger_path: str | None = None, mark: str = "[SECRET]", rules=RULES) -> DataFrame:
    """``documents`` with every span replaced by ``mark``, overlapping spans
    by one; all columns are kept, ``n_chars`` follows the text if present."""
    spark = documents.sparkSession
    ledger = Ledger(spark, ledger_path or scratch(spark, "ledger"))
    ledger.update(documents, rules=rules)
    keys = [r.key for r in rules]
    w = Window.partitionBy("blob_id").orderBy("start", "end")
    spans = ledger.findings().where(F.col("rule_key").isin(keys)).select("blob_id", "start", "end")
    reach = spans.withColumn("before", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    islands = (reach.withColumn("island", F.sum(F.when(F.col("start") < F.col("before"), 0).otherwise(1)).over(w))
               .groupBy("blob_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    wi = Window.partitionBy("blob_id").orderBy("start")
    # Kept pieces: from the end of one island to the start of the next; the
    # text after the last island is added below.
    cuts = (islands.withColumn("from", F.coalesce(F.lag("end").over(wi), F.lit(0)))
            .groupBy("blob_id").agg(
                F.array_sort(F.collect_list(F.struct("from", (F.col("start") - F.col("from")).alias("len")))).alias("keep"),
                F.max("end").alias("tail")))
    b = F.sha2("text", 256)
    d = documents.withColumn("_llm_blob", F.when(F.col("text").isNotNull(), b))
    cuts = cuts.select(F.col("blob_id").alias("_llm_blob"), F.col("keep").alias("_llm_keep"), F.col("tail").alias("_llm_tail"))
    pieces = F.transform("_llm_keep", lambda x: F.substring("text", x["from"].cast("int") + 1, x["len"].cast("int")))
    tail = F.substring("text", F.col("_llm_tail").cast("int") + 1, F.length("text"))
    text = F.when(F.col("_llm_keep").isNull(), F.col("text")).otherwise(
        F.array_join(F.concat(pieces, F.array(tail)), mark))
    out = d.join(cuts, "_llm_blob", "left").withColumn("_llm_text", text)
    cols = [F.col("_llm_text").alias("text") if c == "text" else
            F.when(F.col("_llm_keep").isNull(), F.col("n_chars")).otherwise(F.length("_llm_text").cast("long")).alias("n_chars")
            if c == "n_chars" else F.col(f"`{c}`") for c in documents.columns]
    return out.select(*cols)


def _digest(found: DataFrame) -> DataFrame:
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    spans = F.coalesce("found", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>"))
    base = F.filter(spans, lambda s: s["kind_no"] < len(BASE_RULES))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))


def _sql_rule(i: int, kind: str, pattern: str, group: int, min_len: int) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, row_no, {i} AS kind_no, '{kind}' AS kind, {min_len} AS min_len,
  unnest(list_zip(list_transform(string_split_regex(t, '{p}'), lambda x: length(x)),
    list_transform(regexp_extract_all(t, '{p}', 0), lambda x: length(x)),
    list_transform(regexp_extract_all(t, '{p}', {group}), lambda x: length(x)))) AS m,
  generate_subscripts(string_split_regex(t, '{p}'), 1) AS no FROM d"""


# RE2 folds some non-ASCII letters under (?i); the classes say ASCII only.
_ASSIGN_SQL = ("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
               "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")

ORACLE_SQL = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(_sql_rule(i, r.kind, _ASSIGN_SQL if r.kind == 'assign' else r.pattern, r.group, r.min_len) for i, r in enumerate(RULES))}),
e AS (SELECT *, sum(m[1] + coalesce(m[2], 0)) OVER (PARTITION BY row_no, kind_no ORDER BY no) AS e FROM m),
s AS (SELECT row_no, kind_no, kind, (e - m[2])::BIGINT AS s, e::BIGINT AS e FROM e WHERE m[3] >= min_len),
g AS (SELECT row_no, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) FILTER (kind_no < {len(BASE_RULES)}), '') AS base,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) AS spans FROM s GROUP BY row_no)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (row_no)"""


@register("op9_secret_ledger", ORACLE_SQL)
def op9_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and spans of its blob's findings."""
    return _digest(scan(table(spark, sf_dir, "documents")))
