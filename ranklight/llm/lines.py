"""Line dedup by range-dealt hashes and keep bitmaps (SQL functions only).

A line's key is the line stripped of ASCII white space with A-Z lower-cased.
Keys of ``min_chars`` code points or more that stand in ``min_docs`` documents
or more are frequent: all their lines go, but those of the largest doc_id.

1. Every line with a long key becomes a row of hashes, (key hash, document,
   position); no text travels after this.
2. The rows are dealt by range of (hash, document) and sorted by (hash,
   document, position) within the ranges, so a hash that a third of all lines
   share spreads over as many ranges as its documents fill.  One pass over the
   sorted rows keeps each document's first occurrence of a hash and, at the
   end of a hash's run, its number of documents and its largest one: one row a
   hash and range is all that is dealt again.
3. Frequent hashes meet the rows; Spark splits a frequent hash in that join.
   The positions that go are gathered per document.
4. What returns per document is a bitmap of its lines in run form: (start,
   length) of every run of kept lines.  ``kept_text`` applies it.

The key hash has 128 bits.  A row is known by its doc_id and a 64-bit hash of
its text, which tells versions of one document apart.

Defined cases: a null or empty text has one empty line; a text whose lines all
go becomes empty; repeated rows of one doc_id, equal or not, are one document
when documents are counted, and get their own bitmaps; a null doc_id counts as
no document and is never the largest, so its lines go wherever the key is
frequent; repeated lines in the largest doc_id all stay; an empty table gives
an empty result; very long texts are split whole; further columns are kept by
``remove_lines`` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranklight.llm.common import prepare, table, written
from ranklight.llm.registry import register

MIN_CHARS = 40
MIN_DOCS = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """Stripped, A-Z lower-cased; ``lower`` does the same for ASCII, and faster."""
    bare = F.btrim(line, F.lit(_SPACE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def line_hashes(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with a long key: doc_id, version, pos, h1, h2."""
    d = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"),
                         F.split("text", "\n", -1).alias("lines"))
    rows = d.select("doc_id", "version", F.posexplode("lines").alias("pos", "line"))
    keys = rows.select("doc_id", "version", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keys.select("doc_id", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def frequent_hashes(hashes: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, last_doc) of the hashes in ``min_docs`` documents or more."""
    dealt = (hashes.where("doc_id is not null").repartitionByRange("h1", "h2", "doc_id")
             .sortWithinPartitions("h1", "h2", "doc_id", "version", "pos"))
    # The range of (hash, document) already holds a document's rows of a hash together: no further exchange.
    w = Window.partitionBy("h1", "h2", "doc_id").orderBy("version", "pos")
    firsts = dealt.withColumn("occurrence", F.row_number().over(w)).where("occurrence = 1")
    return (firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last_doc"))
            .where(F.col("docs") >= min_docs).select("h1", "h2", "last_doc"))


def dropped_positions(hashes: DataFrame, frequent: DataFrame) -> DataFrame:
    """(doc_id, version, drop): the sorted positions of the lines that go."""
    return (hashes.join(frequent, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
            .groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("pos")).alias("drop")))


def kept_runs(drop: Column, n: Column) -> Column:
    """Sorted dropped positions of ``n`` lines as the runs of kept lines,
    (start, length) from 0: the run form of a compressed bitmap."""
    starts = F.filter(drop, lambda x, i: F.coalesce(F.get(drop, i - 1) != x - 1, F.lit(True)))
    lasts = F.filter(drop, lambda x, i: F.coalesce(F.get(drop, i + 1) != x + 1, F.lit(True)))
    begin = F.concat(F.array(F.lit(0)), F.transform(lasts, lambda x: x + 1))
    runs = F.zip_with(begin, F.concat(starts, F.array(n)), lambda s, e: F.struct(s.alias("start"), (e - s).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def kept_text(lines: str, keep: Column) -> Column:
    """The lines of column ``lines`` that the bitmap keeps, joined by \\n.

    ``lines`` must be a stored column, here one that comes out of a join: an
    expression would be worked out anew for every run."""
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")


def _with_bitmaps(documents: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``documents`` with _llm_lines (null for a null text) instead of text,
    _llm_version, _llm_n (lines), _llm_dropped and _llm_keep (kept runs)."""
    prepare(documents, "doc_id", "text")
    hashes = written(line_hashes(documents, min_chars), "line-hashes")
    frequent = written(frequent_hashes(hashes, min_docs), "line-frequent")
    drop = dropped_positions(hashes, frequent).select(
        F.col("doc_id").alias("_llm_id"), F.col("version").alias("_llm_hash"), F.col("drop").alias("_llm_drop"))
    d = (documents.withColumn("_llm_version", F.xxhash64("text")).withColumn("_llm_lines", F.split("text", "\n", -1))
         .drop("text"))
    # The hash table is built from the positions; the texts pass by it.
    out = d.join(drop.hint("shuffle_hash"), (F.col("_llm_hash") == F.col("_llm_version"))
                 & d["doc_id"].cast("long").eqNullSafe(F.col("_llm_id")), "left")
    n = F.when(F.col("_llm_lines").isNull(), 1).otherwise(F.size("_llm_lines"))
    drop = F.coalesce("_llm_drop", F.array().cast("array<int>"))
    return (out.withColumn("_llm_n", n).withColumn("_llm_dropped", F.size(drop))
            .withColumn("_llm_keep", kept_runs(F.col("_llm_drop"), n)).drop("_llm_hash", "_llm_id", "_llm_drop"))


def keep_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: doc_id, version (hash of its text), n_lines,
    n_dropped, keep (runs of kept lines; null if all are kept)."""
    d = _with_bitmaps(documents, min_chars, min_docs)
    return d.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_llm_version").alias("version"),
                    F.col("_llm_n").cast("long").alias("n_lines"), F.col("_llm_dropped").cast("long").alias("n_dropped"),
                    F.col("_llm_keep").alias("keep"))


def _text() -> Column:
    """A text after the drops; null for a null text."""
    return F.when(F.col("_llm_dropped") > 0, kept_text("_llm_lines", F.col("_llm_keep"))).otherwise(F.array_join("_llm_lines", "\n"))


def remove_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``documents`` without the lines that go; all columns stay, null texts
    stay null, ``n_chars`` follows a text that changes."""
    d = _with_bitmaps(documents, min_chars, min_docs).withColumn("_llm_text", _text())
    changed = F.when(F.col("_llm_dropped") > 0, F.length("_llm_text").cast("long"))
    cols = [F.col("_llm_text").alias("text") if c == "text" else
            F.coalesce(changed, F.col("n_chars").cast("long")).alias("n_chars") if c == "n_chars"
            else F.col(f"`{c}`") for c in documents.columns]
    return d.select(*cols)


ORACLE_SQL = f"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.last_doc AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id"""


@register("op11_range_line_dedup", ORACLE_SQL)
def op11_range_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, dropped lines and the hash of what its bitmap keeps."""
    d = _with_bitmaps(table(spark, sf_dir, "documents"), MIN_CHARS, MIN_DOCS)
    return d.select("doc_id", F.col("_llm_n").cast("long").alias("n_lines"), F.col("_llm_dropped").cast("long").alias("n_dropped"),
                    F.sha2(F.coalesce(_text(), F.lit("")), 256).alias("kept_sha256"))
