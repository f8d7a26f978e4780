"""Substring dedup by sliding spans of sentences.

A sentence ends at ``.``, ``!`` or ``?`` followed by white space, or at a line
end.  From every sentence a span is begun: the fewest consecutive sentences
that hold ``MIN_WORDS`` words in two sentences or more; a sentence of
``ALONE_WORDS`` words is a span by itself.  With ``ends``, as the query and
``remove`` ask for, the shortest span that ends at every sentence is one too:
the spans inside a run of two sentences and ``MIN_WORDS`` words or more then
cover all of it, so every such run that repeats is found whole.  Spans depend
on the passage alone, not on where in a document it stands; they are hashed (128 bits,
lower case, one space between words) and joined over all documents; the first
occurrence (smallest doc_id, then place) stays, the sentences covered by any
other occurrence are removed.

Only hashes and offsets are shuffled.  The first occurrence of a hash is a
grouped minimum, combined before the shuffle; occurrences meet it by a join on
the hash whose common keys Spark splits.

A row is known by its doc_id and a 64-bit hash of its text, its version.

Defined cases: null and empty texts have no spans; a repeat inside one
document is removed like any other; rows of one doc_id with different texts
are different rows, in the order of their versions; rows with one doc_id and
equal text stand at the same place and so are all first; null ids count as
smallest, among each other in the order of their versions; an empty table
gives an empty result; very long texts are read whole; further columns are
kept by ``remove``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranklight.llm.common import prepare, table, written
from ranklight.llm.registry import register

MIN_WORDS = 20
ALONE_WORDS = 40
#: Spans handed on at once.
BATCH_SPANS = 1 << 17

_SENTENCE = re.compile(r"[^\s](?:[^\n.!?]++|[.!?](?!\s|$))*+(?:[.!?]++(?=\s|$)|(?=\n|$))")

_SPANS = "doc_id long, version long, h1 long, h2 long, first_no int, last_no int, start int, end int"


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences, in characters, without white space around."""
    out = []
    for m in _SENTENCE.finditer(text):
        s, e = m.span()
        while e > s and text[e - 1].isspace():
            e -= 1
        out.append((s, e))
    return out


def spans_of(text: str, min_words: int = MIN_WORDS, alone_words: int = ALONE_WORDS, ends: bool = False):
    """(hash, first sentence, last sentence, start, end) of every span that
    begins at a sentence, with ``ends`` also of every one that ends at it."""
    bounds = sentences(text)
    words = [text[s:e].lower().split() for s, e in bounds]
    size = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)
    joined = [" ".join(w) for w in words]
    alone = (size[1:] - size[:-1] >= alone_words).tolist()
    # The last sentence of a span: the first that brings enough words.
    reach = (np.searchsorted(size, size[:-1] + min_words) - 1).tolist()
    runs = {(i, i if alone[i] else max(j, i + 1)) for i, j in enumerate(reach)}
    if ends:  # The first sentence of a span: the last that brings enough words.
        back = (np.searchsorted(size, size[1:] - min_words, "right") - 1).tolist()
        runs |= {(j if alone[j] else min(i, j - 1), j) for j, i in enumerate(back)}
    out = []
    for i, j in sorted(runs):
        if i < 0 or j >= len(bounds):
            continue
        h = xxhash.xxh3_128_intdigest(" ".join(joined[i:j + 1]).encode("utf-8", "surrogatepass"))
        out.append((h, i, j, bounds[i][0], bounds[j][1]))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _emit(min_words: int, alone_words: int, ends: bool):
    def batch_of(rows):
        cols = list(zip(*rows)) if rows else [()] * 8
        kinds = [pa.int64()] * 4 + [pa.int32()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                          names=["doc_id", "version", "h1", "h2", "first_no", "last_no", "start", "end"])

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, version in zip(*batch.columns, strict=True):
                d, v = doc.as_py(), version.as_py()
                out += [(d, v, _signed(h >> 64), _signed(h & (2**64 - 1)), *rest)
                        for h, *rest in spans_of(text.as_py() or "", min_words, alone_words, ends)]
                if len(out) >= BATCH_SPANS:
                    yield batch_of(out)
                    out = []
            yield batch_of(out)
    return run


def repeated(documents: DataFrame, min_words: int = MIN_WORDS, alone_words: int = ALONE_WORDS,
             ends: bool = False) -> DataFrame:
    """One row per passage to remove: doc_id, version, start, end (code points, end
    exclusive), n_sentences, n_spans (repeated spans it is made of), first_doc_id
    (the smallest document that keeps a part of it).  Without ``ends`` the tail
    of a passage may stay: sentences after which too few of its words follow."""
    prepare(documents, "doc_id", "text")
    d = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")).alias("version"))
    spans = written(d.mapInArrow(_emit(min_words, alone_words, ends), _SPANS), "sentence-spans")
    # Written, so that the join deals out both sides anew and Spark can split
    # the occurrences of one hash over many tasks.
    firsts = written(spans.groupBy("h1", "h2")
                     .agg(F.min(F.struct("doc_id", "version", "first_no")).alias("first"), F.count(F.lit(1)).alias("n"))
                     .where("n > 1").select("h1", "h2", "first"), "span-firsts")
    here = F.struct("doc_id", "version", "first_no")
    later = (spans.join(firsts, ["h1", "h2"]).where(~here.eqNullSafe(F.col("first")))
             .select("doc_id", "version", "first_no", "last_no", "start", "end", F.col("first.doc_id").alias("first_doc_id")).distinct())
    # Covered sentences that touch are one passage; a document's spans only.
    w = Window.partitionBy("doc_id", "version").orderBy("first_no", "last_no", "first_doc_id")
    reach = F.max("last_no").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("first_no") > reach + 1), 1).otherwise(0)
    return (later.withColumn("begins", begins).withColumn("passage", F.sum("begins").over(w))
            .groupBy("doc_id", "version", "passage").agg(
                F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"),
                (F.max("last_no") - F.min("first_no") + 1).cast("long").alias("n_sentences"),
                F.count(F.lit(1)).alias("n_spans"), F.min("first_doc_id").alias("first_doc_id"))
            .drop("passage"))


def _without(text: Column, cuts: Column) -> Column:
    """The text without the (start, end) intervals, sorted and disjoint."""
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end"]))
    starts = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.length(text).cast("long")))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(text, a.cast("int") + 1, (b - a).cast("int")))
    return F.trim(F.array_join(kept, ""))


def remove(documents: DataFrame, min_words: int = MIN_WORDS, alone_words: int = ALONE_WORDS) -> DataFrame:
    """``documents`` without their repeated passages; all columns and rows
    are kept, ``n_chars`` follows the text if present."""
    passages = repeated(documents, min_words, alone_words, ends=True)
    cuts = (passages.groupBy(F.col("doc_id").alias("_llm_doc"), F.col("version").alias("_llm_version"))
            .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_llm_cuts")))
    d = documents.withColumn("_llm_hash", F.xxhash64(F.col("text").cast("string")))
    d = d.join(cuts, (F.col("_llm_hash") == F.col("_llm_version")) & d["doc_id"].cast("long").eqNullSafe(F.col("_llm_doc")), "left")
    text = F.when(F.col("_llm_cuts").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("_llm_cuts")))
    d = d.withColumn("text", text)
    if "n_chars" in documents.columns:
        d = d.withColumn("n_chars", F.when(F.col("_llm_cuts").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return d.select(*documents.columns)


@register("op6_sentence_spans")
def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that repeat across or within documents, first ones excepted."""
    return repeated(table(spark, sf_dir, "documents"), ends=True).drop("version")
