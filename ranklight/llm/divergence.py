"""Source divergence audit by one-hot level products.

Per language, how far apart the word distributions of its sources lie, and
which words set a source apart.  A term is a run of ASCII letters and
characters beyond ASCII, A-Z lower-cased; a language keeps the terms in
``min_docs`` of its documents or more.  A group (language, source) gives each
kept term the integer share p = 1 + floor(10^9 (n + 5) / (N + 5 V)): n its
occurrences there, N their sum, V the number of kept terms.  Every step is
exact integer arithmetic.

A share depends on the group and the count alone, so two sources compare by
their joint table: how many terms occur x times in the one and y times in the
other.  Terms stand in blocks, sources in blocks; within a product of blocks
each (source, count) is an indicator column over the terms, and the columns of
one source block, transposed, times those of the other are all joint tables of
their pairs (0/1 in 32-bit floats with at most BLOCK_TERMS rows: exact).  The
tables are priced with |p - q| and only the sum of every pair leaves the task,
added up over products.  Terms are ordered by frequency, so the rows of a block
have few different counts; a block with too many columns is halved.

Distribution: tasks count the terms of whole texts in a bounded table that they
pass on when it is full; sums per (language, source, term) are grouped sums.
Only a block's counts, BLOCK_TERMS x BLOCK_SOURCES at most, ever meet in one
row.  The work is V x sources^2 by definition (each pair is output).

Defined cases: null text, lang and source count as empty strings, and a text
without terms leaves its group without terms; a language without kept terms
has the value 0 for all pairs; a language with one source has no pairs;
repeated rows are documents of their own; ties rank by item (UTF-8); doc_id
and further columns are not read; an empty table gives an empty result; very
long texts are counted in slices.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranklight.functions.index import global_row_number
from ranklight.functions.topk import top_k_per_group
from ranklight.llm.common import prepare, table, written
from ranklight.llm.registry import register

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTH = 5
BLOCK_TERMS = 1024
BLOCK_SOURCES = 64
#: Indicator columns a source, on average, beyond which a product is halved.
LEVELS = 16
#: Entries of the counting table of a task; bytes of a text split at a time.
TABLE_ENTRIES = 300_000
SLICE_BYTES = 1 << 20
#: Sums of block pairs that a task holds.
HELD = 256

# ASCII letters lower-cased, other ASCII characters blank, all else as it is.
_TO_TERMS = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def _slices(text: str):
    """The terms of a text, as lists."""
    data = text.encode("utf-8", "surrogatepass").translate(_TO_TERMS)
    at = 0
    while at < len(data):
        to = data.find(b" ", at + SLICE_BYTES)
        to = len(data) if to < 0 else to
        yield data[at:to].split()
        at = to


def _counts(batches):
    """(lang, source, text) to partial (lang, source, term, n, docs)."""
    tables: dict[tuple, tuple[Counter, Counter]] = {}

    def flush():
        for (lang, source), (n, docs) in tables.items():
            if n:
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), terms,
                     pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
        tables.clear()

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            n, docs = tables.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for terms in _slices(text):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
        if sum(len(n) for n, _ in tables.values()) > TABLE_ENTRIES:
            yield from flush()
    yield from flush()


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE (n + SMOOTH) / (total + SMOOTH * kept)), exact; null without kept terms."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({n} + {SMOOTH} as decimal(20, 0))) "
                  f"div nullif(cast({total} + {SMOOTH} * {kept} as decimal(20, 0)), 0)")


def _columns(counts: np.ndarray, shares: np.ndarray):
    """Indicator columns of one source block over the terms (rows): the 0/1
    matrix, every column's share, the first column of every source."""
    terms, sources = counts.shape
    level = np.arange(sources, dtype=np.int64)[None, :] * (counts.max() + 1) + counts
    found, first, column = np.unique(level, return_index=True, return_inverse=True)
    hot = np.zeros((terms, len(found)), np.float32)
    hot[np.repeat(np.arange(terms), sources), column.ravel()] = 1
    starts = np.searchsorted(found, np.arange(sources, dtype=np.int64) * (counts.max() + 1))
    return hot, shares.ravel()[first], starts


def price(left, right) -> np.ndarray:
    """(sources of left, sources of right): for each pair the sum of |p - q|
    over the terms; a side is (counts, shares), both terms x sources."""
    terms = len(left[0])
    out = np.zeros((left[0].shape[1], right[0].shape[1]), np.int64)
    todo = [(0, terms)] if terms else []
    while todo:
        a, b = todo.pop()
        sides = [_columns(c[a:b], p[a:b]) for c, p in (left, right)]
        if b - a > 1 and any(s[0].shape[1] > LEVELS * len(s[2]) for s in sides):
            mid = (a + b) // 2
            todo += [(a, mid), (mid, b)]
            continue
        (x, p, at_x), (y, q, at_y) = sides
        joint = (x.T @ y).astype(np.int64)
        priced = joint * np.abs(p[:, None] - q[None, :])
        out += np.add.reduceat(np.add.reduceat(priced, at_x, axis=0), at_y, axis=1)
    return out


def _dense(entries, low: int, terms: int, zero: np.ndarray):
    """Counts and shares of a source block, terms x sources; ``zero`` holds the shares of count 0."""
    counts = np.zeros((terms, len(zero)), np.int64)
    shares = np.repeat(zero[None, :], terms, axis=0)
    if entries is not None and len(entries):
        slot, no, n, p = (entries.field(f).to_numpy(zero_copy_only=False) for f in ("slot", "no", "n", "p"))
        counts[slot - low, no] = n
        shares[slot - low, no] = p
    return counts, shares


def _products(batches):
    """Rows (lang, bi, bj, low, terms, zero_i, zero_j, left, right), one per
    product, to (lang, a, b, value) with a < b, partial sums."""
    held: dict[tuple, np.ndarray] = {}

    def flush():
        for (lang, bi, bj), sums in held.items():
            a, b = np.indices(sums.shape).reshape(2, -1)
            a, b, value = a + bi * BLOCK_SOURCES, b + bj * BLOCK_SOURCES, sums.ravel()
            ok = a < b
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * int(ok.sum()), pa.string()), pa.array(a[ok], pa.int64()), pa.array(b[ok], pa.int64()),
                 pa.array(value[ok], pa.int64())], names=["lang", "a", "b", "value"])
        held.clear()

    for batch in batches:
        at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            v = lambda name: at[name][i].as_py()  # noqa: B023, E731
            terms, low = v("terms") or 0, v("low") or 0
            sides = [_dense(at[e][i].values, low, terms, np.array(v(z) if terms else [0] * len(v(z)), np.int64))  # noqa: B023
                     for e, z in (("left", "zero_i"), ("right", "zero_j"))]
            key = (v("lang"), v("bi"), v("bj"))
            got = price(*sides)
            held[key] = held[key] + got if key in held else got
            if len(held) > HELD:
                yield from flush()
    yield from flush()


def term_counts(documents: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: (lang, source, n, no) of every group, with n the sum
    over kept terms and no its place in the language; (lang, term, n, pos) of
    the kept terms with their place by frequency; (lang, source, term, n)."""
    prepare(documents, "lang", "source", "text")
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    d = documents.select(empty("lang"), empty("source"), empty("text"))
    counts = written(d.mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
                     .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    kept = (counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
            .where(F.col("docs") >= min_docs).select("lang", "term", "n"))
    terms = written(global_row_number(kept, ["lang", F.desc("n"), "term"], "pos", start=0), "divergence-terms")
    counts = written(counts.join(terms.select("lang", "term", "pos"), ["lang", "term"])
                     .select("lang", "source", "term", "pos", "n"), "divergence-kept")
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = (d.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
              .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"),
                      (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("no")))
    return written(groups, "divergence-groups"), terms, counts


def _pairs(groups: DataFrame, terms: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, a, b, value) for all pairs a < b of a language's sources."""
    block = F.col("pos") - F.col("pos") % BLOCK_TERMS
    per_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    sized = groups.join(per_lang, "lang", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    sized = sized.withColumn("sb", F.floor(F.col("no") / BLOCK_SOURCES).cast("int"))
    entries = (counts.join(sized.withColumnRenamed("n", "total"), ["lang", "source"])
               .select("lang", block.alias("block"), "sb", F.col("pos").alias("slot"), (F.col("no") % BLOCK_SOURCES).alias("no"),
                       "n", _share("n", "total", "kept").alias("p")))
    # At most BLOCK_TERMS x BLOCK_SOURCES entries a row.
    packed = written(entries.groupBy("lang", "block", "sb").agg(F.collect_list(F.struct("slot", "no", "n", "p")).alias("e")),
                     "divergence-blocks")
    zero = sized.select("lang", "sb", "no", F.coalesce(_share("0", "n", "kept"), F.lit(0)).alias("p"))
    sides = zero.groupBy("lang", "sb").agg(F.array_sort(F.collect_list(F.struct("no", "p"))).alias("z")) \
        .select("lang", "sb", F.col("z.p").alias("zero"))
    i, j = (sides.select("lang", F.col("sb").alias(f"b{x}"), F.col("zero").alias(f"zero_{x}")) for x in "ij")
    blocks = terms.groupBy("lang", block.alias("block")).agg(F.min("pos").alias("low"), F.count(F.lit(1)).alias("terms"))
    products = i.join(j, "lang").where("bi <= bj").join(blocks, "lang", "left")
    for side, name in (("bi", "left"), ("bj", "right")):
        products = products.join(packed.withColumnRenamed("sb", side).withColumnRenamed("e", name), ["lang", "block", side], "left")
    rows = products.select("lang", "bi", "bj", "low", "terms", "zero_i", "zero_j", "left", "right")
    partial = rows.mapInArrow(_products, "lang string, a long, b long, value long")
    return partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _shifted_terms(groups: DataFrame, terms: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): terms that a source uses more than its language."""
    whole = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    shares = terms.join(whole, "lang").select("lang", "term", "kept", _share("n", "lang_total", "kept").alias("q"))
    found = (counts.join(groups.select("lang", "source", F.col("n").alias("total")), ["lang", "source"])
             .join(shares, ["lang", "term"])
             .select("lang", "source", F.col("term").alias("item"), (_share("n", "total", "kept") - F.col("q")).alias("value"))
             .where("value > 0"))
    return top_k_per_group(found, ["lang", "source"], [F.desc("value"), "item"], top, salt=16)


def audit(documents: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """One row per finding: lang, source, part (``pair`` or ``term``), item
    (another source, or a term), value, rank."""
    groups, terms, counts = term_counts(documents, min_docs)
    sums = written(_pairs(groups, terms, counts), "divergence-pairs")
    name = lambda no, c: groups.select("lang", F.col("no").cast("long").alias(no), F.col("source").alias(c))
    pairs = sums.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    both = pairs.select("lang", "source", "item", "value").union(
        pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = both.withColumn("rank", F.row_number().over(w))
    part = lambda df, p: df.select("lang", "source", F.lit(p).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return part(both, "pair").unionByName(part(_shifted_terms(groups, terms, counts, top_terms), "term"))


ORACLE_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  coalesce(text, '') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
l AS (SELECT r, lang, source, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM w),
kept AS (SELECT lang, term, count(*) AS n FROM l GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM l SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source)
  GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n,
    1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTH})) // (g.total + {SMOOTH} * v.v)::HUGEINT AS p,
    1 + ({SCALE}::HUGEINT * (k.n + {SMOOTH})) // (v.total + {SMOOTH} * v.v)::HUGEINT AS q
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""


@register("op12_level_products", ORACLE_SQL)
def op12_level_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and their own terms."""
    return audit(table(spark, sf_dir, "documents"))
