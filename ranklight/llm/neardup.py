"""MinHash near-duplicates: fast similarity sketches, banding, exact check.

A document's set holds its distinct ``shingle_words``-word shingles (all its
words as one if it has fewer).  Sketch: in rounds, each shingle is hashed to
one of ``bins`` coordinates and a value; a coordinate keeps its smallest
(round, value) pair.  Round i of the first ``bins`` rounds draws the
coordinate at random, round ``bins`` + i puts every shingle into coordinate i,
so all coordinates fill; a document stops at the first round after which none
is empty.  Two sketches agree in a coordinate with probability equal to the
sets' Jaccard similarity, and the share that agrees is concentrated as with
independent hash functions, but a sketch takes about n + bins log bins steps.

Banding: ``rows`` coordinates a band; documents that share a band are
candidates.  At similarity s a pair is missed with probability
(1 - s ** rows) ** bands: 4e-7 at 0.8 with 28 bands of 4, falling steeply
above.  Links are confirmed on the full sets (64-bit shingle hashes).

No bucket is expanded into all pairs.  Documents with equal sets are one
class first.  Pass 1 checks every class of a bucket against the bucket's
smallest class, but for pairs ruled out by an exact bound: a set cannot share
the shingles that no other candidate holds, so with a = size less those,
min(a, a') must reach the overlap that the link needs.  Pass 2 checks what may
still join two components in a bucket that has more than one.  With shingles
in one order, the rare ones first, two sets that link share a shingle early in
both (their overlap must fit behind it), and most of them: common early
shingles and those after the early ones of either must add up to the overlap.
So classes outside the component of
their bucket's smallest class meet others by their early shingles, never by
the bucket, once a pair: copies that drifted apart begin with what each changed
by itself, and do not meet.

Defined cases: null and empty texts, and texts without words, have empty sets
and link with nothing; repeated rows and repeated or null doc_ids are members
of their class like others (a component's id is the smallest non-null doc_id,
null if there is none); an empty table gives an empty result; very long texts
are read whole; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.llm.common import prepare, table, written
from ranklight.llm.components import connected
from ranklight.llm.registry import register

SHINGLE_WORDS = 5
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 80
BANDS, ROWS = 28, 4
#: Words whose hashes a worker keeps before it starts anew.
CACHE_WORDS = 200_000
#: Early shingles that a prefix row carries; all of them for sets of up to
#: 5 * EARLY shingles at 80 %.  More only rule out more pairs before the check.
EARLY = 256
#: Shingles sketched at once; bounds the memory of a task.
BLOCK = 1 << 19

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_EMPTY = np.uint64(2**64 - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles.  Words are runs
    without ASCII white space; A-Z count as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter((_WORDS[w] for w in words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(k, len(h))):
        out = _mix(out + h[i:i + n] + np.uint64(i + 1))
    return np.unique(out)


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """(sets, bins) fast similarity sketches; rows of empty sets are _EMPTY."""
    out = np.full(len(sets) * bins, _EMPTY, np.uint64)
    live = [i for i, s in enumerate(sets) if len(s)]
    if not live:
        return out.reshape(len(sets), bins)
    h = np.concatenate([sets[i] for i in live])
    owner = np.repeat(np.array(live, np.int64), [len(sets[i]) for i in live])
    b = np.uint64(bins)
    for r in range(2 * bins):
        x = _mix(h + np.uint64((r + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        # The high bits pick the coordinate, the low ones are the value; the round stands above.
        where = ((x >> np.uint64(32)) * b >> np.uint64(32)).astype(np.int64) if r < bins else r - bins
        value = (x & np.uint64(0xFFFFFFFF)) | np.uint64(r << 32)
        np.minimum.at(out, owner * bins + where, value)
        open_rows = (out.reshape(-1, bins) == _EMPTY).any(axis=1)
        stay = open_rows[owner]
        if not stay.any():
            break
        h, owner = h[stay], owner[stay]
    return out.reshape(len(sets), bins)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands) 64-bit keys; the band's number is part of the key."""
    s = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), s.shape[:2]).copy()
    for i in range(rows):
        key = _mix(key + s[:, :, i])
    return key


def _blocks(batches, k: int):
    """(rows of the batch as columns, sets) of about BLOCK shingles."""
    for batch in batches:
        texts, ids, sets, size = batch.column(1), [], [], 0
        for i in range(batch.num_rows):
            s = shingles(texts[i].as_py(), k)
            ids.append((batch.column(0)[i].as_py(), batch.column(2)[i].as_py()))
            sets.append(s)
            size += len(s)
            if size >= BLOCK:
                yield ids, sets
                ids, sets, size = [], [], 0
        if ids:
            yield ids, sets
    _WORDS.clear()  # a worker outlives its tasks


def _class(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def _sketch(k: int, bands: int, rows: int):
    def run(batches):
        for ids, sets in _blocks(batches, k):
            keys = band_keys(sketches(sets, bands * rows), bands, rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in ids], pa.int64()), pa.array([v for _, v in ids], pa.int64()),
                pa.array([_class(s) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([row.tolist() if len(s) else [] for row, s in zip(keys, sets, strict=True)], pa.list_(pa.int64()))],
                names=["doc_id", "version", "cls", "n", "bands"])
    return run


def _sets(k: int):
    def run(batches):
        for _, sets in _blocks(batches, k):
            live = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([
                pa.array([_class(s) for s in live], pa.binary()),
                pa.array([s.view(np.int64) for s in live], pa.list_(pa.int64()))], names=["cls", "items"])
    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets link."""
    own = lambda c: sets.select(F.col("cls").alias(c), F.col("items").alias(f"items_{c}"))
    both = pairs.select("a", "b").join(own("b"), "b").join(own("a"), "a")
    both = both.withColumn("common", F.size(F.array_intersect("items_a", "items_b")))
    union = F.size("items_a") + F.size("items_b") - F.col("common")
    return both.where(F.col("common") * 100 >= union * percent).select("a", "b")


def _need(x: str, y: str, percent: int):
    """The least overlap of sizes x and y that links, times (100 + percent)."""
    return (F.col(x) + F.col(y)) * percent


def groups(documents: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT,
           bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, version (64-bit hash of its text), n (set
    size), root (names the component, by content alone; null for an empty set)
    and component_id (the smallest doc_id of the component)."""
    prepare(documents, "doc_id", "text")
    d = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    d = d.withColumn("version", F.xxhash64("text"))
    sk = written(d.mapInArrow(_sketch(shingle_words, bands, rows),
                              "doc_id long, version long, cls binary, n long, bands array<long>"), "neardup-sketches")
    # Classes of equal sets; the bands are a function of the class.
    classes = written(sk.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                                           F.first("bands").alias("bands")), "neardup-classes")
    member = classes.select("cls", "n", F.explode("bands").alias("key"))
    buckets = member.groupBy("key").agg(F.min("cls").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1")
    # size: an upper bound of a link is the smaller set over the larger.
    m = written(member.join(buckets, "key").select("key", "cls", "n", "pivot", "size"), "neardup-buckets")
    pivots = m.select("pivot").distinct().join(classes.select(F.col("cls").alias("pivot"), F.col("n").alias("pivot_n")), "pivot")
    pairs = (m.where("cls != pivot").select("pivot", "cls", "n").distinct().join(pivots, "pivot")
             .where(F.least("n", "pivot_n") * 100 >= F.greatest("n", "pivot_n") * percent)
             .select(F.col("pivot").alias("a"), F.col("cls").alias("b"), F.col("pivot_n").alias("n_a"), F.col("n").alias("n_b")))
    # Sets of the candidates only, from the texts; one row carries a class.
    carrier = m.select("cls").distinct().join(classes.select("cls", "doc_id"), "cls").select("doc_id").distinct()
    carried = d.alias("d").join(carrier.hint("shuffle_hash").alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id"))).select("d.*")
    found = carried.mapInArrow(_sets(shingle_words), "cls binary, items array<long>")
    wanted = m.select("cls").distinct()
    sets = written(found.join(wanted, "cls", "left_semi").dropDuplicates(["cls"]), "neardup-sets")
    # Shingles that one candidate alone holds cannot be shared with another.
    alone = (sets.select("cls", F.explode("items").alias("item")).groupBy("item")
             .agg(F.min("cls").alias("cls"), F.count(F.lit(1)).alias("df")).where("df = 1")
             .groupBy("cls").agg(F.count(F.lit(1)).alias("alone")))
    reach = written(wanted.join(alone, "cls", "left")
                    .join(classes.select("cls", "n"), "cls")
                    .select("cls", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("reach")), "neardup-reach")
    r = lambda c: reach.select(F.col("cls").alias(c), F.col("reach").alias(f"reach_{c}"))
    bound = F.least("reach_a", "reach_b") * (100 + percent) >= _need("n_a", "n_b", percent)
    links = written(_verified(pairs.join(r("a"), "a").join(r("b"), "b").where(bound), sets, percent), "neardup-links")
    roots = written(connected(links), "neardup-roots")
    more = _verified(_between(m, roots, reach, sets, percent), sets, percent)
    roots = connected(links.union(more))
    comp = (classes.select("cls", "doc_id").join(roots, classes["cls"] == roots["node"], "left")
            .select("cls", "doc_id", F.coalesce("root", "cls").alias("root")))
    lowest = comp.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = written(comp.join(lowest, "root").select(F.col("cls").alias("c"), "root", "component_id"), "neardup-named")
    return sk.join(named, sk["cls"] == named["c"], "left").select("doc_id", "version", "n", "root", "component_id")


def near_duplicates(documents: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    out = groups(documents, shingle_words, percent, bands, rows)
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def _prefixes(ordered: DataFrame) -> DataFrame:
    """One row per class and prefix shingle that another class holds too; the
    others (df 1) keep their place and count, but meet nothing and do not
    travel.  ``ordered``: ..., prefix (array of df and item)."""
    early = F.slice("prefix", 1, EARLY)
    shared = F.transform(F.filter(early, lambda x: x["df"] > 1), lambda x: x["item"])
    return (ordered.select("cls", "n", "reach", "root", "outside", shared.alias("early"), F.size(early).alias("n_early"),
                           F.posexplode("prefix").alias("pos", "x"))
            .where("x.df > 1").select("cls", "n", "reach", "root", "outside", "early", "n_early", F.col("x.item").alias("item"),
                                      (F.col("pos") + 1).alias("pos")))


def _between(m: DataFrame, roots: DataFrame, reach: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pass 2: pairs of a bucket in different components that pass the size
    and prefix bounds, and pairs of other buckets that pass them too."""
    root = roots.select(F.col("node").alias("cls"), "root")
    pivot_root = roots.select(F.col("node").alias("pivot"), F.col("root").alias("pivot_root"))
    full = (m.join(root, "cls", "left").join(pivot_root, "pivot", "left")
            .select("key", "cls", "n", F.coalesce("root", "cls").alias("root"),
                    (F.coalesce("root", "cls") != F.coalesce("pivot_root", "pivot")).alias("outside")))
    unsolved = full.groupBy("key").agg(F.max("outside").alias("any")).where("any").select("key")
    # A set links with none if its reach is under the share of itself that any link needs.
    left = (full.join(unsolved, "key").groupBy("cls", "n", "root").agg(F.max("outside").alias("outside"))
            .join(reach, "cls").where(F.col("reach") * 100 >= F.col("n") * percent))
    left = written(left, "neardup-unsolved")
    items = sets.join(left.select("cls"), "cls", "left_semi").select("cls", F.explode("items").alias("item"))
    order = items.groupBy("item").agg(F.count(F.lit(1)).alias("df"))
    # Rare shingles first; the longest prefix that any partner can ask for.
    ordered = (items.join(order, "item").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "item"))).alias("e"))
               .join(left, "cls"))
    most = F.floor((F.col("n") * (100 - percent) + 100) / 100).cast("int")
    prefix = written(_prefixes(ordered.withColumn("prefix", F.slice("e", F.lit(1), most))), "neardup-prefixes")
    cols = ("cls", "pos", "n", "reach", "root", "early", "n_early")
    x = prefix.where("outside").select("item", *[F.col(c).alias(f"{c}_a") for c in cols])
    y = prefix.select("item", *[F.col(c).alias(f"{c}_b") for c in (*cols, "outside")])
    # Shingles of a that may follow the shared one, it included, must reach the overlap; so must b's.
    room = F.least(F.col("n_a") - F.col("pos_a") + 1, F.col("n_b") - F.col("pos_b") + 1, "reach_a", "reach_b")
    # A pair is made once, at its first common shingle, and only if the common
    # early ones and all that may follow the early ones of either reach the overlap.
    common = F.array_intersect("early_a", "early_b")
    first = F.coalesce(F.get(common, F.lit(0)) == F.col("item"), F.lit(True))
    rest = F.greatest(F.col("n_a") - F.col("n_early_a"), F.col("n_b") - F.col("n_early_b"))
    pairs = x.join(y, "item").where(
        (F.col("root_a") != F.col("root_b")) & (room * (100 + percent) >= _need("n_a", "n_b", percent))
        & (~F.col("outside_b") | (F.col("cls_a") < F.col("cls_b")))
        & first & ((F.size(common) + rest) * (100 + percent) >= _need("n_a", "n_b", percent)))
    return pairs.select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).distinct()


# The same by an inverted index and a transitive closure.
ORACLE_SQL = f"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
  ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n - count(*) AS u, count(*) AS i
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n),
l AS (SELECT a, b FROM c WHERE 100 * i >= {PERCENT} * u),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY a)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(low, doc_id)) AS kept FROM s LEFT JOIN m USING (doc_id)"""


@register("op4_fast_similarity_sketch", ORACLE_SQL)
def op4_fast_similarity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by their 2-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)
