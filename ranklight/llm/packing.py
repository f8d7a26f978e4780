"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' token ids.  The windows of
``window`` ids are filled in rounds: in every round a source earns its target
share of a window as credit, and is served whole slices of ids while its
credit (the deficit carried from earlier rounds and windows) covers them.  A
slice is a quarter of what the smallest source earns in a window, so that
every source is served in every window; it has at least MIN_SLICE ids (sources
that earn less are served every few windows) and at most MAX_SLICE.  Slices
that a round serves to one queue lie side by side and cut nothing.  A queue's last slice is served once its credit covers the same
fraction of it as of the others, so sources of less than a slice are spread
over the stream too.  A source whose queue is empty leaves the rounds, the
others go on.  With the sources' own shares of the corpus as targets (the default) all
queues end together and every window mirrors the corpus.

The credit after r rounds is r times the share, so the number of ids served
before any round has a closed form.  Every document's place in the stream
therefore follows from its offset in its queue and the small table of queues,
with no sequential pass: deficits carry over windows and partitions alike.
The stream has no gaps; window w is its ids from w * window on.

Every source is a queue of its own.  Of more than MAX_QUEUES sources the table
of queues does not go to every task; the same rounds are then computed slice
by slice, and a distributed prefix sum in the order (round, queue, slice)
gives the places.

Jobs: (1) tokenize, writing ids and counts; (2) sum the counts by (partition,
source) and turn them into offsets; (3) cut each document into pieces.

Ties: queues are served in the order of their sources' names, null first;
queues of equal shares start with different credit, so that their slices
spread.  Defined cases: a null text is the empty text and still holds its end id; null
or repeated doc_ids are packed row by row; a null source is a queue of its
own; an empty table gives an empty result; very long texts are cut over many
windows; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranklight.functions.index import global_row_number
from ranklight.llm import tokens
from ranklight.llm.common import prepare, table, written
from ranklight.llm.registry import register

WINDOW = 4096
#: Bounds of the ids served at once; windows meet their targets up to one slice a source.
MIN_SLICE = 32
MAX_SLICE = 256
#: Sources whose queues are sent to every task; of more, places come by joins.
MAX_QUEUES = 255
#: Rounds whose slices are summed up in one task.
BLOCK_ROUNDS = 1 << 12
END_ID = 2
#: Characters of text tokenized before the rows are handed on.
BATCH_CHARS = 1 << 22

PIECES = ("doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_TOKENS = "doc_id long, source string, part int, before long, n long, ids binary"


def _tokenize(path: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        tok = tokens.word_tokenizer(path)
        end = np.array([end_id], "<u4").tobytes()
        before: dict = {}
        for batch in batches:
            rows = zip(batch.column(0), batch.column(1), batch.column(2), strict=True)
            out, chars = [], 0
            for doc, source, text in rows:
                t, s = text.as_py() or "", source.as_py()
                ids = tok.ids(t) + end
                n = len(ids) // 4
                out.append((doc.as_py(), s, part, before.get(s, 0), n, ids))
                before[s] = before.get(s, 0) + n
                chars += len(t)
                if chars >= BATCH_CHARS:
                    yield _batch(out)
                    out, chars = [], 0
            yield _batch(out)
        tok.forget()
    return run


def _batch(rows):
    cols = list(zip(*rows)) if rows else [()] * 6
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                      names=["doc_id", "source", "part", "before", "n", "ids"])


def tokenized(documents: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Written table of the documents' ids (little-endian unsigned 32 bit, the
    end id included), with each row's place among the rows of its source in
    its partition."""
    prepare(documents, "doc_id", "source", "text")
    path = tokenizer_path or tokens.default_path()
    d = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return written(d.mapInArrow(_tokenize(path, end_id), _TOKENS), "packing-tokens")


class Mixture:
    """Sizes and earnings of queues: all of them in order, or those numbered
    ``number`` of ``queues``."""

    def __init__(self, sizes, shares, window: int, slice_tokens: int, number=None, queues: int | None = None):
        self.sizes = np.asarray(sizes, np.int64)
        self.slice = slice_tokens
        self.rate = np.asarray(shares, np.float64) * window / slice_tokens  # slices earned in a round
        # Queues start with different credit, or equal ones would all be served in the same rounds.
        self.phase = (np.arange(len(self.sizes)) if number is None else number) / max(1, queues or len(self.sizes))
        self.last = np.maximum(self.sizes - 1, 0) // slice_tokens
        self.rest = self.sizes - self.last * slice_tokens  # ids of the last slice
        need = self.last + (1 - self.phase) * self.rest / slice_tokens
        self.end = np.maximum(np.ceil(need / self.rate).astype(np.int64) - 1, 0)
        before = self._full(np.maximum(self.last - 1, 0), np.arange(len(self.sizes)))
        self.end = np.where(self.last > 0, np.maximum(self.end, before), self.end)

    def _credit(self, rounds, q):
        return np.floor(rounds * self.rate[q] + self.phase[q]).astype(np.int64)

    def served(self, rounds) -> np.ndarray:
        """Ids of every queue served before each round: (rounds, queues)."""
        slices = np.floor(np.multiply.outer(rounds, self.rate) + self.phase).astype(np.int64)
        return np.minimum(slices, self.last) * self.slice + np.where(np.asarray(rounds)[:, None] > self.end, self.rest, 0)

    def _full(self, slices, q) -> np.ndarray:
        r = np.maximum(np.ceil((slices + 1 - self.phase[q]) / self.rate[q]).astype(np.int64) - 1, 0)
        while (low := self._credit(r + 1, q) <= slices).any():
            r = r + low
        while (high := (r > 0) & (self._credit(r, q) > slices)).any():
            r = r - high
        return r

    def round_of(self, slices, q) -> np.ndarray:
        """The rounds that serve these slices of the queues q."""
        return np.where(slices < self.last[q], self._full(slices, q), self.end[q])

    def place(self, slices, first, q) -> np.ndarray:
        """Places in the stream of ids ``first``, each in its slice of queue q."""
        out = np.empty(len(slices), np.int64)
        for a in range(0, len(slices), 1 << 14):  # bounds the (rounds, queues) tables
            k, f, own = slices[a:a + (1 << 14)], first[a:a + (1 << 14)], q[a:a + (1 << 14)]
            # Many slices share a round, so each round's table is made once.
            rounds, r = np.unique(self.round_of(k, own), return_inverse=True)
            at, turn = self.served(rounds), self.served(rounds + 1)
            turn -= at
            # All that was served before the round, then the queues served earlier in it.
            base = at.sum(axis=1, keepdims=True) + np.cumsum(turn, axis=1) - turn - at
            out[a:a + (1 << 14)] = base[r, own] + f
        return out


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges lo..hi, and the range of each."""
    n = hi - lo + 1
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[owner], owner


def _pieces(slice_tokens: int, window: int, start: np.ndarray, n: np.ndarray, places):
    """Pieces of documents that lie at [start, start + n) of their queues:
    (document, first id, length, place in the stream).  ``places`` gives the
    places of (slice, first id, document)."""
    slices, doc = _spread(start // slice_tokens, (start + n - 1) // slice_tokens)
    first = np.maximum(slices * slice_tokens, start[doc])
    last = np.minimum((slices + 1) * slice_tokens, (start + n)[doc])
    place = places(slices, first, doc)
    # Neighbouring slices that stay together are one run.
    joined = (doc[1:] == doc[:-1]) & (place[1:] == (place + last - first)[:-1])
    new = np.flatnonzero(np.r_[True, ~joined])
    ends = np.r_[new[1:], len(doc)] - 1
    doc, first, place, length = doc[new], first[new], place[new], last[ends] - first[new]
    # Runs are cut where a window ends.
    wins, run = _spread(place // window, (place + length - 1) // window)
    begin = np.maximum(wins * window, place[run])
    size = np.minimum((wins + 1) * window, (place + length)[run]) - begin
    return doc[run], first[run] - start[doc[run]] + begin - place[run], size, begin


def _cut(mix: Mixture | None, window: int, slice_tokens: int):
    """Cuts documents into pieces; without ``mix`` a sixth column has the
    places of the slices that each document touches."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(3)
            n, q, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 4, 5))
            if mix:
                def places(slices, first, doc):
                    return mix.place(slices, first, q[doc])
            else:
                begins = batch.column(6).flatten().to_numpy(zero_copy_only=False)

                def places(slices, first, doc):
                    return begins + first - slices * slice_tokens
            doc, first, size, place = _pieces(slice_tokens, window, start, n, places)
            sums, raw, last = [], b"", -1
            for d, a, m in zip(doc.tolist(), (first * 4).tolist(), (size * 4).tolist(), strict=True):
                if d != last:
                    raw, last = memoryview(ids[d].as_buffer()), d
                sums.append(zlib.crc32(raw[a:a + m]))
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(first), pa.array(size),
                 pa.array(sums, pa.int64()), pa.array(n[doc]), pa.array(place // window), pa.array(place % window)],
                names=["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def _rounds(window: int, slice_tokens: int, queues: int):
    """(queue, slice, ids, round) of the slices that begin in each document."""
    def run(batches):
        for batch in batches:
            queue, start, n, size, share = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            slices, doc = _spread(-(-start // slice_tokens), (start + n - 1) // slice_tokens)
            mix = Mixture(size, share, window, slice_tokens, queue, queues)
            ids = np.minimum(slice_tokens, size[doc] - slices * slice_tokens)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (queue[doc], slices, ids, mix.round_of(slices, doc))],
                                             names=["queue", "slice", "ids", "round"])
    return run


def _slice_places(rows: DataFrame, window: int, slice_tokens: int, queues: int) -> DataFrame:
    """(queue, slice, place) of all slices; ``rows``: queue, start, n, size, share."""
    slices = rows.mapInArrow(_rounds(window, slice_tokens, queues), "queue long, slice long, ids long, round long")
    slices = written(slices.withColumn("block", F.floor(F.col("round") / BLOCK_ROUNDS)), "packing-slices")
    # One row a block of rounds, so a one-task window is fine here.
    blocks = slices.groupBy("block").agg(F.sum("ids").alias("n"))
    ahead = blocks.select("block", (F.sum("n").over(Window.orderBy("block")) - F.col("n")).alias("ahead"))
    w = Window.partitionBy("block").orderBy("round", "queue", "slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (slices.withColumn("upto", F.sum("ids").over(w)).join(ahead, "block")
            .select("queue", "slice", (F.col("ahead") + F.col("upto") - F.col("ids")).alias("place")))


def _queues(totals: DataFrame, total: int, targets: dict | None) -> DataFrame:
    """source, n, queue (by source) and share of every source."""
    numbered = global_row_number(totals, ["source"], "queue", 0)
    natural = F.col("n") / F.lit(float(total))
    if not targets:
        return numbered.withColumn("share", natural)
    # Listed sources get their targets; the others keep their own share of the whole.
    wanted = totals.sparkSession.createDataFrame([(k, float(v)) for k, v in targets.items()], "listed string, target double")
    q = numbered.join(F.broadcast(wanted), F.col("source").eqNullSafe(F.col("listed")), "left")
    listed = q.where("target is not null").agg(F.sum("n").alias("n"), F.sum("target").alias("target")).first()
    scale = listed.n / total / listed.target if listed.n else 1.0
    share = F.greatest(F.coalesce(F.col("target") * F.lit(scale), natural), F.lit(1e-12))
    return q.withColumn("share", share).select("source", "n", "queue", "share")


def slice_size(smallest_share: float, window: int) -> int:
    """Ids served at once: a quarter of the smallest source's share of a window."""
    return max(1, min(window, max(MIN_SLICE, min(MAX_SLICE, int(smallest_share * window / 4)))))


def pack(documents: DataFrame, targets: dict[str, float] | None = None, window: int = WINDOW,
         slice_tokens: int | None = None, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pack all documents into windows; one row per piece (see PIECES).

    ``targets``: token proportions by source (they need not sum to 1);
    sources without one earn in proportion to their size.  ``slice_tokens``:
    ids served at once (None: see ``slice_size``).  Every id lies in exactly
    one piece; only the last window is shorter than ``window``.
    """
    spark = documents.sparkSession
    toks = tokenized(documents, tokenizer_path, end_id)
    # Counts by partition and source: 1 row for each, whatever the documents.
    counts = written(toks.groupBy("source", "part").agg(F.sum("n").alias("n")), "packing-counts")
    totals = counts.groupBy("source").agg(F.sum("n").alias("n"))
    sources, total = totals.agg(F.count(F.lit(1)), F.sum("n")).first()
    queues = written(_queues(totals, total or 1, targets), "packing-queues")
    if slice_tokens is None:
        slice_tokens = slice_size(queues.agg(F.min("share")).first()[0] or 1.0, window)
    of_all = queues.select(F.col("source").alias("s"), F.col("n").alias("size"), "queue", "share")
    w = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.join(of_all, counts["source"].eqNullSafe(of_all["s"]))
                     .withColumn("ahead", F.coalesce(F.sum("n").over(w), F.lit(0)))
                     .select("s", F.col("part").alias("p"), "queue", "size", "share", "ahead"), "packing-starts")
    # Written tables: Spark broadcasts the starts where their files are small, else joins by shuffle.
    placed = toks.join(starts, (toks["part"] == starts["p"]) & toks["source"].eqNullSafe(starts["s"]))
    placed = placed.withColumn("start", F.col("before") + F.col("ahead"))
    rows = placed.select("doc_id", "source", "n", "ids", "queue", "start")
    if sources <= MAX_QUEUES:
        own = queues.orderBy("queue").collect()
        mix = Mixture([r.n for r in own], [r.share for r in own], window, slice_tokens)
        return rows.mapInArrow(_cut(mix, window, slice_tokens), PIECES)
    at = written(placed.select("queue", "start", "n", "size", "share"), "packing-rows")
    places = _slice_places(at, window, slice_tokens, sources)
    # A document is known by its queue and place there.
    touched = F.sequence(F.floor(F.col("start") / slice_tokens), F.floor((F.col("start") + F.col("n") - 1) / slice_tokens))
    held = (at.select("queue", "start", F.explode(touched).alias("slice")).join(places, ["queue", "slice"])
            .groupBy("queue", "start").agg(F.array_sort(F.collect_list(F.struct("slice", "place"))).alias("held"))
            .select(F.col("queue").alias("q"), F.col("start").alias("b"), F.col("held.place").alias("places")))
    rows = rows.join(held, (F.col("queue") == F.col("q")) & (F.col("start") == F.col("b"))).drop("q", "b")
    return rows.mapInArrow(_cut(None, window, slice_tokens), PIECES)


@register("op1_mixture_packing")
def op1_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 ids that mirror the sources' shares."""
    return pack(table(spark, sf_dir, "documents"))
