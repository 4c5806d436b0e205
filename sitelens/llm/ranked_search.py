"""Ranked lexical search with geometric blocking of posting lists; exact.

Documents are sparse vectors of term impacts. Every posting list that must be
searched is cut into blocks of similar documents, and a block stores the
coordinatewise maximum of its documents. A query's weights times that summary
bound the score of every document of the block, so a block is skipped exactly
when the bound lies below a score that the query's best ``top`` documents are
already known to reach; the others are scored in full.

1. One pass over the documents writes their vectors over the queries' terms
   and counts them; a second pass over the vectors gives every term's document
   frequency and largest impact.
2. A query's rarest posting lists are scored whole. The ``top``-th best score
   is a floor that the answer can't fall below.
3. Lists of terms that together can't reach the floor need no search: a
   document that has only such terms isn't among the best. The rest is indexed.
4. Documents are range-sorted by their heaviest searched terms and cut into
   chunks of similar ones, so a list of any length is spread over the tasks.
   Within a chunk each list's documents join the nearest of some
   representatives (inner product): its blocks.
5. Every chunk is searched by all queries and gives each its own best; the
   best of these are the answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitelens.llm.common import binary_list, materialize, prepare
from sitelens.llm.wordids import Words, gather

TOP = 20
SEED_ROWS = 1000         # postings of its rarest terms that give a query's floor
CHUNK = 1024             # documents of a chunk, fewer if there are very many terms
CELLS = 1 << 24          # documents x terms of a chunk, at most
BLOCK = 16               # documents of a block, about
BATCH_TERMS = 32_768     # terms of the queries that are searched together
RESULT = "item_id long, rank int, doc_id long, score long"
VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"
INDEX = ("doc_ids array<bigint>, ends array<int>, terms array<int>, impacts array<int>, lists array<int>, list_ends array<int>, "
         "members array<int>, member_ends array<int>, coords array<int>, maxima array<int>, coord_ends array<int>")
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), lengths.astype(np.int64)


def _lists(values: np.ndarray, ends: np.ndarray, kind=pa.int32()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(values, kind))


@dataclass
class Queries:
    """The queries searched together; terms are numbers into ``words``."""
    item_ids: list[int | None]
    words: dict[bytes, int]
    terms: list[np.ndarray]              # distinct terms of each query
    times: list[np.ndarray]              # and how often it has them
    weight: np.ndarray | None = None     # of every term
    floor: np.ndarray | None = None      # score that the answer reaches
    needed: list[np.ndarray] = field(default_factory=list)   # terms of each query whose lists are searched

    def weights(self, q: int) -> np.ndarray:
        return self.weight[self.terms[q]] * self.times[q]

    def lists(self) -> dict[int, list[int]]:
        """The queries that search a term's list."""
        out: dict[int, list[int]] = {}
        for q, terms in enumerate(self.needed):
            for t in terms.tolist():
                out.setdefault(t, []).append(q)
        return out


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 25 + (25 * n * n_docs) // n_terms


def _read_queries(items: DataFrame) -> DataFrame:
    """(q, item_id, terms, times): one row per row of ``items``."""
    rows = items.select(F.monotonically_increasing_id().alias("q"), F.col("item_id").cast("long").alias("item_id"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gather(batches, 2):
            w = Words(binary_list(rows.column(2)), _IN_TERM, lower=True)
            n = max(1, len(w.of))
            code, times = np.unique(w.row * n + w.ids, return_counts=True)
            ends = np.searchsorted(code, (np.arange(len(rows)) + 1) * n)
            word = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), w.texts().take(pa.array(code % n)))
            yield pa.RecordBatch.from_arrays([rows.column(0).combine_chunks(), rows.column(1).combine_chunks(), word, _lists(times, ends, pa.int64())],
                                             ["q", "item_id", "terms", "times"])

    return rows.mapInArrow(run, "q long, item_id long, terms array<string>, times array<bigint>")


def _number_terms(rows: list) -> Queries:
    words: dict[bytes, int] = {}
    terms = [np.array([words.setdefault(t.encode("utf-8"), len(words)) for t in r["terms"]], np.int64) for r in rows]
    return Queries([r["item_id"] for r in rows], words, terms, [np.array(r["times"], np.int64) for r in rows])


def vectors(docs: DataFrame, queries: Queries) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: its number of
    terms, and those that a query has with their occurrences."""
    words = docs.sparkSession.sparkContext.broadcast(queries.words)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        n_known = len(known)
        for rows in gather(batches, 1):
            w = Words(binary_list(rows.column(1)), _IN_TERM, lower=True)
            n = np.bincount(w.row, minlength=len(rows))
            data = w.data
            number = np.fromiter((known.get(data[lo:hi], -1) for lo, hi in zip(w.lo[w.of].tolist(), w.hi[w.of].tolist())), np.int64, len(w.of))
            term = number[w.ids]
            code, tf = np.unique((w.row * n_known + term)[term >= 0], return_counts=True)
            ends = np.searchsorted(code, (np.arange(len(rows)) + 1) * n_known)
            out = pa.RecordBatch.from_arrays([rows.column(0).combine_chunks(), pa.array(n.astype(np.int64)), _lists(code % max(1, n_known), ends),
                                              _lists(tf, ends)], ["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))

    return docs.mapInArrow(run, VECTORS)


class _Chunk:
    """Documents with their impacts as a dense matrix over the terms that occur."""

    def __init__(self, doc_ids: pa.Array, lengths: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.doc_ids, self.ends = doc_ids, np.cumsum(lengths)
        self.terms, self.impacts = terms, impacts
        self.present, column = np.unique(terms, return_inverse=True)
        row = np.repeat(np.arange(len(lengths)), lengths)
        self.matrix = np.zeros((len(lengths), len(self.present)), np.int32)
        self.matrix[row, column] = impacts
        # the postings by term
        order = np.argsort(column, kind="stable")
        self.posting_rows, self.posting_ends = row[order], np.cumsum(np.bincount(column, minlength=len(self.present)))

    def column(self, term: int) -> int:
        i = int(np.searchsorted(self.present, term))
        return i if i < len(self.present) and self.present[i] == term else -1

    def columns(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``terms`` occur, their columns)."""
        if not len(self.present):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.present, terms), len(self.present) - 1)
        found = np.flatnonzero(self.present[at] == terms)
        return found, at[found]

    def postings(self, column: int) -> np.ndarray:
        return self.posting_rows[self.posting_ends[column - 1] if column else 0:self.posting_ends[column]]

    def scores(self, queries: Queries, q: int, rows: np.ndarray) -> np.ndarray:
        found, at = self.columns(queries.terms[q])
        return self.matrix[np.ix_(rows, at)].astype(np.int64) @ queries.weights(q)[found]

    def order(self) -> np.ndarray:
        """Document ids for ties; null comes last."""
        return pc.fill_null(self.doc_ids, np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def _chunks(batches: Iterable[pa.RecordBatch], n_docs: int, n_terms: int, size: int) -> Iterator[_Chunk]:
    """Runs of ``size`` rows of ``vectors`` in their order."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == size:
                yield _chunk(pa.Table.from_batches(held), n_docs, n_terms)
                held, rows = [], 0
    if held:
        yield _chunk(pa.Table.from_batches(held), n_docs, n_terms)


def _chunk(rows: pa.Table, n_docs: int, n_terms: int) -> _Chunk:
    terms, lengths = _flat(rows.column("terms"))
    tfs, _ = _flat(rows.column("tfs"))
    m = _length_norm(rows.column("n").to_numpy(), n_docs, n_terms)
    return _Chunk(rows.column("doc_id").combine_chunks(), lengths, terms.astype(np.int64), impact(tfs.astype(np.int64), np.repeat(m, lengths)))


def _term_statistics(vecs: DataFrame, n_words: int, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """(document frequency, largest impact) of every term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, top = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64)
        for c in _chunks(batches, n_docs, n_terms, CHUNK):
            df += np.bincount(c.terms, minlength=n_words)
            np.maximum.at(top, c.terms, c.impacts)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen]), pa.array(top[seen])], ["term", "df", "top"])

    df, top = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64)
    for r in vecs.mapInArrow(run, "term long, df long, top long").groupBy("term").agg(F.sum("df").alias("df"), F.max("top").alias("top")).collect():
        df[r["term"]], top[r["term"]] = r["df"], r["top"]
    return df, top


def _rarest(queries: Queries, df: np.ndarray, rows: int) -> list[np.ndarray]:
    """Of each query the terms with the fewest documents, up to ``rows`` in all
    and beyond by the last one."""
    out = []
    for terms in queries.terms:
        order = terms[np.lexsort((terms, df[terms]))]
        out.append(order[:int(np.searchsorted(np.cumsum(df[order]), rows)) + 1])
    return out


def _floors(vecs: DataFrame, queries: Queries, df: np.ndarray, n_docs: int, n_terms: int, size: int, top: int) -> np.ndarray:
    """Per query the ``top``-th best score among the documents that have one of
    its rarest terms, else 1: no score below it can be in the answer."""
    sc = vecs.sparkSession.sparkContext
    shared = sc.broadcast((queries, _rarest(queries, df, SEED_ROWS)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, seeds = shared.value
        for c in _chunks(batches, n_docs, n_terms, size):
            qs, best = [], []
            for q, terms in enumerate(seeds):
                _, at = c.columns(terms)
                rows = np.unique(np.concatenate([c.postings(i) for i in at])) if len(at) else at
                if len(rows):
                    s = np.sort(c.scores(queries, q, rows))[::-1][:top]
                    qs.append(np.full(len(s), q))
                    best.append(s)
            if qs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(qs).astype(np.int32)), pa.array(np.concatenate(best))], ["q", "score"])

    found = vecs.select("doc_id", "n", "terms", "tfs").mapInArrow(run, "q int, score long").filter("score > 0")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    floor = np.ones(len(queries.terms), np.int64)
    for r in found.withColumn("r", rank).filter(F.col("r") <= top).filter(F.col("r") == top).collect():
        floor[r["q"]] = max(1, r["score"])
    return floor


def _needed(queries: Queries, largest: np.ndarray) -> list[np.ndarray]:
    """Of each query the terms left when those go whose largest contributions
    add up to less than its floor, the smallest first."""
    out = []
    for q, terms in enumerate(queries.terms):
        most = queries.weights(q) * largest[terms]
        order = np.argsort(most, kind="stable")
        enough = np.cumsum(most[order]) >= queries.floor[q]
        out.append(terms[order[enough]])
    return out


class _Blocker:
    """Cuts the searched lists of a chunk into blocks with summaries."""

    def __init__(self, queries: Queries):
        self.queries, self.lists = queries, queries.lists()
        self.seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.searched = np.array(sorted(self.lists), np.int64)

    def around(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """(terms of the queries that search this list, their weights by query)."""
        if term not in self.seen:
            qs = self.lists[term]
            terms = np.unique(np.concatenate([self.queries.terms[q] for q in qs]))
            weights = np.zeros((len(terms), len(qs)))
            for j, q in enumerate(qs):
                weights[np.searchsorted(terms, self.queries.terms[q]), j] = self.queries.weights(q)
            self.seen[term] = terms, weights
        return self.seen[term]

    def build(self, c: _Chunk) -> pa.RecordBatch:
        weighted = c.matrix * self.queries.weight[c.present].astype(np.float32)
        weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1)
        alike = weighted @ weighted.T
        found, at = c.columns(self.searched)
        list_ends, members, member_ends, coords, maxima, coord_ends = [], [], [0], [], [], [0]
        for term, column in zip(self.searched[found].tolist(), at.tolist()):
            rows = c.postings(column)
            # every BLOCK-th document in the chunk's order represents a block
            of = np.argmax(alike[np.ix_(rows, rows[::BLOCK])], axis=1)
            order = np.argsort(of, kind="stable")
            starts = np.flatnonzero(np.diff(of[order], prepend=-1))
            kept, columns = c.columns(self.around(term)[0])
            summary = np.maximum.reduceat(c.matrix[np.ix_(rows[order], columns)], starts, axis=0)
            block, coord = np.nonzero(summary)
            members.append(rows[order])
            member_ends.extend((member_ends[-1] + np.append(starts[1:], len(rows))).tolist())
            coords.append(c.present[columns[coord]])
            maxima.append(summary[block, coord])
            coord_ends.extend((coord_ends[-1] + np.cumsum(np.bincount(block, minlength=len(starts)))).tolist())
            list_ends.append(len(member_ends) - 1)

        def one(*parts) -> pa.Array:
            values = np.concatenate([np.zeros(0, np.int64), *parts])
            return _lists(values, np.array([len(values)]))

        ids = pa.ListArray.from_arrays(pa.array([0, len(c.doc_ids)], pa.int32()), c.doc_ids)
        return pa.RecordBatch.from_arrays(
            [ids, one(c.ends), one(c.terms), one(c.impacts), one(self.searched[found]), one(list_ends), one(*members), one(member_ends[1:]),
             one(*coords), one(*maxima), one(coord_ends[1:])], [f.split()[0] for f in INDEX.split(", ")])

    def search(self, row: dict, top: int) -> tuple[np.ndarray, pa.Array, np.ndarray, int, int]:
        """(queries, doc_ids, scores, blocks met, blocks scored) of one chunk of the index."""
        c = _Chunk(row["doc_ids"], np.diff(row["ends"], prepend=0), row["terms"].astype(np.int64), row["impacts"])
        hit = np.zeros((len(self.queries.terms), len(row["ends"])), bool)
        met = scored = first = 0
        for i, term in enumerate(row["lists"].tolist()):
            last = int(row["list_ends"][i])
            terms, weights = self.around(term)
            lo = int(row["coord_ends"][first - 1]) if first else 0
            hi = int(row["coord_ends"][last - 1])
            sizes = np.diff(row["coord_ends"][first:last], prepend=lo)
            summary = np.zeros((last - first, len(terms)))
            summary[np.repeat(np.arange(last - first), sizes), np.searchsorted(terms, row["coords"][lo:hi])] = row["maxima"][lo:hi]
            qs = np.array(self.lists[term])
            # a margin beyond the rounding of doubles, so that no block is skipped by it
            reach = (summary @ weights) * (1 + 1e-9) >= self.queries.floor[qs]
            met += reach.size
            scored += int(reach.sum())
            for b, j in zip(*np.nonzero(reach)):
                at = first + b
                hit[qs[j], row["members"][(row["member_ends"][at - 1] if at else 0):row["member_ends"][at]]] = True
            first = last
        qs, rows, scores = [], [], []
        ids = c.order()
        for q in np.flatnonzero(hit.any(axis=1)).tolist():
            r = np.flatnonzero(hit[q])
            s = c.scores(self.queries, q, r)
            best = np.lexsort((ids[r], -s))[:top]
            best = best[s[best] >= self.queries.floor[q]]
            qs.append(np.full(len(best), q))
            rows.append(r[best])
            scores.append(s[best])
        if not qs:
            none = np.zeros(0, np.int64)
            return none, c.doc_ids.take(pa.array(none)), none, met, scored
        return np.concatenate(qs), c.doc_ids.take(pa.array(np.concatenate(rows))), np.concatenate(scores), met, scored


def _index(vecs: DataFrame, queries: Queries, n_docs: int, n_terms: int, size: int) -> DataFrame:
    """The chunks of the documents that have a searched term, with their blocks."""
    sc = vecs.sparkSession.sparkContext
    shared = sc.broadcast(queries)

    def heaviest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        searched = np.zeros(len(queries.words), bool)
        searched[list(queries.lists())] = True
        for batch in batches:
            c = _chunk(pa.Table.from_batches([batch]), n_docs, n_terms)
            load = np.where(searched[c.terms], c.impacts * queries.weight[c.terms] + 1, 0)
            row = np.repeat(np.arange(batch.num_rows), np.diff(c.ends, prepend=0))
            order = np.lexsort((c.terms, -load, row))
            place = np.arange(len(order)) - np.concatenate(([0], c.ends[:-1]))[row] if len(row) else row
            keys = np.full((batch.num_rows, 2), -1, np.int64)
            for k in range(2):
                at = order[(place == k) & (load[order] > 0)]
                keys[row[at], k] = c.terms[at]
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys[:, 0]), pa.array(keys[:, 1])], [*batch.schema.names, "k0", "k1"])
            yield out.filter(pa.array(keys[:, 0] >= 0))

    keyed = vecs.mapInArrow(heaviest, VECTORS + ", k0 long, k1 long")
    ordered = keyed.withColumn("h", F.xxhash64("doc_id")).repartitionByRange("k0", "k1", "h").sortWithinPartitions("k0", "k1", "h")

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocker = _Blocker(shared.value)
        for c in _chunks(batches, n_docs, n_terms, size):
            yield blocker.build(c)

    return ordered.select("doc_id", "n", "terms", "tfs").mapInArrow(build, INDEX)


def _search(index: DataFrame, queries: Queries, top: int) -> DataFrame:
    """(q, doc_id, score): of every chunk each query's best documents."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocker = _Blocker(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].values for n in batch.schema.names}
                row = {n: v if n == "doc_ids" else v.to_numpy(zero_copy_only=False) for n, v in row.items()}
                qs, ids, scores, _, _ = blocker.search(row, top)
                yield pa.RecordBatch.from_arrays([pa.array(qs.astype(np.int32)), ids, pa.array(scores.astype(np.int64))], ["q", "doc_id", "score"])

    return index.mapInArrow(run, "q int, doc_id long, score long")


def _search_batch(spark: SparkSession, docs: DataFrame, queries: Queries, top: int) -> DataFrame:
    vecs = materialize(vectors(docs, queries), "search-vectors")
    n_docs, n_terms = vecs.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return spark.createDataFrame([], RESULT)
    size = max(16, min(CHUNK, CELLS // max(1, len(queries.words))))
    df, largest = _term_statistics(vecs, len(queries.words), n_docs, n_terms)
    queries.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    queries.floor = _floors(vecs, queries, df, n_docs, n_terms, size, top)
    queries.needed = _needed(queries, largest)
    index = materialize(_index(vecs, queries, n_docs, n_terms, size), "search-index")
    best = _search(index, queries, top)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(queries.item_ids)), "q int, item_id long")
    return best.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every row of
    ``items``, by score, then doc_id (null last); fewer if fewer score above 0.

    Null, empty or term-free texts have no terms: such items get no rows, such
    documents are neither counted nor found. Repeated documents are found as
    often as they stand, repeated items are ranked each on its own. Empty
    tables give no rows. Other columns are not read. The queries are searched
    in batches of about BATCH_TERMS terms, which bounds what is broadcast."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = materialize(_read_queries(items), "search-queries").filter(F.size("terms") > 0)
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    out = spark.createDataFrame([], RESULT)
    n = -(-total // BATCH_TERMS)
    for b in range(n):
        rows = asked.filter(F.pmod(F.xxhash64("q"), F.lit(n)) == b).orderBy("q").collect()
        if rows:
            out = out.unionByName(_search_batch(spark, docs, _number_terms(rows), top))
    return out
