"""Search of sets by the terms they share, without a row for every pair that shares some.

Documents stand in blocks, queries in chunks; a task has one block and streams
one chunk past it.  It counts shared terms in arrays (a list of documents for a
rare term, a byte for every document for a common one) and returns results
only.  What is shuffled is the documents times the chunks and the queries times
the blocks; what a task holds is one block.

Edge cases: empty sets find nothing and are not found; a NULL part meets none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmark.operators.lookup import top_k
from kinmark.session import materialize

#: Documents of a block, queries of a chunk, and the chunks that few queries are dealt to; fewer where the documents, which go to every chunk, are as many.
BLOCK, CHUNK, LEAST_CHUNKS, LEAST_ALIKE = 128_000, 200_000, 16, 4
#: A term of every so-many-th document has a byte for each document.
COMMON = 40
#: Documents, one in each of so many rows of counts, of which the largest count is taken at once.
STRIPES = 64
#: Lists that are read beyond those of which a similar set is in one.
EXTRA = 2


def coded(terms: str) -> Column:
    """A set of terms as sorted 64-bit numbers."""
    return F.array_sort(F.array_distinct(F.transform(terms, lambda t: F.xxhash64(t))))


def part_no(part: str = "part") -> Column:
    """A number for a part."""
    return F.xxhash64(part)


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """set_no, part, terms, dids, did: distinct sets of the documents (did, part, terms), with the k lowest ids of each and the first of them."""
    d = docs.where("part IS NOT NULL AND size(terms) > 0").select(part_no().alias("part"), "did", coded("terms").alias("terms")).withColumn("set_no", F.xxhash64("part", "terms"))
    one = top_k(d, ["set_no"], [F.col("did")], k).groupBy("set_no").agg(F.first("part").alias("part"), F.first("terms").alias("terms"), F.array_sort(F.collect_list("did")).alias("dids"))
    return materialize(one.withColumn("did", F.col("dids")[0]), "document-sets")


def _dealt(docs: DataFrame, queries: DataFrame, order: list[str], least: int) -> tuple[DataFrame, int]:
    """Both (no, ...) under one schema, a partition for each block and chunk, documents first in the given order; the number of blocks."""
    blocks = max(1, -(-docs.count() // BLOCK))
    n = queries.count()
    chunks = max(-(-n // CHUNK), min(least, n // 1000), 1)
    block, chunk = F.pmod(F.col("no"), F.lit(blocks)).cast("int"), F.pmod(F.col("no"), F.lit(chunks)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    d = docs.select("*", each(chunks).alias("other")).withColumn("task", block * chunks + F.col("other")).withColumn("query", F.lit(False))
    q = queries.select("*", each(blocks).alias("other")).withColumn("task", F.col("other") * chunks + chunk).withColumn("query", F.lit(True))
    rows = d.drop("other").unionByName(q.drop("other"), allowMissingColumns=True)
    return rows.repartitionById(blocks * chunks, F.col("task")).drop("task").sortWithinPartitions("query", *order), blocks


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table | None, pa.RecordBatch]]:
    """Batches of queries, with the documents beside the first of them."""
    docs: list[pa.RecordBatch] = []
    table = None
    for b in batches:
        n = b.num_rows - pc.sum(b.column("query").cast(pa.int64())).as_py() if b.num_rows else 0
        if n:
            docs.append(b.slice(0, n))
        if n < b.num_rows:
            if docs:
                table, docs = pa.Table.from_batches(docs), []
            yield table, b.slice(n)
            table = None


def _flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists, and the bounds of each."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(whole).to_numpy(zero_copy_only=False)
    return whole.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


class Postings:
    """Documents, by their numbers, of every term."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray):
        self.n = len(bounds) - 1
        self.sizes = np.diff(bounds)
        self.codes, terms = np.unique(codes, return_inverse=True)
        self.terms = terms.astype(np.int32)  # of each document, one after the other
        self.bounds = bounds
        docs = np.repeat(np.arange(self.n, dtype=np.int32), self.sizes)
        self.docs = docs[np.argsort(self.terms, kind="stable")]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(self.terms, minlength=len(self.codes)))])

    def known(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms of the queries that occur, and the bounds of each query."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = self.codes[at] == codes
        return at[hit], np.concatenate([[0], np.cumsum(hit)])[bounds]


class Best(Postings):
    """The documents that share most terms with a query; of equal ones those of the lowest number."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray):
        super().__init__(codes, bounds)
        df = np.diff(self.starts)
        common = np.flatnonzero(df > max(32, self.n // COMMON))
        self.row = np.full(len(self.codes), -1, dtype=np.int32)
        self.row[common] = np.arange(len(common))
        self.has = np.zeros((len(common), self.n), dtype=np.uint8)
        for i, t in enumerate(common):
            self.has[i, self.docs[self.starts[t] : self.starts[t + 1]]] = 1
        self.counts = np.zeros(-(-self.n // STRIPES) * STRIPES, dtype=np.uint8)  # up to a whole stripe; those behind the last document share nothing
        self.docs = self.docs.astype(np.intp)  # as they are used to index: no cast for each list
        self.terms = None  # not needed here

    def best(self, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, shared terms) of the k best."""
        rows = self.row[terms]
        starts, docs = self.starts, self.docs
        rare = [docs[starts[t] : starts[t + 1]] for t in terms[rows < 0].tolist()]
        rows = rows[rows >= 0].tolist()
        if not rows and len(rare) == 1:
            return rare[0][:k], np.ones(len(rare[0][:k]), dtype=np.int64)
        if not rows and sum(map(len, rare)) < self.n // 8:
            found, shared = np.unique(np.concatenate(rare), return_counts=True)
            first = np.lexsort((found, -shared))[:k]
            return found[first], shared[first]
        counts = self.counts if len(terms) < 256 else np.zeros(len(self.counts), dtype=np.int32)
        counts[:] = 0
        own = counts[: self.n]
        for r in rows:
            own += self.has[r]
        for d in rare:
            own[d] += 1  # a document stands once in a list
        top = counts.reshape(STRIPES, -1).max(axis=0)  # each of another document: k of them reach what the k best reach at least
        low = max(1, int(np.partition(top, len(top) - k)[len(top) - k])) if len(top) > k else 1
        found = np.flatnonzero(own >= low)
        shared = own[found]
        first = np.argsort(np.iinfo(shared.dtype).max - shared, kind="stable")[:k]
        return found[first], shared[first].astype(np.int64)


def ranked(docs: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """qid, did, shared, rank: of all documents that share a term, the k best of each query.

    ``docs`` as of ``document_sets``; ``queries``: qid (a number), part, terms (as of ``part_no``, ``coded``).
    Order: shared terms, share of the union, id.  Where as many are shared, the
    share of the union follows the document's size, so documents are numbered by
    size and lowest id; the k first sets hold the k first documents.
    """
    d = docs.select(F.col("set_no").alias("no"), "part", "terms", "dids", "did", F.size("terms").alias("size"))
    rows, blocks = _dealt(d, queries.select(F.col("qid").alias("no"), "part", "terms"), ["part", "size", "did"], LEAST_CHUNKS)
    kind = docs.schema["did"].dataType
    out = T.StructType([T.StructField("qid", T.LongType()), T.StructField("did", kind), T.StructField("shared", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("rank", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[int, _Part] = {}
        for table, b in _streamed(batches):
            if table is not None:
                parts = table.column("part").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
                of = {int(parts[x]): _Part(table.slice(x, y - x)) for x, y in zip(cuts, cuts[1:], strict=False)}
            asked = b.column("part").to_numpy()
            for p in np.unique(asked).tolist():
                if p in of:
                    yield from of[p].answers(b.filter(pa.array(asked == p)), k)

    found = rows.mapInArrow(run, out)
    if blocks > 1:
        found = top_k(found.drop("rank"), ["qid"], [F.desc("shared"), F.col("size"), F.col("did")], k)
    return found.select("qid", "did", "shared", "rank")


class _Part:
    """The documents of a part, and their ids."""

    def __init__(self, table: pa.Table):
        self.index = Best(*_flat(table.column("terms")))
        dids = table.column("dids").combine_chunks()
        self.dids, n = dids.flatten(), pc.list_value_length(dids).to_numpy(zero_copy_only=False).astype(np.int64)
        self.n, self.start = n, np.cumsum(n) - n
        self.single = bool((n == 1).all())
        if not self.single:  # places of the ids in their order
            self.place = np.empty(len(self.dids), dtype=np.int64)
            self.place[pc.sort_indices(self.dids).to_numpy()] = np.arange(len(self.dids))

    def answers(self, asked: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
        terms, bounds = self.index.known(*_flat(asked.column("terms")))
        cuts = bounds.tolist()
        per, docs, counts = [], [], []
        for i, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if x < y:
                found, shared = self.index.best(terms[x:y], k)
                per.append((i, len(found)))
                docs.append(found)
                counts.append(shared)
        if not per:
            return
        query = np.repeat(*np.array(per).T)
        doc, shared = np.concatenate(docs).astype(np.int64), np.concatenate(counts).astype(np.int64)
        at = self.start[doc]
        if not self.single:
            n = self.n[doc]
            at = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
            query, doc, shared = np.repeat(query, n), np.repeat(doc, n), np.repeat(shared, n)
            order = np.lexsort((self.place[at], self.index.sizes[doc], -shared, query))
            query, doc, shared, at = query[order], doc[order], shared[order], at[order]
        first = np.concatenate([[True], query[1:] != query[:-1]])
        rank = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0)) + 1
        keep = rank <= k
        size = self.index.sizes[doc]
        ids = asked.column("no").take(pa.array(query[keep]))
        numbers = [pa.array(x[keep].astype(np.int32)) for x in (shared, size, rank)]
        yield pa.RecordBatch.from_arrays([ids, self.dids.take(pa.array(at[keep])), *numbers], names=["qid", "did", "shared", "size", "rank"])


class Similar(Postings):
    """The documents, numbered by size, whose Jaccard similarity with a query may exceed a bound."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray):
        super().__init__(codes, bounds)
        self.keys = np.repeat(np.arange(len(self.codes), dtype=np.int64), np.diff(self.starts)) * (self.n + 1) + self.docs
        self.member = np.zeros(len(self.codes), dtype=bool)

    def above(self, codes: np.ndarray, bounds: np.ndarray, bound: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, documents no larger than it, shared terms) where the similarity exceeds the bound.

        Of a query's n terms more than bound * n are shared: a document misses few of
        them, so it is in one of as many lists and one more, and in 1 + e of e further.
        """
        terms, cuts = self.known(codes, bounds)
        sizes = np.diff(bounds)
        least = np.floor(bound * sizes - 1e-9).astype(np.int64) + 1
        of = np.repeat(np.arange(len(sizes)), np.diff(cuts))
        low, high = np.searchsorted(self.sizes, least)[of], np.searchsorted(self.sizes, sizes, side="right")[of]
        x, y = np.searchsorted(self.keys, terms * (self.n + 1) + low), np.searchsorted(self.keys, terms * (self.n + 1) + high)
        order = np.lexsort((y - x, of))  # the rarest terms of each query first
        x, y = x[order].tolist(), y[order].tolist()
        cuts = cuts.tolist()
        for i, (n, least_shared) in enumerate(zip(sizes.tolist(), least.tolist(), strict=True)):
            here, there = cuts[i], cuts[i + 1]
            if there - here < least_shared or not n:
                continue
            extra = min(EXTRA, least_shared - 1)
            upto = there - least_shared + 1 + extra
            lists = np.concatenate([self.docs[a:b] for a, b in zip(x[here:upto], y[here:upto], strict=True)])
            if len(lists) <= extra:
                continue
            lists.sort()
            again = lists[extra:][lists[extra:] == lists[: len(lists) - extra]]
            if not len(again):
                continue
            docs = again[np.concatenate([[True], again[1:] != again[:-1]])]
            own = terms[here:there]
            self.member[own] = True
            size = self.sizes[docs]
            cut = np.cumsum(size) - size
            shared = np.add.reduceat(self.member[self.terms[np.repeat(self.bounds[docs] - cut, size) + np.arange(size.sum())]], cut, dtype=np.int64)
            self.member[own] = False
            above = shared / (n + size - shared) > bound
            if above.any():
                yield i, docs[above], shared[above]


def similar(names: DataFrame, bound: float) -> DataFrame:
    """a, b, similarity: pairs of names (t, terms as of ``coded``) whose sets' Jaccard similarity exceeds the bound, a < b."""
    sets = materialize(names.where("size(terms) > 0").select(F.xxhash64("t").alias("no"), "t", "terms", F.size("terms").alias("size")), "name-sets")
    rows, _ = _dealt(sets, sets, ["size"], LEAST_ALIKE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, texts = None, None
        for table, b in _streamed(batches):
            if table is not None:
                index, texts = Similar(*_flat(table.column("terms"))), table.column("t").combine_chunks()
            if index is None:
                continue
            found = list(index.above(*_flat(b.column("terms")), bound))
            if not found:
                continue
            query, doc, shared = np.repeat([i for i, *_ in found], [len(d) for _, d, _ in found]), np.concatenate([d for _, d, _ in found]), np.concatenate([s for *_, s in found])
            mine, other = b.column("t").take(pa.array(query)), texts.take(pa.array(doc))
            n, m = b.column("size").to_numpy()[query].astype(np.int64), index.sizes[doc]
            once = pc.or_(pa.array(m < n), pc.less(other, mine))  # of equal sizes both search for each other
            yield pa.RecordBatch.from_arrays([mine, other, pa.array(shared / (n + m - shared))], names=["q", "d", "similarity"]).filter(once)

    found = rows.mapInArrow(run, "q string, d string, similarity double")
    return found.select(F.least("q", "d").alias("a"), F.greatest("q", "d").alias("b"), F.round("similarity", 6).alias("similarity"))
