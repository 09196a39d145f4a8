"""Cosine k-nearest-neighbour search over sparse TF-IDF tables and the
category vote over the neighbours."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tessera.operators.ranking import top_k_per_group
from tessera.operators.text import doc_terms, term_freq, tfidf
from tessera.session import checkpoint, large_rows

SHARD_DOCS = 4096       # documents of a stored shard
PART_QUERIES = 8192     # queries of a part
DENSE_ROWS = 2048       # documents scored at once ...
QUERY_BLOCK = 64        # ... with so many queries: what they need stays in a core's cache
TASKS_A_CORE = 4
BLOCK_CELLS = 1 << 19   # cells of a shard or part, unless one vector has more
TILE_BYTES = 8 << 20    # of the smaller shards that are scored together
STEP_CELLS = 1 << 20    # products held at once
DENSE_SHARE = 0.006     # a word shared by more of the pairs is cheaper as a row of a matrix than as a list of documents
MANY = 4                # times k: more candidates of a query are worth a closer look
AXES, AXIS_WORDS = 3, 256


def query_vectors(queries: DataFrame, vocab: DataFrame, idf_df: DataFrame,
                  id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """TF-IDF vectors of free-text queries, same tokenizer / vocabulary / idf
    as the documents: (query_id, idx, weight)."""
    tf = term_freq(doc_terms(queries, vocab, id_col, text_col, totals=True))
    return tfidf(tf, idf_df).withColumnRenamed("doc_id", "query_id")


def vector_rows(vectors: DataFrame, key: str) -> DataFrame:
    """One row per vector: (key, idx array, weight array), sorted by idx."""
    cells = F.sort_array(F.collect_list(F.struct("idx", "weight")))
    return vectors.groupBy(key).agg(cells.alias("c")).select(key, F.col("c.idx").alias("idx"),
                                                             F.col("c.weight").alias("weight"))


class _Rows:
    """Unit vectors of a table with columns ``idx`` and ``weight``: the cells of all rows, and where each row's begin and end."""

    def __init__(self, table: pa.Table):
        n = pc.fill_null(pc.list_value_length(table.column("idx")), 0).to_numpy()
        self.n, self.ends = len(n), np.append(0, n.cumsum())
        self.idx, weight = (pc.list_flatten(table.column(c)).to_numpy() for c in ("idx", "weight"))
        self.row = np.repeat(np.arange(len(n)), n)
        norm = np.sqrt(np.bincount(self.row, weight * weight, len(n)))
        self.unit = weight / np.where(norm > 0, norm, 1.0)[self.row]
        again = (np.diff(self.row) == 0) & (np.diff(self.idx) == 0)
        if again.any():         # of cells that name a word again the last one counts
            kept = np.flatnonzero(~np.append(again, False))
            self.idx, self.row, self.unit = self.idx[kept], self.row[kept], self.unit[kept]
            self.ends = np.searchsorted(self.row, np.arange(self.n + 1))


def _signs(at: np.ndarray, unit: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each word, whether any cell is below nought, and whether any is above."""
    return tuple(np.bincount(at[x], minlength=words) > 0 for x in (unit < 0, unit > 0))


class _Group(_Rows):
    """Queries of a kind: ``at``, each cell's place among the ``words`` of their part,
    ``least``, the score that a document needs to be among a query's best, and ``best``,
    each query's highest estimates while there is no such score."""

    def __init__(self, table: pa.Table, words: np.ndarray):
        super().__init__(table)
        self.at, self.single = np.searchsorted(words, self.idx), self.unit.astype(np.float32)
        self.share = np.bincount(self.at, minlength=len(words)) / max(self.n, 1)
        self.below, self.above = _signs(self.at, self.unit, len(words))
        self.least, self.best = np.full(self.n, -np.inf), None
        del self.idx
        # Estimates are sums in single precision: of n products of unit vectors' cells one errs by (n + 3) / 2^24 at most.
        self.error = (np.diff(self.ends) + 8) * 2.0 ** -23 + 1e-9


class _Asked:
    """A part of the queries: their ``words``, and the queries in groups of a kind.  A
    kind (of a query or a document) is told by the signs of its principal components,
    which tell languages, say.  Vectors of different kinds share fewer words, so
    that scoring takes less time; which are of a kind doesn't touch the result."""

    def __init__(self, table: pa.Table):
        rows = _Rows(table)
        self.n = rows.n
        self.words, at = np.unique(rows.idx, return_inverse=True)
        common = np.argsort(-np.bincount(at), kind="stable")[:AXIS_WORDS]
        place = np.full(len(self.words), -1)
        place[common] = np.arange(len(common))
        cells = np.flatnonzero(place[at] >= 0)
        laid = np.zeros((rows.n, len(common)), np.float32)
        laid[rows.row[cells], place[at[cells]]] = rows.unit[cells]
        laid -= (mean := laid.mean(axis=0))
        axes = np.linalg.eigh(laid.T @ laid)[1][:, -AXES:]
        self.axes = np.zeros((axes.shape[1], len(self.words)))
        self.axes[:, common] = axes.T
        self.middle = mean @ axes
        kind = self.kinds(rows.n, rows.row, at, rows.unit)
        order = np.argsort(kind, kind="stable")
        table = table.take(order)
        self.ids = table.column("query_id")
        del rows, at, laid
        starts = np.flatnonzero(np.diff(kind[order], prepend=-1)).tolist()
        self.groups = [(low, _Group(table.slice(low, high - low), self.words)) for low, high in zip(starts, [*starts[1:], self.n])]

    def kinds(self, n: int, row: np.ndarray, at: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """The kinds of ``n`` vectors, given as cells."""
        return sum((np.bincount(row, unit * axis[at], n) > middle).astype(int) << i for i, (axis, middle) in enumerate(zip(self.axes, self.middle)))


class _Tile:
    """The cells of documents that have words of the queries, documents of a kind
    together; ``doc`` has their positions in the table."""

    def __init__(self, docs: _Rows, asked: _Asked):
        at = np.searchsorted(asked.words, docs.idx)
        at[at == len(asked.words)] = 0
        known = np.flatnonzero(asked.words[at] == docs.idx)
        at, row, unit = at[known], docs.row[known], docs.unit[known]
        kind = asked.kinds(docs.n, row, at, unit)
        self.n, self.doc = docs.n, np.argsort(kind, kind="stable")
        starts = np.append(0, np.bincount(row, minlength=docs.n).cumsum())
        n = np.diff(starts)[self.doc]
        self.ends = np.append(0, n.cumsum())
        cells = np.arange(len(row)) + np.repeat(starts[self.doc] - self.ends[:-1], n)
        self.at, self.unit, self.row = at[cells].astype(np.int32), unit[cells], np.repeat(np.arange(docs.n, dtype=np.int32), n)
        self.starts = np.flatnonzero(np.diff(kind[self.doc], prepend=-1)).tolist()

    def pieces(self, rows: int):
        """``(low, high)`` of up to ``rows`` documents of a kind."""
        for low, high in zip(self.starts, [*self.starts[1:], len(self.doc)]):
            yield from ((x, min(x + rows, high)) for x in range(low, high, rows))


class _Piece:
    """Documents ``low`` to ``high`` of a tile: cells by document, and by word.
    ``order`` sorts the documents by id."""

    def __init__(self, tile: _Tile, low: int, high: int, order: np.ndarray, words: int):
        self.n, self.order, self.words = high - low, order, words
        cells = slice(tile.ends[low], tile.ends[high])
        at, row, unit = tile.at[cells].astype(np.int64), tile.row[cells].astype(np.int64) - low, tile.unit[cells]
        self.keys, self.unit = np.append(row * words + at, self.n * words), np.append(unit, 0.0)
        self.below, self.above = _signs(at, unit, words)
        by_word = np.argsort(at.astype(np.min_scalar_type(words)), kind="stable")
        self.at, self.docs, self.single = at[by_word], row[by_word], unit[by_word].astype(np.float32)
        self.count = np.bincount(at, minlength=words)
        self.start = self.count.cumsum() - self.count

    def exact(self, asked: _Group, query: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Cosines of pairs, each summed in the order of the query's words."""
        n = asked.ends[query + 1] - asked.ends[query]
        out = []
        for step in np.split(np.arange(len(n)), 1 + np.flatnonzero(np.diff(n.cumsum() // STEP_CELLS))):
            m = n[step]
            pair = np.repeat(np.arange(len(step)), m)
            cell = np.arange(len(pair)) + np.repeat(asked.ends[query[step]] - m.cumsum() + m, m)
            key = doc[step][pair] * self.words + asked.at[cell]
            at = np.searchsorted(self.keys, key)
            out.append(np.bincount(pair, np.where(self.keys[at] == key, asked.unit[cell] * self.unit[at], 0.0), len(step)))
        return np.concatenate(out)

    def few(self, scores: np.ndarray, least: float, error: float, k: int, opposed: bool) -> np.ndarray:
        """Whether each document may be among the ``k`` best of a query, by estimates and the score that it needs."""
        if self.n > k:
            least = max(least, np.partition(scores, self.n - k)[self.n - k] - error)
        if least > error or opposed:
            return scores >= least - error
        chosen = scores != 0        # documents without a shared word tie at nought: the first ones do
        chosen[self.order[~chosen[self.order]][:k]] = True
        return chosen

    def candidates(self, asked: _Group, k: int, block: int):
        """``(queries, documents)``, by positions, that may be among the ``k`` best of a query."""
        # Where a product of two cells may be below nought, a sum of nought does not tell that no word is shared.
        opposed = bool((self.below & asked.above | self.above & asked.below).any())
        dense = asked.share * self.count > DENSE_SHARE * self.n
        place = dense.cumsum() - 1
        matrix = np.zeros((dense.sum(), self.n), np.float32)
        common = np.flatnonzero(dense[self.at])
        matrix[place[self.at[common]], self.docs[common]] = self.single[common]
        weights = np.zeros((asked.n, len(matrix)), np.float32)
        common = np.flatnonzero(dense[asked.at])
        weights[asked.row[common], place[asked.at[common]]] = asked.single[common]
        rare = np.flatnonzero(~dense[asked.at] & (self.count[asked.at] > 0))
        single, row, n = asked.single[rare], asked.row[rare], self.count[asked.at[rare]]
        ends = n.cumsum()
        start = self.start[asked.at[rare]] - ends + n
        estimates = np.empty((block, self.n), np.float32)
        if asked.least.min() > -np.inf:
            asked.best = None
        elif asked.best is None:
            asked.best = np.full((asked.n, k), -np.inf, np.float32)
        for low in range(0, asked.n, block):
            high = min(low + block, asked.n)
            scores = np.matmul(weights[low:high], matrix, out=estimates[:high - low])
            at, last = np.searchsorted(row, (low, high))
            while at < last:
                done = ends[at] - n[at]
                to = min(max(at + 1, np.searchsorted(ends, done + STEP_CELLS, "right")), last)
                found, m = np.arange(done, ends[to - 1]), n[at:to]
                found += np.repeat(start[at:to], m)
                products = np.take(self.single, found, mode="clip")
                products *= np.repeat(single[at:to], m)
                found = np.take(self.docs, found, mode="clip")
                found += np.repeat((row[at:to] - low) * self.n, m)
                np.add.at(scores.reshape(-1), found, products)
                at = to
            least, error = asked.least[low:high], asked.error[low:high]
            if asked.best is not None:
                best = np.partition(np.hstack([asked.best[low:high], scores]), self.n, axis=1)[:, self.n:]
                asked.best[low:high], least = best, np.maximum(least, best[:, 0] - error)
            chosen = scores >= (least - error).astype(np.float32)[:, None]
            for i in np.flatnonzero(np.count_nonzero(chosen, axis=1) > MANY * k):
                chosen[i] = self.few(scores[i], least[i], error[i], k, opposed)
            query, doc = np.divmod(np.flatnonzero(chosen), self.n)
            yield query + low, doc


def _score(tile: _Tile, order: np.ndarray, asked: _Asked, k: int, digits: int, block: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, document, score)``, by positions, of all documents that may be among
    the ``k`` best of a query; ``order`` sorts the documents by id."""
    rank, found = np.argsort(order), []
    for low, high in tile.pieces(rows):
        doc_of = tile.doc[low:high]
        piece = _Piece(tile, low, high, np.argsort(rank[doc_of]), len(asked.words))
        for first, group in asked.groups:
            query, doc = (np.concatenate(x) for x in zip(*piece.candidates(group, k, block)))
            found.append((query + first, doc_of[doc], np.round(piece.exact(group, query, doc), digits) + 0.0))
    return tuple(np.concatenate(x) for x in zip(*found))


def _blocks(vectors: DataFrame, size: int, most: int) -> DataFrame:
    """``(block)``: up to ``size`` rows of ``vector_rows`` with up to ``most`` cells each, as an Arrow stream."""
    def packed(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batches[0].schema) as out:
            for batch in batches:
                out.write_batch(batch)
        return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block"])

    def run(batches):
        held, rows, cells = [], 0, 0
        for batch in batches:
            ends = pc.fill_null(pc.list_value_length(batch.column("idx")), 0).to_numpy(zero_copy_only=False).cumsum()
            low = before = 0
            while low < batch.num_rows:
                high = min(low + size - rows, int(np.searchsorted(ends, before + most - cells, "right")))
                if high > low or not held:
                    high = max(high, low + 1)
                    held.append(batch.slice(low, high - low))
                    rows, cells, low, before = rows + high - low, cells + int(ends[high - 1]) - before, high, int(ends[high - 1])
                if low < batch.num_rows:
                    yield packed(held)
                    held, rows, cells = [], 0, 0
        if held:
            yield packed(held)
    return vectors.mapInArrow(run, "block binary")


def _table(block: pa.Scalar) -> pa.Table:
    """The rows of a block, as a copy, so that the batch it came in can go."""
    return pa.ipc.open_stream(block.as_py()).read_all()


def _search(k: int, digits: int, block: int, rows: int, most: int):
    """Scores pairs of a shard of documents and a part of the queries and hands on
    the ``k`` best of each query in all the shards that the task met."""
    by = [("query", "ascending"), ("score", "descending"), ("doc_id", "ascending")]

    def scored(shards, asked):
        documents = pa.concat_tables(shards)
        shards.clear()
        order = pc.sort_indices(documents.column("doc_id")).to_numpy().astype(np.int64)
        ids = documents.column("doc_id").take(pa.array(np.arange(len(order))))      # a copy: the cells go
        tile = _Tile(_Rows(documents), asked)
        del documents
        query, doc, score = _score(tile, order, asked, k, digits, block, rows)
        return pa.table({"query": query, "doc_id": ids.take(pa.array(doc)), "score": score})

    def merged(found, asked):
        best = pa.concat_tables(found).sort_by(by)
        query = best.column("query").to_numpy()
        place = np.arange(len(query)) - np.searchsorted(query, query)
        least, last = np.full(asked.n, -np.inf), place == k - 1
        least[query[last]] = best.column("score").to_numpy()[last]
        for low, group in asked.groups:
            group.least = least[low:low + group.n]
        return best.filter(pa.array(place < k)).combine_chunks()

    def run(batches):
        parts = {}      # the few parts of a task, each with what was found and the shards that wait
        for batch in batches:
            for shard, at, stored in zip(*(batch.column(c) for c in ("shard", "part", "block"))):
                at, new = at.as_py(), at.as_py() not in parts
                if new:
                    parts[at] = _Asked(_table(stored)), [], []
                asked, found, waiting = parts[at]
                waiting.append(_table(shard))
                del shard, stored
                if new or sum(t.nbytes for t in waiting) >= most:
                    found.append(scored(waiting, asked))
                    if new or sum(t.num_rows for t in found) > 2 * k * asked.n:     # the first ones spare candidates in all others
                        found[:] = [merged(found, asked)]
            del batch
        for asked, found, waiting in parts.values():
            if waiting:
                found.append(scored(waiting, asked))
            best = merged(found, asked)
            ids = asked.ids.take(best.column("query"))
            yield from pa.table({"query_id": ids, "doc_id": best.column("doc_id"), "score": best.column("score")}).combine_chunks().to_batches()
    return run


def cosine_topk(qvec: DataFrame, dvec: DataFrame, k: int, digits: int = 10) -> DataFrame:
    """k most similar documents per query by cosine similarity, exactly.

    Documents are stored in shards of at most SHARD_DOCS, queries in parts of
    about PART_QUERIES, a row each.  Their Cartesian product is read from the two
    stored tables, so that what is written to disk grows with the tables and not
    with their product.  A task holds a tile of a few shards, the few
    parts of a partition and k rows per query, whatever the size of the tables; a
    ranking merges the rows of the tasks.  Tasks run over as many shards as keep
    all cores busy.  No (query, document) pair leaves a task, no query passes
    through the driver.

    Every pair is scored in single precision: words that many pairs share by a
    product of matrices, the others by their lists of documents.  What this and
    its bounded error leave among the k best is scored again in double precision.

    A document that shares no word with a query, or a zero norm, scores 0 and
    competes like any other; ties, on the score rounded to ``digits``, go to the
    smaller doc_id.  A query without a vector has no rows.

    Output: (query_id, rank, doc_id, score).
    """
    large_rows(qvec.sparkSession)
    shards = checkpoint(_blocks(vector_rows(dvec, "doc_id"), SHARD_DOCS, BLOCK_CELLS).withColumnRenamed("block", "shard"))
    queries = checkpoint(vector_rows(qvec, "query_id"))
    n, cells = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("idx")), F.lit(0))).first()
    tasks = TASKS_A_CORE * queries.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-n // PART_QUERIES), -(-cells // BLOCK_CELLS), min(-(-tasks // (shards.count() or 1)), -(-n // QUERY_BLOCK)), 1)
    asked = _blocks(queries.repartition(parts), 2 * PART_QUERIES, 2 * BLOCK_CELLS)       # as the rows are dealt evenly, a part of each partition
    asked = checkpoint(asked.withColumn("part", F.monotonically_increasing_id()))
    pairs = shards.coalesce(-(-tasks // parts)).hint("shuffle_replicate_nl").crossJoin(asked)
    kinds = [t.schema[c].dataType.simpleString() for t, c in ((queries, "query_id"), (dvec, "doc_id"))]
    found = pairs.mapInArrow(_search(k, digits, QUERY_BLOCK, DENSE_ROWS, TILE_BYTES), f"query_id {kinds[0]}, doc_id {kinds[1]}, score double")
    return top_k_per_group(found, ["query_id"], [F.desc("score"), F.asc("doc_id")], k).select("query_id", "rank", "doc_id", "score")


def knn_vote(topk: DataFrame, links: DataFrame, k: int, page_col: str = "page",
             category_col: str = "category") -> DataFrame:
    """Category vote over the neighbours: categories of the k documents
    counted per query, k best categories per query (count desc, category asc).
    A document with several categories votes for each of them."""
    hits = topk.select("query_id", F.col("doc_id").alias(page_col))
    # hits has at most (queries x k) rows; AQE turns the join into a
    # broadcast join at run time when that is small, else it stays a shuffle join
    votes = (links.join(hits, page_col)
             .groupBy("query_id", F.col(category_col).alias("category"))
             .agg(F.count(F.lit(1)).alias("votes")))
    return top_k_per_group(votes, ["query_id"], [F.desc("votes"), F.asc("category")], k).drop("rank")
