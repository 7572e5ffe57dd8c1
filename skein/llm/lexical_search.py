"""Operator 11: ranked lexical search by hashed max-sketches and exact rescoring.

1. :func:`build_index` makes every document one row: its number of terms, its distinct terms with
   their counts, and a sketch. Every term hashes to a coordinate, of which a sketch has ``room`` for
   each distinct term, and a coordinate holds the largest impact that falls on it. A term's impact
   grows with its count and with nothing else that differs inside a document, so the sketch stores
   the largest count and the index does not depend on corpus statistics: it can be extended or
   searched again without a rebuild.
2. :func:`search` takes queries in blocks of a bounded number of terms. For a batch of documents
   the sketches become impacts, and one matrix product with the block's term weights bounds the
   score of every document for every query from above (a coordinate is at least the impact of each
   term on it).
3. Documents are rescored exactly, from their own terms and counts, in descending order of bound.
   A query stops at the first bound below its k-th best exact score (seen after every RESCORE
   documents); at an equal bound it goes on, so ties are settled by doc_id. Each task hands on at
   most k rows a query, which are ranked.

Scores are whole numbers: see :func:`weight`, :func:`length_norm` and :func:`impact`.

Defined results: null, empty and termless documents count nowhere and match nothing; a query
without terms, or whose terms are in no document, has no rows; repeated terms of a query count
once; every row of the queries is ranked for itself, also where an item_id is repeated or null;
rows that repeat a doc_id are documents of their own; a null doc_id ranks after all others of its
score; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from skein.llm.common import id_and_text
from skein.session import materialize, release

TOP_K = 10
ROOM, LEAST_WIDTH, MOST_WIDTH = 8, 256, 65_536  # coordinates for each distinct term, rounded to a power of two
MOST = 0xFF  # counts from here on are bounded by the largest impact there is
BLOCK_TERMS, BLOCK_QUERIES = 8192, 256  # of a block of queries; a longer query is a block alone
BATCH_DOCS, BATCH_CELLS = 512, 4_000_000  # documents at a time, and their places for a block's terms
RESCORE = 32
UNIT = 1_000_000  # no impact reaches more

# Everything but digits, letters and what lies beyond ASCII separates terms; A-Z are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """All terms of a text, in order, repeats included (UTF-8)."""
    return (text or "").encode().translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 90 + (90 * n * n_docs) // n_terms


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def coordinates(found: Iterable[bytes], n: int) -> np.ndarray:
    """A 32-bit hash of each of ``n`` terms; its coordinate is the rest by a sketch's width."""
    return np.fromiter(map(zlib.crc32, found), dtype=np.int64, count=n)


def width_for(distinct: int, room: int) -> int:
    return min(max(1 << (distinct * room - 1).bit_length(), LEAST_WIDTH), MOST_WIDTH)


_INDEX = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()),
                    ("counts", pa.binary()), ("sketch", pa.binary())])


def build_index(docs: DataFrame, room: int = ROOM) -> DataFrame:
    """(doc_id, n, terms, counts, sketch) of every document with a term, written once. ``terms`` are
    the distinct ones joined by a space, ``counts`` unsigned 32-bit, ``sketch`` a byte a coordinate."""
    def index(batches):
        for batch in batches:
            out = {name: [] for name in _INDEX.names}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                all_terms = terms(text)
                if not all_terms:
                    continue
                found = Counter(all_terms)
                counts = np.fromiter(found.values(), dtype="<u4", count=len(found))
                sketch = np.zeros(width_for(len(found), room), dtype=np.uint8)
                np.maximum.at(sketch, coordinates(found, len(found)) % len(sketch), np.minimum(counts, MOST).astype(np.uint8))
                for name, v in zip(out, (doc_id, len(all_terms), b" ".join(found), counts.tobytes(), sketch.tobytes())):
                    out[name].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_INDEX)

    return materialize(id_and_text(docs).mapInArrow(
        index, "doc_id long, n long, terms binary, counts binary, sketch binary"), "search-index")


def query_rows(queries: DataFrame) -> DataFrame:
    """(query, item_id, terms array<binary>): the distinct terms of each row of ``queries(item_id,
    text)``, numbered and written once; rows without terms are left out."""
    def distinct(batches):
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))],
                                             names=["item_id", "terms"])

    rows = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(distinct, "item_id long, terms array<binary>")
                       .where(F.size("terms") > 0).withColumn("query", F.monotonically_increasing_id()), "queries")


def blocks(rows: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[list[Row]]:
    """The queries, in blocks that hold at most ``block_terms`` terms or one query; one block is on
    the driver at a time."""
    block, size = [], 0
    for row in rows.toLocalIterator():
        if block and (size + len(row.terms) > block_terms or len(block) >= BLOCK_QUERIES):
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row.terms)
    if block:
        yield block


def document_frequencies(index: DataFrame, wanted: frozenset[bytes]) -> dict[bytes, int]:
    """How many documents hold each of the ``wanted`` terms (a block's, so bounded); counted in the
    tasks first, each of which sends a term once."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def count(batches):
        vocabulary, seen = shared.value, Counter()
        for batch in batches:
            for held in batch.column("terms").to_pylist():
                seen.update(vocabulary.intersection(held.split(b" ")))
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.binary()),
                                          "df": pa.array(list(seen.values()), pa.int64())})

    found = index.select("terms").mapInArrow(count, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r.term): r.df for r in found.collect()}


class Best:
    """The k best (score, doc_id) of a query so far; equal scores by ascending doc_id, null last."""

    __slots__ = ("k", "rows", "bar")

    def __init__(self, k: int):
        self.k, self.rows, self.bar = k, [], 1  # a score must be above 0

    def add(self, score: int, doc_id: int | None) -> None:
        self.rows.append((-score, doc_id is None, doc_id or 0))
        if len(self.rows) >= self.k:
            self.rows.sort()
            del self.rows[self.k:]
            self.bar = -self.rows[-1][0]


class Block:
    """A block of queries with the weights of their terms; made once on the driver, used in tasks."""

    def __init__(self, block: list[Row], df: dict[bytes, int], n_docs: int):
        self.numbers = [row.query for row in block]
        self.place = {t: i for i, t in enumerate(sorted(df))}  # the block's terms that some document has
        of = [[t for t in map(bytes, row.terms) if t in df] for row in block]
        self.own = [np.array([self.place[t] for t in found], dtype=np.int64) for found in of]
        self.weights = [np.array([weight(n_docs, df[t]) for t in found], dtype=np.float64) for found in of]
        self.hashes = coordinates(self.place, len(self.place))
        self.vocabulary = frozenset(self.place)

    def lookup(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The coordinates of a sketch of ``width`` that are looked up, and each query's weight on them."""
        used, row = np.unique(self.hashes % width, return_inverse=True)
        table = np.zeros((len(used), len(self.numbers)), dtype=np.float32)
        for q, (own, weights) in enumerate(zip(self.own, self.weights)):
            np.add.at(table[:, q], row[own], weights.astype(np.float32))
        return used, table


class Searcher:
    """The best documents of a block's queries among those of a task."""

    def __init__(self, block: Block, n_docs: int, n_terms: int, k: int):
        self.block, self.n_docs, self.n_terms = block, n_docs, n_terms
        self.kept = [Best(k) for _ in block.numbers]
        self.bars = np.ones(len(self.kept))
        self.lookups: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.rescored = 0

    def bounds(self, sketches: np.ndarray, m: np.ndarray) -> np.ndarray:
        """No score of a document (row) for a query (column) is above its bound."""
        width = sketches.shape[1]
        if width not in self.lookups:
            self.lookups[width] = self.block.lookup(width)
        used, table = self.lookups[width]
        tf = sketches[:, used].astype(np.int64)
        top = np.where(tf >= MOST, UNIT, impact(tf, m[:, None])).astype(np.float32)
        return (top @ table) * np.float32(1.001)  # sums of floats lose less than this share

    def take(self, ids: list, n: np.ndarray, held: list[bytes], counts: list[bytes], sketches: np.ndarray) -> None:
        m = length_norm(n, self.n_docs, self.n_terms)
        bounds = self.bounds(sketches, m)
        exact = np.zeros((len(ids), len(self.block.place)))  # impacts of the terms of opened documents
        opened = np.zeros(len(ids), dtype=bool)

        def open_up(d: int) -> None:
            opened[d] = True
            known = held[d].split(b" ")
            hits = self.block.vocabulary.intersection(known)
            if hits:
                tf = dict(zip(known, np.frombuffer(counts[d], dtype="<u4").tolist()))
                exact[d, [self.block.place[t] for t in hits]] = [impact(tf[t], int(m[d])) for t in hits]

        for q in np.flatnonzero((bounds >= self.bars).any(axis=0)):
            mine, own, weights = self.kept[q], self.block.own[q], self.block.weights[q]
            chosen = np.flatnonzero(bounds[:, q] >= mine.bar)
            chosen = chosen[np.argsort(-bounds[chosen, q], kind="stable")]
            for i in range(0, len(chosen), RESCORE):
                part = chosen[i:i + RESCORE]
                if bounds[part[0], q] < mine.bar:
                    break
                for d in part[~opened[part]]:
                    open_up(int(d))
                # whole numbers below 2**53, so sums of doubles are exact
                scores = exact[np.ix_(part, own)] @ weights
                self.rescored += len(part)
                for j in np.flatnonzero(scores >= mine.bar):
                    if scores[j] >= mine.bar:
                        mine.add(int(scores[j]), ids[part[j]])
            self.bars[q] = mine.bar


def _search_block(index: DataFrame, block: list[Row], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(query, doc_id, score): at most k rows of each task and query of the block."""
    df = document_frequencies(index, frozenset(bytes(t) for row in block for t in row.terms))
    shared = index.sparkSession.sparkContext.broadcast(Block(block, df, n_docs))

    def best(batches):
        searcher = Searcher(shared.value, n_docs, n_terms, k)
        at_a_time = max(1, min(BATCH_DOCS, BATCH_CELLS // max(1, len(searcher.block.place))))
        for batch in batches:
            ids, n = batch.column("doc_id").to_pylist(), batch.column("n").to_numpy()
            held, counts, sketches = (batch.column(c).to_pylist() for c in ("terms", "counts", "sketch"))
            widths = np.array([len(s) for s in sketches])
            for width in np.unique(widths):
                same = np.flatnonzero(widths == width)
                step = max(1, min(at_a_time, (16 << 20) // int(width)))
                for i in range(0, len(same), step):
                    rows = same[i:i + step].tolist()
                    searcher.take([ids[r] for r in rows], n[rows], [held[r] for r in rows], [counts[r] for r in rows],
                                  np.stack([np.frombuffer(sketches[r], dtype=np.uint8) for r in rows]))
        rows = [(number, None if null else doc_id, -score)
                for number, mine in zip(searcher.block.numbers, searcher.kept) for score, null, doc_id in sorted(mine.rows)[:k]]
        yield pa.RecordBatch.from_pydict({name: pa.array([r[i] for r in rows], pa.int64())
                                          for i, name in enumerate(("query", "doc_id", "score"))})

    return index.mapInArrow(best, "query long, doc_id long, score long")


def search(index: DataFrame, queries: DataFrame, k: int = TOP_K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of every row of ``queries(item_id, text)``."""
    rows = query_rows(queries)
    total = index.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    found = None
    if total.docs:
        for block in blocks(rows, block_terms):
            part = materialize(_search_block(index, block, total.docs, total.terms, k), "search-block")
            found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(rows.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def search_documents(docs: DataFrame, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """:func:`search` over an index made for this one call and deleted after it."""
    index = build_index(docs)
    found = materialize(search(index, queries, k), "search")
    release(index)
    return found
