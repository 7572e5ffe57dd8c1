"""Operator 9: removal of passages that an earlier document has.

Every window of a fixed number of words has a Rabin-Karp hash. Spark gathers the windows by hash
bucket; a window that also starts in a document with a smaller doc_id is repeated, and the repeated
windows of a document merge into maximal intervals of words to remove. All windows are judged on
the input.

A task first settles the windows of its own rows: of equal ones only the smallest document's goes
on, so a passage that a third of all documents share reaches its bucket once per task, not once per
document. What moves is 7 bytes a window, packed by bucket. They and the bucket number come from one
64-bit hash, so together they hold at most 64 bits of it however many buckets there are, and equal
ones are taken as equal windows without comparing words: by calculation about one false match among
5 billion windows, growing with the square of their number. Whole texts move once, compressed, to
meet the windows found repeated in them.

Defined results: null and empty texts have no words; a text of fewer words than a window loses
none; rows that repeat a doc_id never remove each other's words and have the same windows removed;
a null doc_id counts as the smallest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import GOLDEN, MIX_2, WordHashes, free_shuffles, id_and_text, mix64
from skein.session import default_parallelism, materialize

WINDOW = 13
BLOCK_WORDS = 2_000_000  # words whose windows a task settles at a time
BUCKET_BYTES = 32 << 20  # text whose windows meet in one bucket, the group that a task holds
NULL_ID = -(1 << 63)
KEY = np.uint64((1 << 56) - 1)

_INVERSE = np.uint64(pow(int(GOLDEN), -1, 1 << 64))
_PACKED = pa.schema([("bucket", pa.int32()), ("settled", pa.bool_()), ("doc_ids", pa.binary()),
                     ("counts", pa.binary()), ("keys", pa.binary())])
_PACKED_DDL = "bucket int, settled boolean, doc_ids binary, counts binary, keys binary"


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def window_hashes(word_hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rabin-Karp hash mod 2**64 of every window, in order, each from the one before: running sums
    of word_hash * base**-i, whose differences are scaled back by base**i."""
    n = len(word_hashes) - window + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(len(word_hashes) + 1, dtype=np.uint64)
    np.cumsum(word_hashes * _powers(_INVERSE, len(word_hashes)), out=sums[1:])
    return mix64((sums[window:] - sums[:n]) * _powers(GOLDEN, n))


def _pack(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), dtype=np.uint8)
    out[:, :7] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def _rows(groups: np.ndarray, docs: np.ndarray, keys: np.ndarray, settled: bool):
    """One packed row per group: its documents, how many keys each has, and the keys."""
    order = np.lexsort((docs, groups))
    groups, docs, keys = groups[order], docs[order], keys[order]
    cuts = np.flatnonzero(np.diff(groups)) + 1
    out = {"bucket": [], "settled": [], "doc_ids": [], "counts": [], "keys": []}
    for a, b in zip([0, *cuts], [*cuts, len(groups)]):
        ids = docs[a:b]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1])
        out["bucket"].append(int(groups[a]))
        out["settled"].append(settled)
        out["doc_ids"].append(ids[starts].astype("<i8").tobytes())
        out["counts"].append(np.diff(np.append(starts, b - a)).astype("<u4").tobytes())
        out["keys"].append(_pack(keys[a:b]))
    return pa.RecordBatch.from_pydict(out, schema=_PACKED)


def _read(rows) -> tuple[np.ndarray, np.ndarray]:
    """(document of each key, keys) of packed rows."""
    docs, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for ids, counts, packed in zip(rows.column("doc_ids").to_pylist(), rows.column("counts").to_pylist(),
                                   rows.column("keys").to_pylist()):
        docs.append(np.repeat(np.frombuffer(ids, "<i8"), np.frombuffer(counts, "<u4")))
        keys.append(_unpack(packed))
    return np.concatenate(docs), np.concatenate(keys)


def _target(docs: np.ndarray, n: int) -> np.ndarray:
    return ((mix64(docs.astype(np.uint64)) >> np.uint64(32)) % np.uint64(n)).astype(np.int32)


def bucket_count(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets enough for the bytes of all texts, so that a bucket stays as small however large the
    input or few the shuffle partitions; at least two per shuffle partition."""
    total = id_and_text(docs).agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    return min(max(2 * default_parallelism(docs.sparkSession), -(-total // bucket_bytes)), (1 << 31) - 1)


def repeated_windows(docs: DataFrame, window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, keys): for every document, the keys of its windows that also start in a document
    with a smaller doc_id, packed; written once. A null doc_id is NULL_ID here."""
    buckets = bucket_count(docs, bucket_bytes)

    def settle(batches):
        known, held, ids, words = WordHashes(), [], [], 0

        def flush():
            hashes = np.concatenate(held)
            owner = np.repeat(np.array(ids, dtype=np.int64), [len(h) for h in held])
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            first = np.ones(len(hashes), dtype=bool)
            first[1:] = hashes[1:] != hashes[:-1]
            least = owner[first][np.cumsum(first) - 1] if len(hashes) else owner
            later = owner > least
            bucket = ((mix64(hashes * MIX_2) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            yield _rows(bucket[first], owner[first], hashes[first] & KEY, False)
            if later.any():
                own = owner[later]
                yield _rows(_target(own, buckets), own, hashes[later] & KEY, True)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").cast(pa.binary()).to_pylist()):
                found = window_hashes(known.of(text.split()), window)
                if not len(found):
                    continue
                held.append(np.unique(found))
                ids.append(NULL_ID if doc_id is None else doc_id)
                words += len(found)
                if words >= BLOCK_WORDS:
                    yield from flush()
                    held, ids, words = [], [], 0
        if held:
            yield from flush()

    def compare(rows: pa.Table) -> pa.Table:
        settled = rows.column("settled")
        parts = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        done = rows.filter(settled)
        if done.num_rows:
            owner, keys = _read(done)
            parts[0].append(owner)
            parts[1].append(keys)
        owner, keys = _read(rows.filter(pa.compute.invert(settled)))
        if len(keys):
            order = np.lexsort((owner, keys))
            owner, keys = owner[order], keys[order]
            first = np.ones(len(keys), dtype=bool)
            first[1:] = keys[1:] != keys[:-1]
            later = owner > owner[first][np.cumsum(first) - 1]
            parts[0].append(owner[later])
            parts[1].append(keys[later])
        owner, keys = np.concatenate(parts[0]), np.concatenate(parts[1])
        if not len(keys):
            return _PACKED.empty_table()
        return pa.Table.from_batches([_rows(_target(owner, buckets), owner, keys, True)])

    def gather(rows: pa.Table) -> pa.Table:
        owner, keys = _read(rows)
        order = np.argsort(owner, kind="stable")
        owner, keys = owner[order], keys[order]
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        return pa.table({"doc_id": pa.array(owner[starts], pa.int64()),
                         "keys": pa.array([_pack(k) for k in np.split(keys, starts[1:])], pa.binary())})

    import pyarrow.compute  # noqa: F401  (``pa.compute`` in the workers)
    return materialize(
        id_and_text(docs).mapInArrow(settle, _PACKED_DDL)
        .groupBy("bucket").applyInArrow(compare, _PACKED_DDL)
        .groupBy("bucket").applyInArrow(gather, "doc_id long, keys binary"), "repeats")


def remove_repeats(docs: DataFrame, window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, removed: array of word intervals, kept_text)."""
    import zstandard
    found = repeated_windows(docs, window, bucket_bytes).withColumnRenamed("doc_id", "__owner")
    free_shuffles(docs.sparkSession)

    def compress(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([pack.compress(t) for t in texts.to_pylist()], pa.binary())],
                names=["doc_id", "text"])

    def cut(batches):
        unpack, known = zstandard.ZstdDecompressor(), WordHashes()
        for batch in batches:
            out = {"doc_id": [], "n_words": [], "n_removed": [], "removed": [], "kept_text": []}
            for doc_id, packed, keys in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "keys"))):
                words, removed, intervals = unpack.decompress(packed).split(), 0, []
                n = len(words)
                if keys:
                    own = window_hashes(known.of(words), window) & KEY
                    hit = np.isin(own, _unpack(keys)).astype(np.int32)
                    edge = np.zeros(n + 1, dtype=np.int32)
                    edge[:len(hit)] += hit
                    edge[window:window + len(hit)] -= hit
                    covered = np.cumsum(edge)[:n] > 0
                    bounds = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                    intervals = [{"start": int(a), "end": int(b)} for a, b in zip(bounds[::2], bounds[1::2])]
                    removed = int(covered.sum())
                    words = [w for w, c in zip(words, covered.tolist()) if not c]
                for name, v in zip(out, (doc_id, n, removed, intervals, b" ".join(words).decode())):
                    out[name].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ("kept_text", pa.string())]))

    texts = id_and_text(docs).mapInArrow(compress, "doc_id long, text binary")
    joined = texts.join(found, F.coalesce("doc_id", F.lit(NULL_ID)) == F.col("__owner"), "left")
    return joined.select("doc_id", "text", "keys").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept_text string")
