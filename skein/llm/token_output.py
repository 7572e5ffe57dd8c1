"""Operator 2: token ids as separately compressed documents with a shared dictionary.

File format (a folder): ``dictionary/`` holds one row (dict_hash, id_width, dictionary);
``blocks/`` holds one row per block of documents in ascending doc_id order: ``data`` is the
concatenation of one zstandard frame per document, ``offsets`` the byte offset of each frame,
``n_tokens`` its ids, ``doc_ids`` its documents, ``dict_hash`` the dictionary it needs. A short
document is read by its block's id range and its own offset, without its neighbours
(:func:`fetch`). Spark writes and reads the folder, so it can be in any store Spark reaches and a
lost task is simply written again.

Defined results: null and empty texts are documents of the end id alone; rows that repeat a
doc_id are all written, ordered by a hash of their text; a null doc_id comes first; an empty
table gives an empty folder of blocks. Texts are encoded whole, however long. Other columns of
``docs`` are ignored.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.bpe import by_chars, encoder
from skein.llm.common import id_and_text, range_offsets
from skein.session import default_parallelism

END_ID = 2
# The dictionary is a model fitted on a bounded sample: the documents with the smallest id hashes,
# cut into pieces, of which those with the smallest hashes are taken (16 MB at most).
SAMPLE_DOCS, PIECE_IDS, SAMPLE_PIECES, DICT_BYTES = 1024, 2048, 2048, 112 * 1024
LEVEL = 3
BLOCK_BYTES, BLOCK_DOCS = 4 << 20, 4096

_BLOCKS = ("shard int, block int, first_doc long, last_doc long, dict_hash string, start long, "
           "n_ids long, doc_ids array<long>, offsets array<long>, n_tokens array<long>, data binary")


def train_dictionary(docs: DataFrame, path: str, id_width: int = 2) -> bytes:
    """Zstandard dictionary over serialized id arrays of a bounded sample (empty for no documents)."""
    import zstandard
    rows = id_and_text(docs)
    rank = F.xxhash64(F.lit("dictionary"), "doc_id")
    chosen = (rows.select("doc_id").distinct().orderBy(rank, "doc_id").limit(SAMPLE_DOCS))
    sample = rows.join(F.broadcast(chosen), rows.doc_id.eqNullSafe(chosen.doc_id), "left_semi")

    def cut(batches):
        enc = encoder(path, True)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                ids = enc.encode([text])[0].astype(f"<u{id_width}")
                pieces = [ids[i:i + PIECE_IDS].tobytes() for i in range(0, len(ids), PIECE_IDS)]
                yield pa.RecordBatch.from_pydict({"piece": pa.array(pieces, pa.binary())})

    pieces = (sample.mapInArrow(cut, "piece binary").orderBy(F.xxhash64("piece"), "piece")
              .limit(SAMPLE_PIECES))
    samples = [bytes(r.piece) for r in pieces.collect()]  # at most SAMPLE_PIECES * PIECE_IDS ids
    size = min(DICT_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the sample itself is the dictionary
        return b"".join(samples)[:DICT_BYTES]


def write_ids(docs: DataFrame, folder: str, tokenizer: str, id_width: int = 2,
              end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id`` and write the folder described above."""
    import zstandard
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer, id_width)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    (spark.createDataFrame([(dict_hash, id_width, bytearray(dictionary))],
                           "dict_hash string, id_width int, dictionary binary")
     .coalesce(1).write.parquet(f"{folder}/dictionary"))

    def blocks(batches):
        enc = encoder(tokenizer, True)
        shared = zstandard.ZstdCompressionDict(dictionary)
        if len(dictionary):
            shared.precompute_compress(level=LEVEL)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        end = np.array([end_id], dtype=f"<u{id_width}").tobytes()
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        ids, frames, counts, size = [], [], [], 0

        def flush():
            nonlocal block, start, ids, frames, counts, size
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            known = [i for i in ids if i is not None]
            row = {"shard": [shard], "block": [block], "first_doc": [min(known, default=None)],
                   "last_doc": [max(known, default=None)], "dict_hash": [dict_hash],
                   "start": [start], "n_ids": [sum(counts)], "doc_ids": [ids],
                   "offsets": [offsets], "n_tokens": [counts], "data": [b"".join(frames)]}
            start, block = start + sum(counts), block + 1
            ids, frames, counts, size = [], [], [], 0
            return pa.RecordBatch.from_pydict(row, schema=_arrow_blocks())

        for batch in batches:
            rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()))
            for part in by_chars(rows, lambda r: r[1]):
                for (doc_id, _), tokens in zip(part, enc.encode([t for _, t in part])):
                    frame = pack.compress(tokens.astype(f"<u{id_width}").tobytes() + end)
                    ids.append(doc_id)
                    frames.append(frame)
                    counts.append(len(tokens) + 1)
                    size += len(frame)
                    if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                        yield flush()
        if ids:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("__tie")]
    n = default_parallelism(spark)
    (id_and_text(docs).withColumn("__tie", F.xxhash64("text"))
     .repartitionByRange(n, *order).sortWithinPartitions(*order)
     .select("doc_id", "text").mapInArrow(blocks, _BLOCKS)
     .write.option("compression", "uncompressed").parquet(f"{folder}/blocks"))


def _arrow_blocks() -> pa.Schema:
    many = pa.list_(pa.int64())
    return pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_doc", pa.int64()),
                      ("last_doc", pa.int64()), ("dict_hash", pa.string()), ("start", pa.int64()),
                      ("n_ids", pa.int64()), ("doc_ids", many), ("offsets", many),
                      ("n_tokens", many), ("data", pa.binary())])


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, int, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    content = bytes(row.dictionary)
    if hashlib.sha256(content).hexdigest() != row.dict_hash:
        raise ValueError(f"dictionary of {folder} is damaged")
    return row.dict_hash, row.id_width, content


def _decode(blocks: DataFrame, dict_hash: str, id_width: int, dictionary: bytes,
            only: int | None = None) -> DataFrame:
    import zstandard

    def rows(batches):
        shared = zstandard.ZstdCompressionDict(dictionary)
        unpack = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            for b in batch.to_pylist():
                if b["dict_hash"] != dict_hash:
                    raise ValueError("a block was written with another dictionary")
                out = {"shard": [], "start_in_shard": [], "doc_id": [], "n_tokens": [], "ids": []}
                at, held = b["start"], 0
                for k, doc_id in enumerate(b["doc_ids"]):
                    n = b["n_tokens"][k]
                    if only is None or doc_id == only:
                        raw = unpack.decompress(b["data"][b["offsets"][k]:b["offsets"][k + 1]])
                        ids = np.frombuffer(raw, dtype=f"<u{id_width}").astype("<u4")
                        if len(ids) != n:
                            raise ValueError(f"document {doc_id}: {len(ids)} ids, {n} expected")
                        for name, v in zip(out, (b["shard"], at, doc_id, n, ids.tobytes())):
                            out[name].append(v)
                        held += n
                    at += n
                    if held > 2_000_000:
                        yield pa.RecordBatch.from_pydict(out, schema=_arrow_docs())
                        out, held = {name: [] for name in out}, 0
                yield pa.RecordBatch.from_pydict(out, schema=_arrow_docs())

    return blocks.mapInArrow(rows, "shard int, start_in_shard long, doc_id long, n_tokens long, "
                                   "ids binary")


def _arrow_docs() -> pa.Schema:
    return pa.schema([("shard", pa.int32()), ("start_in_shard", pa.int64()), ("doc_id", pa.int64()),
                      ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids: little-endian unsigned 32-bit) of every document written."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    # one offset per shard: as many rows as the writer had partitions
    offsets = range_offsets(blocks.select("shard", "n_ids"), "shard", F.sum("n_ids"))
    docs = _decode(blocks, *_dictionary(spark, folder))
    return (docs.join(F.broadcast(offsets), "shard")
            .select("doc_id", (F.col("__offset") + F.col("start_in_shard")).alias("start"),
                    "n_tokens", "ids"))


def fetch(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """Ids of one document (a list for each row that had this doc_id): only blocks whose id range
    holds it are read, only its own frame is decompressed."""
    blocks = spark.read.parquet(f"{folder}/blocks").where(
        (F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    found = _decode(blocks, *_dictionary(spark, folder), only=doc_id).select("ids").collect()
    return [list(struct.unpack(f"<{len(r.ids) // 4}I", r.ids)) for r in found]
