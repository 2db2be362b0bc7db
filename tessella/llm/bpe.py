"""Byte-level BPE over a corpus: a global shuffle of distinct pre-tokens.

Pre-tokens are exploded with their positions, each distinct one is encoded once in the whole corpus,
its ids are joined back, and documents are put together again by position. So that a frequent
pre-token costs one row per block and not one per occurrence, the explosion is block-wise: a block is
some two million characters of documents, its positions are indexes into the block's distinct
pre-tokens, and only distinct pre-tokens travel. A frequent word therefore has at most one row a
block, whatever its share of the corpus.

Defined results: a null text counts as empty (no tokens, hashes of the empty string); repeated rows
give repeated results; an empty table gives no rows; other columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella import session
from tessella.llm import textops as T

EXCHANGE = "block long, bucket int, payload binary, ids binary"
DOCS = -1  # the bucket of a block's documents
BUCKET_CHARS = 8 << 20  # of the corpus a bucket, at most


def _block(batch, n_buckets: int):
    """A chunk's distinct pre-tokens in the order of (bucket, hash), their buckets, each pre-token's index among them."""
    chunk = T.Chunk(batch.column("text").to_pylist())
    starts, ends = chunk.pretokens()
    h, place, inverse = T.distinct(chunk, starts, ends)
    bucket = (h % np.uint64(n_buckets)).astype(np.int64)
    order = np.lexsort((h, bucket))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    place = place[order]
    words = [chunk.joined[a:b] for a, b in zip(starts[place].tolist(), ends[place].tolist())]
    counts = np.bincount(chunk.owner(starts), minlength=chunk.n) if len(starts) else np.zeros(chunk.n, np.int64)
    keys = batch.column("doc_key").to_numpy(zero_copy_only=False)
    sign = xxhash.xxh64(keys.tobytes() + counts.tobytes() + h.tobytes()).intdigest() - (1 << 63)  # of the content: a recomputed task gives the same
    return sign, words, bucket[order], rank[inverse], counts, keys


def _emit(n_buckets: int, with_words: bool):
    def run(batches):
        for batch in T.chunks(batches):
            sign, words, bucket, index, counts, keys = _block(batch, n_buckets)
            out = []
            if with_words:
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(bucket)]
                for a, b in zip(cuts, cuts[1:]):
                    coded = [w.encode() for w in words[a:b]]
                    lens = np.fromiter(map(len, coded), np.uint32, len(coded))
                    out.append((sign, int(bucket[a]), T.press(lens), T.press(np.frombuffer(b"".join(coded), np.uint8))))
            else:
                out.append((sign, DOCS, T.press(index.astype(np.uint32)), T.press(np.stack([keys, counts]))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["block", "bucket", "payload", "ids"])

    return run


def _encode_bucket(path: str):
    """All blocks' distinct pre-tokens of one bucket: encode each distinct one once, answer every block."""

    def run(table):
        texts, sizes = [], []
        for lens, data in zip(table["payload"].to_pylist(), table["ids"].to_pylist()):
            lens, data = T.unpress(lens, np.uint32), T.unpress(data, np.uint8).tobytes()
            ends = np.cumsum(lens).tolist()
            texts += [data[a:b] for a, b in zip([0, *ends], ends)]
            sizes.append(len(lens))
        known = {w: i for i, w in enumerate(dict.fromkeys(texts))}
        flat, lens = T.encode_words([w.decode() for w in known], path)
        at = np.cumsum(lens) - lens
        index = np.fromiter((known[w] for w in texts), np.int64, len(texts))
        out, done = [], 0
        for n in sizes:
            i = index[done : done + n]
            done += n
            out.append((T.press(lens[i].astype(np.uint32)), T.press(flat[T.ranges(at[i], lens[i])])))
        return pa.table({"block": table["block"], "bucket": table["bucket"], "payload": pa.array([x for x, _ in out], pa.binary()), "ids": pa.array([y for _, y in out], pa.binary())})

    return run


def _token_bytes(path: str):
    """The token-byte table: offsets and bytes, by id."""
    ranks = T.rank_table(path)
    words = [b""] * (max(ranks.values()) + 1)
    for w, i in ranks.items():
        words[i] = w
    lens = np.fromiter(map(len, words), np.int64, len(words))
    return np.cumsum(lens) - lens, lens, np.frombuffer(b"".join(words), np.uint8)


def _assemble(path: str, with_ids: bool):
    def run(table):
        bucket = table["bucket"].to_numpy()
        payload, data = table["payload"].to_pylist(), table["ids"].to_pylist()
        replies = {int(b): i for i, b in enumerate(bucket) if b != DOCS}  # equal blocks get equal answers
        lens, flat = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for b in sorted(replies):
            lens.append(T.unpress(payload[replies[b]], np.uint32))
            flat.append(T.unpress(data[replies[b]], np.uint32))
        lens, flat = np.concatenate(lens).astype(np.int64), np.concatenate(flat)
        at = np.cumsum(lens) - lens
        offset, size, letters = _token_bytes(path)
        cols = {"doc_key": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []} | ({"ids": []} if with_ids else {})
        for row in np.flatnonzero(bucket == DOCS):
            index = T.unpress(payload[row], np.uint32).astype(np.int64)
            keys, counts = T.unpress(data[row], np.int64).reshape(2, -1)
            if len(index) and (not len(lens) or index.max() >= len(lens)):
                raise ValueError("a block met the answers of another one: its input rows changed between two reads")
            tokens = T.sums(lens[index], counts)
            ids = flat[T.ranges(at[index], lens[index])]
            raw = letters[T.ranges(offset[ids], size[ids])]
            n_bytes = T.sums(size[ids], tokens)
            a = b = 0
            for key, n, m in zip(keys.tolist(), tokens.tolist(), n_bytes.tolist()):
                cols["doc_key"].append(key)
                cols["n_tokens"].append(n)
                cols["ids_sha256"].append(hashlib.sha256(ids[a : a + n].astype("<u4").tobytes()).hexdigest())
                cols["decoded_sha256"].append(hashlib.sha256(raw[b : b + m].tobytes()).hexdigest())
                if with_ids:
                    cols["ids"].append(ids[a : a + n].astype(np.int32))
                a, b = a + n, b + m
        kinds = {"doc_key": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "ids": pa.list_(pa.int32())}
        return pa.table({k: pa.array(v, kinds[k]) for k, v in cols.items()})

    return run


def encode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) for every row of docs(doc_id, text).

    docs is read twice and must give the same rows in the same order both times, as a table scan does;
    cut the lineage of anything else first. A null doc_id comes back as null.
    """
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n_buckets = max(2 * session.parts(spark), -(-chars // BUCKET_CHARS))
    null_id = -(1 << 63)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(null_id)).alias("doc_key"), F.col("text"))
    words = rows.mapInArrow(_emit(n_buckets, True), EXCHANGE)
    answers = words.groupBy("bucket").applyInArrow(_encode_bucket(path), EXCHANGE)
    whole = rows.mapInArrow(_emit(n_buckets, False), EXCHANGE).unionByName(answers)
    out = whole.groupBy("block").applyInArrow(_assemble(path, with_ids), "doc_key long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else ""))
    return out.select(F.nullif("doc_key", F.lit(null_id)).alias("doc_id"), *[c for c in out.columns if c != "doc_key"])


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and the bytes that the ids of tokens(doc_id, ids array<int>) stand for; null ids: no bytes."""

    def run(batches):
        offset, size, letters = _token_bytes(path)
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                i = np.asarray(ids or [], np.int64)
                out.append(letters[T.ranges(offset[i], size[i])].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "data"])

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, data binary")
