"""Alignment of two tokenizers' tokens over one text's bytes, and how often their ids end together in a corpus.

Byte-owner arrays: np.repeat lays each tokenizer's token numbers over the bytes. Places where the pair of owners changes
are the overlaps, places where both change at once are the cuts; between two cuts lies a group, and the two tokens
before a cut are linked.

Of two linked tokens the shorter one's bytes end the longer one's, so the pairs that can ever be linked are fixed by the
two vocabularies (`possible_pairs`: 324,300 for the 50k and the 32k one) and do not grow with the corpus: their
counts are small enough for the driver and for a broadcast whatever the input's size. Texts are encoded once; what later steps need of them,
their linked pairs with counts, is written to the shared scratch folder and read twice.

Defined results: null and empty texts, and texts that one of the tokenizers does not give back byte for byte, have no tokens:
zeros and ''. Repeated rows give repeated results and count as often; a null id stays null; an empty table gives no rows; other columns are ignored.
"""

import functools
import hashlib

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella import session
from tessella.llm import textops as T

CHUNK = 1 << 19  # characters that are aligned side by side
MERGE = 1 << 21  # pairs that a task holds before it adds up equal ones


@functools.cache
def _pieces(path: str):
    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.cache
def _table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, sizes and bytes of a vocabulary's tokens, by id."""
    if path.endswith(".model"):
        sp = _pieces(path)
        words = [bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())]
    else:
        ranks = T.rank_table(path)
        words = [b""] * (max(ranks.values()) + 1)
        for w, i in ranks.items():
            words[i] = w
    size = np.fromiter(map(len, words), np.int64, len(words))
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(words), np.uint8)


def possible_pairs(path_a: str, path_b: str) -> int:
    """How many pairs of ids can be linked at all: the bytes of one end the bytes of the other."""
    sides = []
    for path in (path_a, path_b):
        offset, size, letters = _table(path)
        raw, known = letters.tobytes(), {}
        for o, n in zip(offset.tolist(), size.tolist()):
            known[raw[o : o + n]] = known.get(raw[o : o + n], 0) + 1
        sides.append(known)
    a, b = sides
    longer_a = sum(n * b.get(w[k:], 0) for w, n in a.items() for k in range(len(w)))
    longer_b = sum(n * a.get(w[k:], 0) for w, n in b.items() for k in range(1, len(w)))
    return longer_a + longer_b


@functools.cache
def _splits(path: str) -> bool:
    """Whether a blank is a piece and no piece holds one behind another sign: then no merge crosses the start of a run of blanks."""
    sp = _pieces(path)
    return sp.piece_to_id("▁") != sp.unk_id() and not any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.get_piece_size()))


_seen: dict = {}  # ids of blank-led words that this worker has met, by model


def _piece_ids(texts: list, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and how many each has, by a sentencepiece model, which puts a blank before each.

    Where the model splits at blanks, each distinct stretch of blanks and what follows them is encoded once.
    """
    sp = _pieces(path)
    if not _splits(path):
        found = sp.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.int64, int(counts.sum())), counts
    chunk = T.Chunk([" " + t for t in texts])
    blank = chunk.codes == 32
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    starts = np.flatnonzero(start)
    ends = np.minimum(np.append(starts[1:], len(chunk.codes) - 1), (chunk.first + chunk.lengths)[chunk.owner(starts)])
    _, place, inverse = T.distinct(chunk, starts, ends)
    words = [chunk.joined[a + 1 : b] for a, b in zip(starts[place].tolist(), ends[place].tolist())]  # without the blank that the model adds
    seen = _seen.setdefault(path, {})
    if len(seen) > T.SEEN:
        seen.clear()
    new = [w for w in words if w not in seen]
    seen.update(zip(new, sp.encode(new, num_threads=1)))
    seen[""] = [sp.piece_to_id("▁")]  # one blank at a text's end; the model adds none to an empty text
    ids = [seen[w] for w in words]
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for x in ids for i in x), np.int64, int(lens.sum()))
    each = lens[inverse]
    return flat[T.ranges((np.cumsum(lens) - lens)[inverse], each)], T.sums(each, np.bincount(chunk.owner(starts), minlength=chunk.n))


def _encode(texts: list, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and how many each has."""
    if path.endswith(".model"):
        return _piece_ids(texts, path)
    ids, counts = T.encode_chunk([" " + t for t in texts], path)
    return ids.astype(np.int64), counts


def owners(ids: np.ndarray, path: str) -> np.ndarray:
    """The number of the token that each byte belongs to."""
    return np.repeat(np.arange(len(ids), dtype=np.int32), _table(path)[1][ids])


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of A and B that share bytes, in the order of the text: the consecutive distinct pairs of owners."""
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def cut_places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The last byte of each group: both owners change behind it."""
    last = np.ones(len(a), bool)
    last[:-1] = (a[1:] != a[:-1]) & (b[1:] != b[:-1])
    return np.flatnonzero(last)


@functools.cache
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, sizes and digits of the numbers below n, each with room for a sign behind it."""
    words = [b"%d?" % i for i in range(n)]
    size = np.fromiter(map(len, words), np.int64, n)
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(words), np.uint8)


def _written(ids_a, ids_b, group_a, group_b, doc_of_group) -> tuple[bytes, np.ndarray]:
    """Groups as a1,a2|b1;a3|b2,b3, each followed by one sign, and the place behind each document's last sign; documents in the order of their groups."""
    side = np.concatenate([2 * group_a, 2 * group_b + 1])
    order = np.argsort(side, kind="stable")
    side, ids = side[order], np.concatenate([ids_a, ids_b])[order]
    offset, size, digits = _decimals(1 << int(ids.max()).bit_length())
    out, ends = digits[T.ranges(offset[ids], size[ids])], np.cumsum(size[ids])
    change = np.append(side[1:] != side[:-1], True)
    out[ends - 1] = np.where(~change, ord(","), np.where(side % 2 == 0, ord("|"), ord(";")))
    doc = doc_of_group[side // 2]
    return out.tobytes(), ends[np.append(doc[1:] != doc[:-1], True)]


def align(texts: list, path_a: str, path_b: str) -> dict:
    """Columns n_a, n_b, n_groups, n_links, n_overlaps, groups, groups_sha256, pairs and counts (the linked id pairs a << 32 | b, with how often) of each text."""
    n = len(texts)
    out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")}
    out |= {"groups": [""] * n, "groups_sha256": [""] * n, "pairs": [np.zeros(0, np.int64)] * n, "counts": [np.zeros(0, np.int64)] * n}
    texts = [t or "" for t in texts]
    want = [(" " + t).encode() for t in texts]
    sides, good = [], np.array([bool(t) for t in texts])
    for path in (path_a, path_b):
        ids, counts = _encode(texts, path)
        offset, size, letters = _table(path)
        raw, ends = letters[T.ranges(offset[ids], size[ids])].tobytes(), np.cumsum(T.sums(size[ids], counts))
        good &= [raw[a:b] == w for a, b, w in zip([0, *ends.tolist()], ends.tolist(), want)]
        sides.append((ids, counts))
    kept = np.flatnonzero(good)
    if not len(kept):
        return out
    (ids_a, n_a), (ids_b, n_b) = ((ids[np.repeat(good, counts)], np.where(good, counts, 0)) for ids, counts in sides)
    own_a, own_b = owners(ids_a, path_a), owners(ids_b, path_b)
    doc = np.repeat(np.arange(n), n_a)  # of each token of A
    at = cut_places(own_a, own_b)
    last_a, last_b = own_a[at], own_b[at]  # both end here: a link, and the end of a group
    of_link = doc[last_a]
    links = np.bincount(of_link, minlength=n)
    out |= {"n_a": n_a, "n_b": n_b, "n_groups": links, "n_links": links, "n_overlaps": np.bincount(doc[overlaps(own_a, own_b)[0]], minlength=n)}
    group_a, group_b = (np.repeat(np.arange(len(at)), np.diff(last, prepend=-1)) for last in (last_a, last_b))
    data, ends = _written(ids_a, ids_b, group_a, group_b, of_link)
    key, begin, link = ids_a[last_a] << 32 | ids_b[last_b], 0, np.cumsum(links)
    for d, end in zip(kept.tolist(), ends.tolist()):
        out["groups"][d] = data[begin : end - 1].decode()
        out["groups_sha256"][d] = hashlib.sha256(data[begin : end - 1]).hexdigest()
        out["pairs"][d], out["counts"][d] = np.unique(key[link[d] - links[d] : link[d]], return_counts=True)
        begin = end
    return out


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


def _first_pass(path_a: str, path_b: str, groups: bool):
    def run(batches):
        for batch in T.chunks(batches, CHUNK):
            found = align(batch.column("text").to_pylist(), path_a, path_b)
            columns = [batch.column("doc_id"), *(pa.array(found[c], pa.int64()) for c in NUMBERS), pa.array(found["groups_sha256"], pa.string())]
            columns += [pa.array([T.press(np.diff(x, prepend=0)) for x in found["pairs"]], pa.binary()), pa.array([T.press(x.astype(np.uint32)) for x in found["counts"]], pa.binary())]
            names = ["doc_id", *NUMBERS, "groups_sha256", "pairs", "counts"]
            if groups:
                columns, names = [*columns, pa.array(found["groups"], pa.string())], [*names, "groups"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _pairs_of(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and counts of a batch's rows in a row, and how many each row has."""
    pairs = [np.cumsum(T.unpress(x, np.int64)) for x in batch.column("pairs").to_pylist()]
    counts = [T.unpress(x, np.uint32) for x in batch.column("counts").to_pylist()]
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *pairs]), np.concatenate([empty, *counts]).astype(np.int64), np.fromiter(map(len, pairs), np.int64, len(pairs))


def _merged(pairs: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, inverse, np.concatenate(counts))
    return keys, total


def _partial_counts(batches):
    """Counts of a partition's pairs: as many rows as there are different ones."""
    pairs, counts, held = [], [], 0
    for batch in batches:
        p, c, _ = _pairs_of(batch)
        pairs.append(p)
        counts.append(c)
        held += len(p)
        if held > MERGE:
            p, c = _merged(pairs, counts)
            pairs, counts, held = [p], [c], 0
    if pairs:
        p, c = _merged(pairs, counts)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(c)], names=["pair", "n"])


def _second_pass(shared):
    def run(batches):
        keys, total, best = shared.value
        for batch in batches:
            pairs, counts, sizes = _pairs_of(batch)
            at = np.searchsorted(keys, pairs)
            sums = [pa.array(T.sums(x, sizes), pa.int64()) for x in (counts * best[at], counts * total[at])] if len(keys) else [pa.array([0] * batch.num_rows, pa.int64())] * 2
            kept = [c for c in batch.schema.names if c not in ("pairs", "counts")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *sums], names=[*kept, "n_best", "count_sum"])

    return run


def align_documents(docs: DataFrame, path_a: str, path_b: str, groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum, groups_sha256 (and groups) of every row of docs(doc_id, text).

    path_a: a rank file, which gets a blank before the text; path_b: a sentencepiece model, which adds one. A pair's count is how many
    links of the corpus hold it; n_best: links whose count is the highest of their B id; count_sum: the sum of the links' counts.
    """
    spark = docs.sparkSession
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in NUMBERS) + ", groups_sha256 string" + ", pairs binary, counts binary" + (", groups string" if groups else "")
    with session.scratch(spark):
        rows = session.cut(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_first_pass(path_a, path_b, groups), schema))
        pairs = rows.select("pairs", "counts").mapInArrow(_partial_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # at most possible_pairs() rows
        keys, total = (pairs.column(c).to_numpy().astype(np.int64) for c in ("pair", "n"))
        order = np.argsort(keys)
        keys, total = keys[order], total[order]
        b = keys & 0xFFFFFFFF
        highest = np.zeros(int(b.max()) + 1 if len(b) else 0, np.int64)
        np.maximum.at(highest, b, total)
        shared = spark.sparkContext.broadcast((keys, total, total == highest[b]))
        kept = ", ".join(c for c in schema.split(", ") if c.split()[0] not in ("pairs", "counts"))
        out = rows.mapInArrow(_second_pass(shared), f"{kept}, n_best long, count_sum long")
        return out.checkpoint(eager=True)  # digests alone; the pairs go with the scratch folder
