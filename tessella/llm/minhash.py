"""Near-duplicates by min-max hashing: components of documents whose word-shingle sets are alike.

Each permutation gives two values of a set, its smallest and its largest, so half as many hash
evaluations fill a signature, and the two together estimate the similarity with less variance than two
smallest values would. Bands of the signature make candidates; links are confirmed on full sets.

No step pairs up the members of a group:

1. Documents with equal sets are one class (a 128-bit hash of the set); only classes go on.
2. Classes that share a band meet the smallest class of that band, its hub, and are tied to it if their sketches (four
   bits of each value) are alike enough. Up to FEW others of a band are tied to the hub as well. Where there are more (a
   passage that many documents share), those that are not all but equal to the hub are dealt anew by the rarest of their
   shingles, so many that two sets that are alike enough share one, and meet the hubs of these: a common passage alone
   ties nothing. The components of the ties are the candidate groups. A quarter of the bands is dealt in this way first; of
   the rest those whose classes are of one component already have nothing to add and are passed over.
3. Sets of candidates only are gathered (a fixed-size filter of their ids keeps the rest out of the
   shuffle). A group of up to CHUNK classes is linked exactly in one task. A larger one is dealt to chunks
   by hash, each with the same few hubs, which find most links of a large group of near copies.
4. Where a large group has not become one component, classes outside its largest component meet every chunk
   of it, block by block, so that no link is lost.

Of the pairs at the least similarity, (1 - s^ROWS)^BANDS share no band: 5e-8 at 0.8. If x is all but equal (TIGHT) to
a hub and y is like x, y is as like the hub as LOOSE asks, so leaving x out of the next deal parts no pair.

Defined results: a null or blank text has an empty set, is linked with nothing and kept; a text of fewer
words than a shingle is one shingle; repeated rows are linked; null ids count as larger than all others.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tessella import session
from tessella.llm import graph
from tessella.llm import textops as T

PERMUTATIONS, ROWS = 64, 4  # 2 * 64 values in bands of 4: 32 bands
BANDS = 2 * PERMUTATIONS // ROWS
FIRST = 8  # bands that are dealt whole
LOOSE, TIGHT = 0.55, 0.92  # estimated likeness to a hub from which on a class is tied to it, and is done with its band
FEW = 64  # classes of a band that are tied to its hub without more evidence
CHUNK, HUBS, SHINGLES = 256, 8, 400_000  # classes and shingles of a chunk, hubs of a large group
SLOT_BITS, PARTS = 22, 256  # counters of shingles (4 MB), and the parts in which they are added up
GONE = 4_000_000  # ids of rows that go, which are sent to all tasks (some 30 bytes each); beyond, rows travel to the ids that stay
FILTER_WORDS = 1 << 18  # of 64 bits: 2 MB whatever the corpus

_a = T.mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)
_b = T.mix(np.arange(1001, PERMUTATIONS + 1001, dtype=np.uint64))
_weights = T.mix(np.arange(5001, 5065, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list, width: int):
    """Sorted distinct 64-bit shingle hashes of all texts in a row, and how many each text has."""
    chunk = T.Chunk(texts)
    starts, ends = chunk.words()
    h = chunk.hashes(starts, ends, chunk.lower())
    count = np.bincount(chunk.owner(starts), minlength=chunk.n) if len(starts) else np.zeros(chunk.n, np.int64)
    first = np.cumsum(count) - count
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    at, own = T.ranges(first, n), np.repeat(np.arange(chunk.n), n)
    short = np.minimum(count, width)[own]
    padded = np.append(h, np.zeros(width, np.uint64))
    total = short.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(width):
        total += np.where(k < short, padded[at + k], np.uint64(0)) * _weights[k]
    s = T.mix(total)
    order = np.argsort(s, kind="stable")
    order = order[np.argsort(own[order].astype(np.uint16) if chunk.n < 1 << 16 else own[order], kind="stable")]
    s, own = s[order], own[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (own[1:] != own[:-1])
    return s[new], np.bincount(own[new], minlength=chunk.n)


def signature(s: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """2 * PERMUTATIONS values of each non-empty set: smallest, then largest under each permutation."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((2 * PERMUTATIONS, len(starts)), np.uint64)
    for k in range(PERMUTATIONS):
        v = s * _a[k] + _b[k]
        out[k], out[PERMUTATIONS + k] = np.minimum.reduceat(v, starts), np.maximum.reduceat(v, starts)
    return out


def node_ids(s: np.ndarray, counts: np.ndarray) -> list:
    """16 bytes for each set, the same for equal sets; None for an empty one."""
    a, b = T.sums(T.mix(s), counts), T.sums(T.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), counts)
    raw = np.stack([a, b], 1).astype(">u8").tobytes()
    return [raw[16 * i : 16 * i + 16] if n else None for i, n in enumerate(counts.tolist())]


def sketch(v: np.ndarray) -> np.ndarray:
    """Four bits of each of the 128 values of signatures, in 8 words a set."""
    bits = (T.mix(v) >> np.uint64(60)).reshape(8, 16, -1)
    return np.bitwise_or.reduce(bits << (np.arange(16, dtype=np.uint64) * np.uint64(4))[None, :, None], axis=1)


def estimate(a: str, b: str) -> Column:
    """The likeness of two sets by their sketches: equal values, less those equal by chance."""
    other = F.lit(0)
    for k in range(8):
        x = F.get(F.col(a), F.lit(k)).bitwiseXOR(F.get(F.col(b), F.lit(k)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        other = other + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return 1 - other / (2 * PERMUTATIONS) * 16 / 15


def signatures(docs: DataFrame, key: str, width: int) -> DataFrame:
    """key, node, n_shingles, bands, sketch of every row of docs(key, text)."""
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches):
        for batch in T.chunks(batches):
            s, counts = shingle_sets(batch.column("text").to_pylist(), width)
            bands = short = None
            if len(s):
                values = signature(s, counts)
                v = values.reshape(BANDS, ROWS, -1)
                keys = T.mix(np.arange(BANDS, dtype=np.uint64))[:, None]
                for r in range(ROWS):
                    keys = T.mix((keys * np.uint64(31)) ^ v[:, r])
                bands, short = keys.T.astype(np.int64), sketch(values).T.astype(np.int64)
            full = np.cumsum(counts > 0) - 1
            lists = lambda x: pa.array([x[full[i]] if n else None for i, n in enumerate(counts.tolist())], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(node_ids(s, counts), pa.binary()), pa.array(counts, pa.int64()), lists(bands), lists(short)],
                names=[key, "node", "n_shingles", "bands", "sketch"],
            )

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, node binary, n_shingles long, bands array<long>, sketch array<long>")


def _hubs(member: DataFrame) -> tuple[DataFrame, DataFrame]:
    """band, hub (its smallest node), n of the bands in which nodes of several labels meet; and band, node, hub of the others in them. member: band, node, label."""
    hubs = member.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    hubs = session.cut(hubs.select("band", "hub", "n"))
    return hubs, session.cut(graph.meet(member.select("band", "node"), hubs, "band", "n").filter("node != hub").select("band", "node", "hub"))


def _edge(df: DataFrame) -> DataFrame:
    return df.select(F.col("node").alias("a"), F.col("hub").alias("b"))


def _tie(member: DataFrame, sketches: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Ties (a, b) to the hubs of the bands of member(band, node, label); the nodes of crowded bands to be dealt anew, None if there are none."""
    hubs, met = _hubs(member)
    pairs = met.select("node", "hub").distinct().join(sketches, "node").join(sketches.select(F.col("node").alias("hub"), F.col("sketch").alias("of_hub")), "hub")
    pairs = session.cut(pairs.select("node", "hub", estimate("sketch", "of_hub").alias("alike")))
    far = session.cut(met.join(pairs.filter(F.col("alike") < LOOSE), ["node", "hub"]).select("band", "node", "hub"))
    others = session.cut(far.groupBy("band").agg(F.count("*").alias("m")))
    out = _edge(pairs.filter(F.col("alike") >= LOOSE)).unionByName(_edge(far.join(others.filter(F.col("m") <= FEW), "band")))
    crowded = others.filter(F.col("m") > FEW)
    if crowded.isEmpty():
        return out, None
    again = graph.meet(met, session.cut(crowded.join(hubs.select("band", "n"), "band")), "band", "n").select("node", "hub").distinct()
    return out, again.join(pairs.filter(F.col("alike") < TIGHT), ["node", "hub"]).select("node")


def _rarest(sets: DataFrame, least: int) -> DataFrame:
    """band, node: the rarest shingles of each of sets(node, shingles), so many that two sets alike enough have one of them in common.

    Shingles are in one order for all sets: by a count of the sets that have them, then by hash. Counts are kept in SLOTS
    counters, whatever the corpus, each task's first and then their sums; shingles that share one are taken for commoner than they
    are, which changes the order and no result. A shingle that no other set has ties nothing and is left out.
    """
    slot = lambda s: (s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def count(batches):
        seen = np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in batches:
            np.add.at(seen, slot(np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.uint64)), np.uint32(1))
        parts = np.minimum(seen, 255).astype(np.uint8).reshape(PARTS, -1)
        on = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int32()), pa.array([T.press(parts[k]) for k in on], pa.binary())], names=["part", "data"])

    def add(table):
        total = sum(T.unpress(x, np.uint8).astype(np.uint32) for x in table["data"].to_pylist())
        return pa.table({"part": table["part"][:1], "data": pa.array([T.press(np.minimum(total, 255).astype(np.uint8))], pa.binary())})

    sums = sets.select("shingles").mapInArrow(count, "part int, data binary").groupBy("part").applyInArrow(add, "part int, data binary").toArrow()  # PARTS rows, a byte a counter
    counts = np.zeros((PARTS, (1 << SLOT_BITS) // PARTS), np.uint8)
    for k, data in zip(sums["part"].to_pylist(), sums["data"].to_pylist()):
        counts[k] = T.unpress(data, np.uint8)
    shared = sets.sparkSession.sparkContext.broadcast(counts.ravel())

    def rare(batches):
        for batch in batches:
            out, own = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, data in enumerate(batch.column("shingles").to_pylist()):
                s = np.frombuffer(data, np.uint64)
                c = shared.value[slot(s)]
                first = np.lexsort((T.mix(s), c))[: len(s) - -(-least * len(s) // 100) + 1]
                out.append(s[first[c[first] > 1]])
                own.append(np.full(len(out[-1]), i))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), batch.column("node").take(pa.array(np.concatenate(own)))], names=["band", "node"])

    return sets.select("node", "shingles").mapInArrow(rare, "band long, node binary")


def ties(docs: DataFrame, key: str, width: int, least: int, classes: DataFrame) -> DataFrame:
    """Edges (a, b) whose components hold every candidate pair of classes(node, rep, n_shingles, bands, sketch).

    The first bands find most of what is alike; of the others only those in which several components meet are dealt.
    """
    sketches = classes.select("node", "sketch")
    member = lambda df, bands: df.select(F.explode(bands).alias("band"), "node", "label")
    out, again = _tie(member(classes.withColumn("label", F.col("node")), F.slice("bands", 1, FIRST)), sketches)
    known = graph.components(out)
    labelled = classes.select("node", "bands").join(known, "node", "left").withColumn("label", F.coalesce("label", "node"))
    more, rest = _tie(member(labelled, F.slice("bands", FIRST + 1, BANDS)), sketches)
    out = known.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more)
    open_ = [x for x in (again, rest) if x is not None]
    if open_:
        nodes = reduce(DataFrame.unionByName, open_).distinct()
        sets = session.cut(_sets(docs, key, width, classes.select("node", "rep").join(nodes, "node")).dropDuplicates(["node"]))
        out = out.unionByName(_edge(_hubs(_rarest(sets, least).withColumn("label", F.col("node")))[1]))
    return out


def links(nodes: list, sets: list, least: int, group: list | None = None) -> list[tuple]:
    """Edges of a forest over the classes: two are tied if 100 * common >= least * all, directly or along other ties.

    group: what is tied already; classes of one group are not compared.
    """
    m = len(nodes)
    parent = list(range(m))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    parts = m
    if group is not None:
        first: dict = {}
        for i, g in enumerate(group):
            j = first.setdefault(g, i)
            if i != j:
                parent[i] = j
                parts -= 1
    lens = np.fromiter(map(len, sets), np.int64, m)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.concatenate([[0], np.cumsum(lens)])
    mark = np.zeros(int(flat.max(initial=0)) + 1, np.int64)
    out = []
    for i in range(m - 1):
        if parts == 1:
            break
        own = flat[cuts[i] : cuts[i + 1]]
        mark[own] = 1
        common = T.sums(mark[flat[cuts[i + 1] :]], lens[i + 1 :])
        mark[own] = 0
        for j in (np.flatnonzero(100 * common >= least * (lens[i] + lens[i + 1 :] - common)) + i + 1).tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[b] = a
                parts -= 1
                out.append((nodes[j], nodes[i]))
    return out


def _link_group(least: int):
    def run(table):
        seen: dict = {}
        for node, data, label in zip(table["node"].to_pylist(), table["shingles"].to_pylist(), table["label"].to_pylist()):
            seen.setdefault(node, (data, label))
        nodes = list(seen)
        found = links(nodes, [np.frombuffer(d, np.uint64) for d, _ in seen.values()], least, [x for _, x in seen.values()]) if len(nodes) > 1 else []
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([y for _, y in found], pa.binary())})

    return run


def _sets(docs: DataFrame, key: str, width: int, wanted: DataFrame) -> DataFrame:
    """The rows of wanted(rep, node, ...) and shingles, the bytes of the node's sorted hashes, read from a document rep.

    The ids of wanted go into a bit table of fixed size, so that few other texts are cut into shingles and none
    travels; where it fills up, the join still finds the right rows. A document that occurs again gives its row again.
    """
    spark = docs.sparkSession
    h = F.xxhash64(F.col(key))
    bits = wanted.select(F.xxhash64("rep").alias("h")).select(F.pmod("h", F.lit(FILTER_WORDS)).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright("h", 40), F.lit(64)).cast("int")).alias("v"))
    table = np.zeros(FILTER_WORDS, np.int64)
    words = bits.groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()  # FILTER_WORDS rows at most
    table[words["w"].to_numpy()] = words["v"].to_numpy()
    shared = spark.sparkContext.broadcast(table)
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = batch.column("h_").to_numpy()
            on = (shared.value[x % FILTER_WORDS] >> ((x >> 40) % 64)) & 1
            batch = batch.filter(pa.array(on.astype(bool)))
            for part in T.chunks([batch]) if batch.num_rows else ():
                s, counts = shingle_sets(part.column("text").to_pylist(), width)
                raw, ends = s.tobytes(), np.cumsum(counts)
                data = [raw[8 * (e - n) : 8 * e] for n, e in zip(counts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(node_ids(s, counts), pa.binary()), pa.array(data, pa.binary())], names=["k_", "n_", "shingles"])

    rows = docs.select(key, "text", h.alias("h_")).mapInArrow(run, f"k_ {kind}, n_ binary, shingles binary")
    return rows.join(wanted, F.col("k_").eqNullSafe(F.col("rep")) & (F.col("node") == F.col("n_"))).drop("k_", "n_")


def _chunk_of(n, total):
    """The chunk of a node among as many as its group needs."""
    pieces = F.ceil(F.greatest(n / CHUNK, total / SHINGLES)).cast("int")
    return pieces, F.pmod(F.xxhash64("node"), pieces).cast("int")


def find(docs: DataFrame, key: str = "doc_id", width: int = 4, least: int = 80) -> DataFrame:
    """key, node, n_shingles, component (the smallest key reachable) of every row of docs(key, text)."""
    with session.scratch(docs.sparkSession):
        return _find(docs, key, width, least).checkpoint(eager=True)


def _find(docs: DataFrame, key: str, width: int, least: int) -> DataFrame:
    sig = session.cut(signatures(docs, key, width))
    classes = session.cut(sig.filter("node is not null").groupBy("node").agg(F.min(key).alias("rep"), F.count("*").alias("docs"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")]))
    named = session.cut(graph.components(ties(docs, key, width, least, classes)).withColumnRenamed("label", "grp").join(classes.select("node", "rep", F.col("n_shingles").alias("n")), "node"))
    size = session.cut(named.groupBy("grp").agg(F.count("*").alias("m"), F.sum("n").alias("total")))
    pieces, chunk = _chunk_of(F.col("m"), F.col("total"))
    placed = session.cut(graph.meet(named, size, "grp", "m").withColumn("pieces", pieces).withColumn("chunk", chunk).select("node", "rep", "grp", "n", "pieces", "chunk"))
    large = placed.filter("pieces > 1")
    wanted = placed.select("rep", "node", "grp", "chunk")
    crowd = not large.isEmpty()
    if crowd:
        # the hubs of a large group: its first nodes by hash, found within chunks first so that no group is sorted as one
        order = F.xxhash64("node", F.lit("hub"))
        few = large.withColumn("r", F.row_number().over(Window.partitionBy("grp", "chunk").orderBy(order))).filter(F.col("r") <= HUBS)
        hubs = few.withColumn("r", F.row_number().over(Window.partitionBy("grp").orderBy(order))).filter(F.col("r") <= HUBS)
        everywhere = hubs.withColumn("own", F.col("chunk")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).filter("chunk != own")
        wanted = wanted.unionByName(everywhere.select("rep", "node", "grp", "chunk"))
    rows = _sets(docs, key, width, wanted).withColumn("label", F.hex("node"))
    found = session.cut(rows.groupBy("grp", "chunk").applyInArrow(_link_group(least), "a binary, b binary"))
    labels = graph.components(found)
    if crowd:
        rest = _rest(docs, key, width, large, labels, least)
        if rest is not None:
            labels = graph.components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(rest))
    linked = session.cut(labels.join(classes.select("node", "rep"), "node"))
    lowest = session.cut(linked.groupBy("label").agg(F.min("rep").alias("component"), F.count("*").alias("m")))
    linked = graph.meet(linked, lowest, "label", "m").select("node", "component")
    whole = session.cut(classes.select("node", "rep", "docs").join(linked, "node", "left").select("node", "docs", F.coalesce("component", "rep").alias("component")))
    out = graph.meet(sig.filter("node is not null").select(key, "node", "n_shingles"), whole, "node", "docs").select(key, "node", "n_shingles", "component")
    return out.unionByName(sig.filter("node is null").select(key, "node", "n_shingles", F.col(key).alias("component")))


def _rest(docs: DataFrame, key: str, width: int, large: DataFrame, labels: DataFrame, least: int) -> DataFrame | None:
    """Links in large groups between what is outside the largest component and everything else; None if there is nothing to compare."""
    now = session.cut(large.select("node", "rep", "grp", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    by = now.groupBy("grp", "label").agg(F.count("*").alias("m"))
    top = session.cut(by.groupBy("grp").agg(F.max_by("label", F.struct("m", "label")).alias("main"), F.count("*").alias("parts"), F.sum("m").alias("rows")).filter("parts > 1"))
    if top.isEmpty():
        return None
    side = session.cut(graph.meet(now, top, "grp", "rows").withColumn("main", F.col("label") == F.col("main")).drop("rows"))
    size = side.groupBy("grp").agg(
        F.count("*").alias("rows"),
        F.count_if("main").alias("gm"), F.sum(F.when(F.col("main"), F.col("n")).otherwise(0)).alias("gt"),
        F.count_if(~F.col("main")).alias("rm"), F.sum(F.when(F.col("main"), 0).otherwise(F.col("n"))).alias("rt"),
    )
    side = graph.meet(side, session.cut(size), "grp", "rows")
    gp, gc = _chunk_of(F.col("gm"), F.col("gt"))
    rp, rc = _chunk_of(F.col("rm"), F.col("rt"))
    side = side.withColumn("gp", gp).withColumn("rp", rp).withColumn("c", F.when(F.col("main"), gc).otherwise(rc))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    c = F.col("c")
    # a block is (a chunk of the rest, a chunk of the main component) or two chunks of the rest
    of_main = F.transform(upto(F.col("rp")), lambda i: F.struct(i.alias("i"), c.alias("j"), F.lit(True).alias("m")))
    of_rest = F.concat(
        F.transform(upto(F.col("gp")), lambda j: F.struct(c.alias("i"), j.alias("j"), F.lit(True).alias("m"))),
        F.transform(upto(F.col("rp")), lambda j: F.struct(F.least(c, j).alias("i"), F.greatest(c, j).alias("j"), F.lit(False).alias("m"))),
    )
    side = session.cut(side.select("rep", "node", "grp", F.hex("label").alias("label"), F.when(F.col("main"), of_main).otherwise(of_rest).alias("blocks")))
    rows = _sets(docs, key, width, side).select("grp", "node", "shingles", "label", F.inline("blocks"))
    return session.cut(rows.groupBy("grp", "i", "j", "m").applyInArrow(_link_group(least), "a binary, b binary"))


def keep(docs: DataFrame, width: int = 5, least: int = 80) -> DataFrame:
    """One row of each component of docs(doc_id, text, ...), whole: the one of the smallest doc_id; equal rows of it once.

    A row without an id represents nothing: it stays, once a text, if no row with an id is linked to it.
    """
    id_, node_ = session.fresh(docs, "id_"), session.fresh(docs, "node_")
    found = find(docs, "doc_id", width, least)
    sets = session.cut(found.groupBy(F.col("doc_id").alias(id_), F.col("node").alias("set")).agg(F.count("*").alias("rows"), F.first(F.expr("doc_id <=> component")).alias("good")))
    ids = session.cut(sets.groupBy(id_).agg(F.bool_or("good").alias("good"), F.sum("rows").alias("rows")))
    same = F.col("doc_id").eqNullSafe(F.col(id_))
    gone, again = ids.filter("not good or rows > 1").select(id_), ids.filter("good and rows > 1").select(id_)
    if few := gone.limit(GONE + 1).count() <= GONE:  # texts stay where they are
        out = docs.join(F.broadcast(gone), same, "left_anti")
    else:
        out = docs.join(ids.filter("good and rows = 1").select(id_), same, "left_semi")
    if again.isEmpty():
        return out
    # several rows under one id, or without any: their sets tell which texts stay, each once
    some = _with_nodes(docs.join(F.broadcast(again) if few else again, same, "left_semi"), width, node_)
    stay = sets.filter("good").select(id_, F.col("set").alias(session.fresh(docs, "set_")))
    some = some.join(stay, same & F.col(node_).eqNullSafe(stay[stay.columns[1]]), "left_semi").drop(node_)
    return out.unionByName(some.dropDuplicates(["doc_id", "text"]))


def _with_nodes(docs: DataFrame, width: int, name: str) -> DataFrame:
    """docs and a column of the given name, the id of a row's set."""

    def run(batches):
        for batch in T.chunks(batches):
            s, counts = shingle_sets(batch.column("text").to_pylist(), width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node_ids(s, counts), pa.binary())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, BinaryType())]))
