"""Log-probabilities of documents under a smoothed n-gram model run as a backoff automaton.

States are the root and the histories of one and of two tokens that training has. A state has an arc for every token
that training saw after it, with a smoothed log-probability, to the state of the longest history that ends in that
token, and a failure arc to the state of the shorter history, with its backoff weight. With K a strength per order
and c the counts in training,

    p(w | h) = (c(h w) + K p(w | h')) / (c(h) + K),

so an unseen h w costs the failure weight K / (c(h) + K) and p(w | h'); the distribution sums to one. The
root has an arc for every token: it discounts known ones by D (from the numbers of tokens seen once and twice), gives the
sum to one unknown token and stays where it is. A document is run from left to right from the state of a document's
beginning; each token is looked up among the arcs of the state that is carried along, and failure arcs are followed
until there is one. The automaton knows no more than two tokens of the past, so a long document is run in
stretches, each from the root over the two tokens before it, all stretches of a block side by side.

Counting and scoring share one exchange, as no model of the whole corpus fits a task: documents are taken in
blocks; a block sends its distinct n-grams, as hashes (64 bits of a token, 52 of a longer n-gram), with their counts in
its training rows, to the bucket of their key; a bucket adds the counts of equal n-grams up and answers every block; the
block builds its own part of the automaton and runs its documents. A frequent n-gram has one entry a block; the number of
buckets follows the corpus's size.

Defined results: a null text is empty and consists of the end token; repeated rows count each; an empty
table gives no rows; without training rows there is only the unknown token, of probability 1; null ids
train and come back as null.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella import session
from tessella.llm import textops as T

STRENGTHS = (200.0, 5.0)  # K of histories of one token, of two
BLOCK_CHARS = 6 << 20
BUCKET_CHARS = 8 << 20  # of the corpus a bucket, at most
STRETCH = 512  # tokens run in one go
EXCHANGE = "block long, bucket int, payload binary, counts binary"
DOCS, STATS = -1, -2
_END = np.uint64(0x5851F42D4C957F2D)  # the end token's hash; a document's beginning is the same state
_NULL_ID = -(1 << 63)


def ngrams(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """53-bit keys of the pairs and triples that end at each token, in two rows; the last bit tells which. Both begin with the end token before each text; what reaches before that is 0."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first] = _END
    two = before * np.uint64(0x9E3779B97F4A7C15) + tokens * np.uint64(0xD6E8FEB86659FD93)
    third = np.empty_like(tokens)
    third[1:] = before[:-1]
    three = T.mix(third) * np.uint64(0xA0761D6478BD642F) + two
    out = np.stack([two, three])
    for k in range(2):
        out[k] = (T.mix(out[k]) >> np.uint64(12) << np.uint64(1)) | np.uint64(k)
    out[1, first] = 0
    return out


def _tokens(batch):
    """Hashes of the tokens of a chunk, an end token after each text, and how many each text has."""
    chunk = T.Chunk(batch.column("text").to_pylist())
    starts, ends = chunk.words()
    n = np.bincount(chunk.owner(starts), minlength=chunk.n) + 1 if len(starts) else np.ones(chunk.n, np.int64)
    out = np.full(int(n.sum()), _END)
    word = np.ones(len(out), bool)
    word[np.cumsum(n) - 1] = False
    out[word] = chunk.hashes(starts, ends, chunk.lower())
    keys = batch.column("doc_key").to_numpy(zero_copy_only=False)
    train = batch.column("train_").to_numpy(zero_copy_only=False)
    sign = xxhash.xxh64(keys.tobytes() + n.tobytes() + train.tobytes() + out.tobytes()).intdigest() - (1 << 63)  # of the content: a recomputed task gives the same
    return sign, out, n, keys, train


def _planes(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: the empty high bytes of small numbers cost nothing."""
    return T.press(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)


def _unplanes(data: bytes) -> np.ndarray:
    raw = T.unpress(data, np.uint8)
    return raw.reshape(8, -1).T.copy().view("<u8").ravel() if len(raw) else np.zeros(0, np.uint64)


def _batch(rows: list):
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["block", "bucket", "payload", "counts"])


def _emit_counts(n_buckets: int):
    """A block's distinct tokens, and its longer n-grams, with their training counts, a row a bucket; buckets are ranges of keys."""

    def run(batches):
        for batch in T.chunks(batches, BLOCK_CHARS):
            sign, tokens, n, _, train = _tokens(batch)
            learn = np.repeat(train, n)
            rows = []
            for values, shift, base in ((tokens[None], 32, 0), (ngrams(tokens, np.cumsum(n) - n), 21, n_buckets)):
                keys, inverse = np.unique(values, return_inverse=True)
                seen = np.bincount(inverse.reshape(len(values), -1)[:, learn].ravel(), minlength=len(keys)).astype(np.uint64)
                del inverse
                bucket = ((keys >> np.uint64(shift)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(keys)]
                rows += [(sign, base + int(bucket[a]), _planes(np.diff(keys[a:b], prepend=np.uint64(0))), _planes(seen[a:b])) for a, b in zip(cuts, cuts[1:])]
            yield _batch(rows)

    return run


def _emit_docs(batches):
    """A block's documents: the hashes and counts of its distinct tokens, and each token's rank among them by count, then hash."""
    for batch in T.chunks(batches, BLOCK_CHARS):
        sign, tokens, n, keys, train = _tokens(batch)
        words, index, times = np.unique(tokens, return_inverse=True, return_counts=True)
        rank = np.empty(len(words), "<u4")
        rank[np.argsort(-times, kind="stable")] = np.arange(len(words))
        head = _planes(np.concatenate([[len(n)], keys, n]).astype(np.int64).view(np.uint64))
        words, times = _planes(np.diff(words, prepend=np.uint64(0))), _planes(times)
        sizes = np.array([len(head), len(words), len(times)], "<i8").tobytes()
        yield _batch([(sign, DOCS, sizes + head + words + times, T.press(rank[index].view(np.uint8).reshape(-1, 4).T))])


def _read_docs(payload: bytes, data: bytes):
    """Ids, token counts and tokens of a block's documents."""
    a, b, _ = np.frombuffer(payload[:24], "<i8").tolist()
    head = _unplanes(payload[24 : 24 + a]).view(np.int64)
    docs = int(head[0])
    words, times = np.cumsum(_unplanes(payload[24 + a : 24 + a + b])), _unplanes(payload[24 + a + b :]).view(np.int64)
    rank = T.unpress(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    return head[1 : 1 + docs], head[1 + docs :], words[np.argsort(-times, kind="stable")][rank]


def _answer(n_buckets: int):
    """Corpus counts of all n-grams of a bucket, sent back to every block that has them; and a token bucket's part of the totals."""

    def run(table):
        blocks, bucket = table["block"].to_pylist(), table["bucket"][0].as_py()
        keys, seen = [], []
        for a, b in zip(table["payload"].to_pylist(), table["counts"].to_pylist()):
            keys.append(np.cumsum(_unplanes(a)))
            seen.append(_unplanes(b))
        sizes = [len(k) for k in keys]
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(seen), minlength=len(distinct)).astype(np.uint64)
        each, rows, at = total[inverse], [], 0
        for block, size in zip(blocks, sizes):
            rows.append((block, bucket, _planes(each[at : at + size]), b""))
            at += size
        if bucket < n_buckets:
            one = total[total > 0]
            rows.append((bucket, STATS, np.array([one.sum(), len(one), (one == 1).sum(), (one == 2).sum()], ">i8").tobytes(), b""))
        return pa.Table.from_batches([_batch(rows)])

    return run


class Automaton:
    """A block's part of the model: the states, arcs and failure arcs of its n-grams that training has.

    State 0 is the root, 1 + w the history of token w, 1 + V + j that of the j-th pair of tokens.
    tokens: numbers of the block's tokens in a row, `end` the end token's; pairs, triples: numbers of the n-grams
    that end at each of them (a triple of -1 is none); c1, c2, c3: their counts in training.
    """

    def __init__(self, tokens, first, pairs, triples, c1, c2, c3, end: int, totals: tuple, strengths=STRENGTHS):
        n, v, once, twice = totals
        d = once / (once + 2 * twice) if once + twice else 0.5
        d = min(max(d, 0.1), 0.9)
        k1, k2 = strengths
        self.size = size = len(c1)
        c1, c2, c3 = (c.astype(np.float64) for c in (c1, c2, c3))
        at2, at3 = np.zeros(len(c2), np.int64), np.zeros(len(c3), np.int64)
        at2[pairs] = np.arange(len(tokens))  # a place of each pair and triple
        at3[triples[triples >= 0]] = np.flatnonzero(triples >= 0)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[first] = end
        left, right = before[at2], tokens[at2]
        history, last, after = pairs[at3 - 1] if len(c3) else at3, tokens[at3], pairs[at3]
        p1 = np.where(c1 > 0, c1 - d, d * v) / n if n else np.ones(size)
        p2 = (c2 + k1 * p1[right]) / (c1[left] + k1)
        p3 = (c3 + k2 * p2[after]) / (c2[history] + k2)
        # the root's arcs, by token; those of the other states, by state and token
        self.root_to, self.root_log = np.where(c1 > 0, 1 + np.arange(size), 0), np.log10(p1)
        pair, triple = np.flatnonzero(c2 > 0), np.flatnonzero(c3 > 0)
        arc = np.concatenate([[-1], (1 + left[pair]) * size + right[pair], (1 + size + history[triple]) * size + last[triple]])
        to = 1 + size + np.concatenate([[0], pair, after[triple]])
        log = np.concatenate([[0.0], np.log10(p2[pair]), np.log10(p3[triple])])
        order = np.argsort(arc)
        self.arc, self.to, self.log = arc[order], to[order], log[order]
        self.fail = np.concatenate([np.zeros(1 + size, np.int64), 1 + right])
        self.fail_log = np.concatenate([[0.0], np.log10(k1 / (c1 + k1)), np.log10(k2 / (c2 + k2))])
        self.begin = int(self.root_to[end])

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a token each, and what it costs: failure arcs are followed up to a state that has an arc for it."""
        state, cost, open_ = state.copy(), np.zeros(len(state)), np.arange(len(state))
        while len(open_):
            s, w = state[open_], token[open_]
            key = s * self.size + w
            at = np.minimum(np.searchsorted(self.arc, key), len(self.arc) - 1)
            root, hit = s == 0, self.arc[at] == key
            cost[open_] += np.where(root, self.root_log[w], np.where(hit, self.log[at], self.fail_log[s]))
            state[open_] = np.where(root, self.root_to[w], np.where(hit, self.to[at], self.fail[s]))
            open_ = open_[~(root | hit)]
        return state, cost

    def run(self, tokens: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 probabilities of all tokens of the documents that begin at `first`."""
        stretches = -(-counts // STRETCH)
        nth = T.ranges(np.zeros(len(counts), np.int64), stretches)
        lead = np.where(nth > 0, 2, 0)  # the tokens before a stretch bring the root to the state that the document is in
        begin = np.repeat(first, stretches) + STRETCH * nth - lead
        size = np.minimum(STRETCH, np.repeat(counts, stretches) - STRETCH * nth) + lead
        order = np.argsort(-size, kind="stable")
        begin, size, lead = begin[order], size[order], lead[order]
        state = np.where(lead > 0, 0, self.begin)
        out = np.zeros(len(tokens))
        for t in range(int(size.max(initial=0))):
            on = int(np.searchsorted(-size, -t, side="left"))  # stretches of more than t tokens
            place = begin[:on] + t
            state[:on], cost = self.step(state[:on], tokens[place])
            own = t >= lead[:on]
            out[place[own]] = cost[own]
        return out


def _assemble(totals: tuple):
    n_all, v = totals[:2]

    def run(table):
        bucket = table["bucket"].to_numpy()
        payload, data = table["payload"].to_pylist(), table["counts"].to_pylist()
        answers = {int(b): i for i, b in enumerate(bucket) if b >= 0}  # equal blocks get equal answers
        counts = np.concatenate([np.zeros(0, np.uint64), *[_unplanes(payload[answers[b]]) for b in sorted(answers)]])
        cols: dict = {k: [] for k in ("doc_key", "n_tokens", "n_known", "base_score", "score")}
        for row in np.flatnonzero(bucket == DOCS):
            keys, n, tokens = _read_docs(payload[row], data[row])
            first = np.cumsum(n) - n
            words, index = np.unique(tokens, return_inverse=True)
            longer, place = np.unique(ngrams(tokens, first), return_inverse=True)
            if len(words) + len(longer) != len(counts):
                raise ValueError("a block met the answers of another one: its input rows changed between two reads")
            # numbers of the pairs and of the triples among the longer n-grams
            is_pair = (longer & np.uint64(1) == 0) & (longer > 0)
            number = np.where(is_pair, np.cumsum(is_pair), np.cumsum(~is_pair & (longer > 0))) - 1
            place = place.reshape(2, -1)
            pairs, triples = number[place[0]], np.where(longer[place[1]] > 0, number[place[1]], -1)
            c1, rest = counts[: len(words)], counts[len(words) :]
            model = Automaton(index, first, pairs, triples, c1, rest[is_pair], rest[~is_pair & (longer > 0)], int(np.searchsorted(words, _END)), totals)
            c = c1[index].astype(np.float64)
            cols["doc_key"].append(keys)
            cols["n_tokens"].append(n)
            cols["n_known"].append(np.add.reduceat((c > 0).astype(np.int64), first))
            cols["base_score"].append(np.add.reduceat(np.log10((c + 1) / (n_all + v + 1)), first))
            cols["score"].append(np.add.reduceat(model.run(index, first, n), first))
        return pa.table({k: pa.array(np.concatenate(x) if x else [], pa.float64() if "score" in k else pa.int64()) for k, x in cols.items()})

    return run


def score(docs: DataFrame, train: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of docs(doc_id, text, ...); rows where `train` holds are learned from.

    docs is read twice and must give the same rows in the same order both times, as a table scan does;
    cut the lineage of anything else first.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n_buckets = max(2 * session.parts(docs.sparkSession), -(-chars // BUCKET_CHARS))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc_key"), "text", F.coalesce(train, F.lit(True)).alias("train_"))
    sent = rows.mapInArrow(_emit_counts(n_buckets), EXCHANGE)
    answers = session.cut(sent.groupBy("bucket").applyInArrow(_answer(n_buckets), EXCHANGE))
    stats = answers.filter(F.col("bucket") == STATS).select(*[F.conv(F.hex(F.substring("payload", 8 * k + 1, 8)), 16, 10).cast("long").alias(f"s{k}") for k in range(4)])
    totals = tuple(int(x or 0) for x in stats.agg(*[F.sum(f"s{k}") for k in range(4)]).first())  # four sums
    whole = rows.mapInArrow(_emit_docs, EXCHANGE).unionByName(answers.filter(F.col("bucket") >= 0))
    out = whole.groupBy("block").applyInArrow(_assemble(totals), "doc_key long, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.nullif("doc_key", F.lit(_NULL_ID)).alias("doc_id"), "n_tokens", "n_known", F.lit(totals[0]).cast("long").alias("train_tokens"), "base_score", "score")
