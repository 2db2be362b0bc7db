"""Language of documents by a linear-chain conditional random field over their words.

A word's features are its prefixes and suffixes of up to four characters, all its two- and three-character
runs and itself (the lexicon), hashed into one weight table with a column a language; transitions
between the languages of neighbouring words are weights as well. Training rows have one language a
document; so that the chain learns what a switch looks like, training sequences are spliced from
stretches of documents of different languages. Marginals come from forward-backward; all documents of
a chunk are run side by side, in blocks of words whose transfer matrices are chained.

A document's language is the one with the largest sum of word marginals; its score is that sum's share.

Defined results: a text that is null or has no letter is `und` with score 0; rows with a null language do
not train; with one learned language every word has it; without any, every row is `und`; a word without
letters carries the chain on and adds nothing to the sums.
"""

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm import textops as T

BITS = 18
#: The most training rows of a language, taken by a hash of doc_id, and the most of their words used.
SAMPLE_ROWS, SAMPLE_WORDS = 400, 120_000
STEPS = 12  # runs of a word that are added in steps over all words; those behind them word by word
WINDOW = 64  # characters of the pieces into which training words are cut
SALTS = 64  # parts of a language from which its training rows are picked
BLOCK = 32  # words whose transfer matrices are multiplied up before documents are chained

_letters = np.full(T.END + 1, 2, np.uint8)


def _is_letter(codes: np.ndarray) -> np.ndarray:
    k = _letters[codes]
    if (k == 2).any():
        for u in np.unique(codes[k == 2]).tolist():
            _letters[u] = u < T.END and unicodedata.category(chr(u))[0] == "L"
        k = _letters[codes]
    return k.astype(bool)


def words(texts: list):
    """Code points (A-Z lower-cased), starts, ends and owners of the words, and which have a letter."""
    chunk = T.Chunk(texts)
    starts, ends = chunk.words()
    letters = np.concatenate([[0], np.cumsum(_is_letter(chunk.codes))])
    return chunk, chunk.lower(), starts, ends, chunk.owner(starts), letters[ends] > letters[starts]


def emissions(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray, each=None) -> np.ndarray:
    """The sum of a word's feature weights, a column a language. each(rows, features) is called instead of adding, if given."""
    out = None if each else np.zeros((len(starts), table.shape[1]), np.float32)
    lens = ends - starts
    up, down = T._pow(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(T._char_table()[codes] * up[: len(codes)], out=sums[1:])

    def add(rows, a, b, kind, count=None):
        h = ((sums[b] - sums[a]) * down[a]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind * 0xD6E8FEB86659FD93 & T.MASK)
        h ^= h >> np.uint64(29)
        f = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int64)
        if each:
            each(rows if count is None else np.repeat(rows, count), f)
        elif count is not None:
            out[rows] += np.add.reduceat(table[f], np.cumsum(count) - count, axis=0)
        elif rows is None:
            out[:] += table[f]
        else:
            out[rows] += table[f]

    add(None, starts, ends, 1)
    for n in (1, 2, 3, 4):
        rows = np.flatnonzero(lens >= n)
        add(rows, starts[rows], starts[rows] + n, 1 + n)
        add(rows, ends[rows] - n, ends[rows], 5 + n)
    for n in (2, 3):
        # the k-th run of all words at once, so that no row comes twice in one step
        for k in range(1, STEPS):
            rows = np.flatnonzero(lens > n + k)
            if not len(rows):
                break
            add(rows, starts[rows] + k, starts[rows] + k + n, 9 + n)
        # all further runs of the long words side by side, added up word by word: a text without blanks is one word
        rows = np.flatnonzero(lens > n + STEPS)
        if len(rows):
            count = lens[rows] - n - STEPS
            at = T.ranges(starts[rows] + STEPS, count)
            add(rows, at, at + n, 9 + n, count)
    return out


def _chain(psi: np.ndarray, trans: np.ndarray, counts: np.ndarray, both: bool = False):
    """Marginals of every word (both: and the forward vectors): psi are exp(emissions), scaled to a largest value of 1; counts: words a document, none 0."""
    n, k = psi.shape
    docs = len(counts)
    blocks = -(-counts // BLOCK)
    # words laid out in blocks of BLOCK; a place without a word passes everything on unchanged
    block_of = np.repeat(np.arange(blocks.sum()), np.minimum(BLOCK, np.repeat(counts, blocks) - BLOCK * T.ranges(np.zeros(docs, np.int64), blocks)))
    begin = np.cumsum(counts) - counts
    place = (np.arange(n) - np.repeat(begin, counts)) % BLOCK
    e = np.ones((blocks.sum(), BLOCK, k))
    there = np.zeros((blocks.sum(), BLOCK), bool)
    e[block_of, place], there[block_of, place] = psi, True
    step = np.where(there[:, :, None, None], 1.0, 0.0)
    eye = np.eye(k)

    def norm(x, axes):
        return x / np.maximum(x.sum(axes, keepdims=True), 1e-300)

    # transfer matrix of each block: from the state before it to the state of its last word
    m = np.broadcast_to(eye, (len(e), k, k)).copy()
    for j in range(BLOCK):
        on = step[:, j]
        m = norm(np.where(on > 0, (m @ trans) * e[:, j, None, :], m), (1, 2))
    first = np.cumsum(blocks) - blocks
    alpha_in, beta_out = np.full((len(e), k), 1.0 / k), np.ones((len(e), k))
    longest = int(blocks.max(initial=0))
    order = np.argsort(-blocks, kind="stable")
    alive = np.searchsorted(-blocks[order], -np.arange(longest), side="left")  # documents with more than j blocks
    for j in range(longest - 1):
        d = first[order[: alive[j + 1]]] + j
        alpha_in[d + 1] = norm(np.einsum("ij,ijk->ik", alpha_in[d], m[d]), 1)
    for j in range(longest - 2, -1, -1):
        d = first[order[: alive[j + 1]]] + j
        beta_out[d] = norm(np.einsum("ijk,ik->ij", m[d + 1], beta_out[d + 1]), 1)
    forward = np.empty_like(e)
    a = alpha_in
    for j in range(BLOCK):
        a = norm(np.where(there[:, j, None], (a @ trans) * e[:, j], a), 1)
        forward[:, j] = a
    out = np.empty_like(e)
    b = beta_out
    for j in range(BLOCK - 1, -1, -1):
        out[:, j] = norm(forward[:, j] * b, 1)
        b = norm(np.where(there[:, j, None], (e[:, j] * b) @ trans.T, b), 1)
    return (out[block_of, place], forward[block_of, place]) if both else out[block_of, place]


class Model:
    """Languages, the feature table, transition weights (log)."""

    def __init__(self, langs: list[str], table: np.ndarray, trans: np.ndarray):
        self.langs, self.table, self.trans = langs, table.astype(np.float32), trans

    def word_marginals(self, texts: list):
        """(owners, marginals, has a letter) of the words of all texts."""
        chunk, codes, starts, ends, owner, letter = words(texts)
        if not len(starts):
            return owner, np.zeros((0, len(self.langs))), letter, np.zeros(len(texts), np.int64)
        s = emissions(codes, starts, ends, self.table).astype(np.float64)
        s[~letter] = 0
        psi = np.exp(np.maximum(s - s.max(1, keepdims=True), -30))
        counts = np.bincount(owner, minlength=len(texts))
        return owner, _chain(psi, np.exp(self.trans), counts), letter, counts

    def predict(self, texts: list) -> tuple[list, np.ndarray]:
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        owner, p, letter, _ = self.word_marginals(texts)
        total = np.stack([np.bincount(owner[letter], weights=p[letter, k], minlength=len(texts)) for k in range(len(self.langs))], 1)
        mass = total.sum(1)
        best = total.argmax(1)
        score = np.where(mass > 0, total[np.arange(len(texts)), best] / np.maximum(mass, 1e-300), 0.0)
        return [self.langs[b] if m > 0 else "und" for b, m in zip(best.tolist(), mass.tolist())], np.clip(score, 0, 1)

    def label_words(self, text: str) -> list[str]:
        """The likeliest language of each word of a text."""
        return [self.langs[k] for k in self.word_marginals([text])[1].argmax(1).tolist()]


def train(rows: list, words_a_language: int = SAMPLE_WORDS, epochs: int = 4, stretch: int = 24, rate: float = 0.3, seed: int = 11) -> Model:
    """A model from (text, language) rows: gradient steps (Adagrad) on the conditional likelihood of spliced sequences."""
    langs = sorted({r[1] for r in rows})
    k = len(langs)
    table, trans = np.zeros((1 << BITS, max(k, 1)), np.float32), np.zeros((max(k, 1), max(k, 1)))
    if k < 2:
        return Model(langs, table, trans)
    rng = np.random.default_rng(seed)
    pieces = []  # (text stretch, language)
    for i, lang in enumerate(langs):
        room = words_a_language
        own = [r[0].split() for r in rows if r[1] == lang]
        for w in (own[j] for j in rng.permutation(len(own))):
            w = [x[a : a + WINDOW] for x in w for a in range(0, len(x), WINDOW)]
            w = [x for x in w if any(c.isalpha() for c in x)][: max(room, 0)]
            room -= len(w)
            pieces += [(" ".join(w[a : a + stretch]), i) for a in range(0, len(w), stretch)]
    square, square_t = np.full(1 << BITS, 1e-3, np.float32), np.full((k, k), 1e-3)
    for _ in range(epochs):
        order = rng.permutation(len(pieces))
        for a in range(0, len(order), 512):
            part = [pieces[j] for j in order[a : a + 512]]
            texts = [" ".join(p[0] for p in part[b : b + 4]) for b in range(0, len(part), 4)]
            gold = np.concatenate([np.full(p[0].count(" ") + 1, p[1]) for p in part])
            chunk, codes, starts, ends, owner, letter = words(texts)
            feats = []
            emissions(codes, starts, ends, table, lambda r, f: feats.append((np.arange(len(starts)) if r is None else r, f)))
            row, f = np.concatenate([x for x, _ in feats]), np.concatenate([x for _, x in feats])
            s = np.stack([np.bincount(row, weights=table[f, c], minlength=len(starts)) for c in range(k)], 1)
            psi = np.exp(np.maximum(s - s.max(1, keepdims=True), -30))
            p, ahead = _chain(psi, np.exp(trans), np.bincount(owner, minlength=len(texts)), True)
            g = -p
            g[np.arange(len(gold)), gold] += 1
            inner = owner[1:] == owner[:-1]
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[:-1][inner], gold[1:][inner]), 1)
            # marginals of neighbours: forward, transition, and what the later word's marginal adds to its forward vector
            pair = ahead[:-1, :, None] * np.exp(trans) * (psi[1:] * p[1:] / np.maximum(ahead[1:], 1e-300))[:, None, :]
            pair /= np.maximum(pair.sum((1, 2), keepdims=True), 1e-300)
            joint = pair[inner].sum(0)
            u, place = np.unique(f, return_inverse=True)
            grad = np.stack([np.bincount(place, weights=g[row, c], minlength=len(u)) for c in range(k)], 1) / 16 - 1e-4 * table[u]
            square[u] += (grad**2).sum(1)
            table[u] += (rate * grad / np.sqrt(square[u])[:, None]).astype(np.float32) * 0.2
            gt = (seen - joint) / inner.sum() - 1e-3 * trans
            square_t += gt**2
            trans = np.clip(trans + 0.1 * gt / np.sqrt(square_t), -4, 4)
    return Model(langs, table, trans)


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, longest: int = 100_000) -> Model:
    """Train on at most `rows` rows of each language of docs(doc_id, text, lang), and the first `longest` characters of longer ones.

    The rows are the first by a hash of doc_id, found in one pass: within salts of each language first, so that a common language is no single task's.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", F.left("text", F.lit(longest)).alias("text"))
    picked = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS)).alias("salt"))
    for by in (["lang", "salt"], ["lang"]):
        picked = picked.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("h", "doc_id"))).filter(F.col("r") <= rows)
    # `rows` rows a language
    sample = known.join(F.broadcast(picked.select("doc_id", "lang").distinct()), ["doc_id", "lang"])
    got = sorted(sample.collect(), key=lambda r: (r.lang, r.doc_id, r.text))
    return train([(r.text, r.lang) for r in got])


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns of keep, lang_pred and score of every row of docs(text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size
    schema = docs.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches):
        for batch in T.chunks(batches, 1 << 20):
            lang, s = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(lang, pa.string()), pa.array(s, pa.float64())], names=[*keep, "lang_pred", "score"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)
