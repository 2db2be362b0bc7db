"""Toxicity by a support vector machine over a gapped-subsequence string kernel with Nystrom landmarks.

The kernel of two words is the inner product of their subsequences of three characters (ends of the
word included as characters), each weighted by a decay per skipped character, over at most two skipped
characters at each of the two places; it is divided by both words' norms. So an insult with characters
put in ("id-iot", "i.d.i.o.t") or with another ending keeps most of its subsequences. Landmarks are
words of the training rows; the kernel's values at the landmarks, whitened by the landmarks' own kernel
matrix, are the features of a linear SVM with squared hinge loss, trained by Newton steps.

Labels belong to documents, but only some words of a toxic document offend. Training words are therefore
picked as in multiple-instance learning: words with a run of characters that many toxic documents and all
but no clean ones have are the positive examples, words of clean documents the negative ones. After a fit,
clean words that the machine takes for offending join the negative examples, and it is fitted again.

A document's score is a logistic function, fitted on the training rows, of its three highest word scores.
A linear machine over Nystrom features is a weighted sum of kernels at landmarks, hence one weight per
subsequence before the norm: words are scored by table look-ups, for whole texts at once.

Defined results: a text that is null or has no word scores as the least toxic text; rows without a label
do not train; without both labels in the training rows every score is 0; repeated rows train once each.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm import textops as T

DECAY, GAP, BITS, LONGEST = 0.6, 2, 20, 24
#: The most labelled rows that train, taken by a hash of doc_id from both classes, and the most of their characters per class.
SAMPLE_ROWS, SAMPLE_CHARS = 6000, 10_000_000
LANDMARKS = 512
TOP, LOW = 3, -1.0  # the word scores of a document that count, and the least value of one
ODDS = 0.02  # what runs of characters have in clean documents against toxic ones, at most, to count as offending
COVER = 3  # offending runs looked for in a toxic document
SLICE = 20_000  # words whose subsequences are laid out at once
CHARS = 1 << 19  # characters of the texts that are scored at once
RIDGE, NEG = 0.05, 2.0  # of the machine: its ridge, and what a clean word weighs against an offending one


def units(texts: list) -> tuple[T.Chunk, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts, lower-cased; a run of single-character words ("i d i o t") also counts as one word.

    Returns code points, starts, ends and owners. Longer words than LONGEST are seen in overlapping windows.
    """
    chunk = T.Chunk(texts)
    codes = chunk.lower()
    starts, ends = chunk.words()
    owner = chunk.owner(starts)
    single = (ends - starts) == 1
    if single.any():
        same = np.zeros(len(starts), bool)
        same[1:] = single[1:] & single[:-1] & (owner[1:] == owner[:-1])
        group = np.cumsum(~same)
        first = np.flatnonzero(np.diff(group, prepend=-1))
        size = np.diff(np.append(first, len(starts)))
        run = first[(size > 2) & single[first]]
        last = run + size[(size > 2) & single[first]] - 1
        if len(run):
            starts, ends, owner = np.append(starts, starts[run]), np.append(ends, ends[last]), np.append(owner, owner[run])
    long = ends - starts > LONGEST
    if long.any():
        size = ends[long] - starts[long]
        n = -(-size // (LONGEST // 2))
        more = np.repeat(starts[long], n) + T.ranges(np.zeros(len(n), np.int64), n) * (LONGEST // 2)
        to = np.minimum(more + LONGEST, np.repeat(ends[long], n))
        starts, ends, owner = np.append(starts[~long], more), np.append(ends[~long], to), np.append(owner[~long], np.repeat(owner[long], n))
    return chunk, codes, starts, ends, owner


def subsequences(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(word, feature, weight) of every gapped three-character subsequence of the spans; blanks inside a span are left out."""
    lens = ends - starts + 2
    at = T.ranges(starts - 1, lens)
    first = np.cumsum(lens) - lens
    chars = codes[np.maximum(at, 0)].astype(np.uint64)
    chars[first], chars[first + lens - 1] = T.END + 1, T.END + 2  # the word's ends
    word = np.repeat(np.arange(len(starts)), lens)
    solid = ~((chars == 32) | (chars - np.uint64(9) <= 4) | (chars == T.END))
    chars, word = chars[solid], word[solid]
    h = (chars * np.uint64(0x9E3779B97F4A7C15)) ^ (chars >> np.uint64(3))
    words, feats, weights = [], [], []
    n = len(chars)
    for a in range(1, GAP + 2):
        for b in range(1, GAP + 2):
            if n <= a + b:
                continue
            i = np.flatnonzero(word[: n - a - b] == word[a + b :])
            f = (h[i] * np.uint64(3) + h[i + a]) * np.uint64(0xD6E8FEB86659FD93) + h[i + a + b] * np.uint64(0xA0761D6478BD642F)
            words.append(word[i])
            feats.append((f >> np.uint64(64 - BITS)).astype(np.int64))
            weights.append(np.full(len(i), DECAY ** (a + b - 2)))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(words), np.concatenate(feats), np.concatenate(weights)


def vectors(word, feat, weight, n: int):
    """Sparse unit vectors: (word, feature, value) with a word's equal features added up and its norm 1."""
    key, inverse = np.unique(word * (1 << BITS) + feat, return_inverse=True)
    value = np.bincount(inverse, weights=weight, minlength=len(key))
    word, feat = key >> BITS, key & ((1 << BITS) - 1)
    norm = np.sqrt(np.bincount(word, weights=value * value, minlength=n))
    return word, feat, value / norm[word]


def word_vectors(words: list):
    chunk = T.Chunk(words)
    ends = chunk.first + chunk.lengths
    keep = np.minimum(ends, chunk.first + LONGEST)
    return vectors(*subsequences(chunk.lower(), chunk.first, keep), len(words))


def _kernel(left, n: int, right, m: int) -> np.ndarray:
    """Kernel matrix of two lists of sparse unit vectors; only features of the right list can count."""
    feats, place = np.unique(right[1], return_inverse=True)
    dense = np.zeros((len(feats) + 1, m), np.float32)
    dense[place, right[0]] = right[2]
    at = np.searchsorted(feats, left[1])
    at[(at >= len(feats)) | (feats[np.minimum(at, len(feats) - 1)] != left[1])] = len(feats)
    out = np.zeros((n, m))
    cuts = np.searchsorted(left[0], np.arange(n + 1))
    for i in range(n):
        a, b = cuts[i], cuts[i + 1]
        out[i] = left[2][a:b] @ dense[at[a:b]]
    return out


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """A linear SVM with squared hinge loss and a bias column, by Newton steps over the rows inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    inside = np.ones(len(x), bool)
    for _ in range(30):
        z = x[inside] * weight[inside][:, None]
        w = np.linalg.solve(penalty + z.T @ x[inside], z.T @ y[inside])
        now = y * (x @ w) < 1
        if (now == inside).all():
            break
        inside = now
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and offset of a logistic curve over the columns of x through 0/1 labels, by Newton steps with a small ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - 0.1 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(h, g), -2, 2)
    return w[:-1], float(w[-1])


class Model:
    """table: a weight per subsequence; bias; the curve from word scores to document scores."""

    def __init__(self, table: np.ndarray, bias: float, slope=None, offset: float = 0.0, empty: bool = False):
        self.table, self.bias, self.slope, self.offset, self.empty = table.astype(np.float32), bias, slope, offset, empty

    def word_scores(self, codes, starts, ends) -> np.ndarray:
        """The machine's value of each span: its weighted subsequences over its norm, plus the bias."""
        n = len(starts)
        word, feat, weight = subsequences(codes, starts, ends)
        raw = np.bincount(word, weights=self.table[feat] * weight, minlength=n)
        # the norm is at least that of distinct subsequences; only words that could pass half the margin need it exactly
        low = np.sqrt(np.maximum(np.bincount(word, weights=weight * weight, minlength=n), 1e-12))
        out = raw / low
        close = np.flatnonzero(out + self.bias > -0.5)
        if len(close):
            pick = np.zeros(n, bool)
            pick[close] = True
            on = pick[word]
            w, f, v = vectors(word[on], feat[on], weight[on], n)
            out[close] = np.bincount(w, weights=self.table[f] * v, minlength=n)[close]
        return np.maximum(out + self.bias, LOW)

    def margins(self, texts: list) -> np.ndarray:
        """The TOP highest scores of different words of each text, LOW where there are fewer; each distinct word of the chunk is scored once."""
        chunk, codes, starts, ends, owner = units(texts)
        out = np.full((len(texts), TOP), LOW)
        if len(starts):
            h = chunk.hashes(starts, ends, codes)
            _, place, inverse = np.unique(h, return_index=True, return_inverse=True)
            s, e = starts[place], ends[place]
            score = np.concatenate([self.word_scores(codes, s[a : a + SLICE], e[a : a + SLICE]) for a in range(0, len(s), SLICE)])
            near = np.flatnonzero(score[inverse] > LOW)
            key = np.unique(owner[near] * len(place) + inverse[near])
            text, value = key // len(place), score[key % len(place)]
            order = np.lexsort((-value, text))
            text, value = text[order], value[order]
            rank = np.arange(len(text)) - np.searchsorted(text, text)
            out[text[rank < TOP], rank[rank < TOP]] = value[rank < TOP]
        return out

    def scores(self, texts: list) -> np.ndarray:
        if self.empty:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.margins(texts) @ self.slope + self.offset, -30, 30)))


def _vocabulary(texts: list) -> tuple[list[str], list[np.ndarray]]:
    """The distinct words of all texts, and for each text the numbers of its distinct words."""
    number: dict[str, int] = {}
    lists = []
    for start in range(0, len(texts), 256):
        part = texts[start : start + 256]
        _, codes, starts, ends, owner = units(part)
        codes[codes == T.END] = 10
        text = codes.tobytes().decode("utf-32-le", "surrogatepass")
        own: list[set] = [set() for _ in part]
        for a, b, o in zip(starts.tolist(), ends.tolist(), owner.tolist()):
            w = text[a:b]
            own[o].add(number.setdefault(w if b - a < 3 else "".join(w.split()), len(number)))
        lists += [np.fromiter(sorted(x), np.int64, len(x)) for x in own]
    return list(number), lists


def _evidence(words: list[str], c0: np.ndarray, c1: np.ndarray, lists: list, y: np.ndarray) -> np.ndarray:
    """For each word the most toxic documents that share a run of four to six characters, or the word, which clean ones all but lack."""
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    parts = lambda w: {w, *(w[k : k + n] for n in (4, 5, 6) for k in range(len(w) - n + 1))}
    where: dict[int, list] = {}
    for d in np.flatnonzero(y == 1).tolist():
        for i in lists[d].tolist():
            where.setdefault(i, []).append(d)
    bounded = {i: f"^{words[i][:LONGEST]}$" for i in where}
    least = max(3, int(0.01 * n1))
    # a run has at most as many documents as its words have in sum; only runs that could pass get a set of documents
    most: dict[str, int] = {}
    for i, w in bounded.items():
        for g in parts(w):
            most[g] = most.get(g, 0) + len(where[i])
    most = {g: n for g, n in most.items() if n >= least}
    clean: dict[str, int] = dict.fromkeys(most, 0)
    for i in np.flatnonzero(c0).tolist():
        for g in parts(f"^{words[i][:LONGEST]}$"):
            if g in clean:
                clean[g] += int(c0[i])
    runs: dict[str, set] = {g: set() for g, n in most.items() if clean[g] * n1 <= ODDS * n * n0}
    for i, w in bounded.items():
        for g in parts(w):
            if g in runs:
                runs[g].update(where[i])
    rare = {g: x for g, x in runs.items() if len(x) >= least and clean[g] * n1 <= ODDS * len(x) * n0}
    # copies of one toxic document share all their words; so a run counts for documents only that are not explained COVER times yet
    open_ = np.full(len(lists), COVER)
    heap = [(-len(x), len(g), g) for g, x in rare.items()]
    heapq.heapify(heap)
    chosen: dict[str, int] = {}
    while heap:
        known, size, g = heapq.heappop(heap)
        now = sum(open_[d] > 0 for d in rare[g])
        if now < least:
            continue
        if now < -known:
            heapq.heappush(heap, (-now, size, g))
            continue
        chosen[g] = now
        for d in rare[g]:
            open_[d] -= 1
    out = np.zeros(len(words))
    for i, w in bounded.items():
        out[i] = max(chosen.get(g, 0) for g in parts(w))
    return out


def train(rows: list, landmarks: int = LANDMARKS, seed: int = 7) -> Model:
    """A model from (text, label) rows."""
    y = np.array([int(r[1]) for r in rows])
    none = Model(np.zeros(1 << BITS), 0.0, empty=True)
    if not len(y) or y.min() == y.max():
        return none
    words, lists = _vocabulary([r[0] for r in rows])
    if not words:
        return none
    rng = np.random.default_rng(seed)
    count = lambda k: np.bincount(np.concatenate([np.zeros(0, np.int64), *[x for x, l in zip(lists, y) if l == k]]), minlength=len(words))
    c0, c1 = count(0), count(1)
    evidence = _evidence(words, c0, c1, lists, y)
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    offending = (evidence > 0) & (c0 * n1 <= ODDS * np.maximum(c1, evidence) * n0)
    positive = np.flatnonzero(offending)
    positive = positive[np.lexsort((positive, -c1[positive], -evidence[positive]))][: 8 * landmarks]
    clean = np.flatnonzero((c0 > 0) & ~offending)
    negative = np.union1d(clean[np.argsort(-c0[clean], kind="stable")[:2000]], rng.permutation(clean)[:4000])
    if not len(positive) or not len(negative):
        return none
    model, hard = none, np.zeros(0, np.int64)
    for _ in range(3):
        examples = np.concatenate([positive, negative])
        label = np.repeat([1.0, -1.0], [len(positive), len(negative)])
        # half of the landmarks are offending words, first the commonest; the others clean words, first those taken for offending
        other = np.concatenate([hard[: landmarks // 4], rng.permutation(negative)])
        marks = np.concatenate([positive[: landmarks // 2], other[: landmarks // 2]])
        m = word_vectors([words[i] for i in marks])
        value, vector = np.linalg.eigh(_kernel(m, len(marks), m, len(marks)) + 1e-3 * np.eye(len(marks)))
        white = vector / np.sqrt(np.maximum(value, 1e-6))
        x = _kernel(word_vectors([words[i] for i in examples]), len(examples), m, len(marks)) @ white
        w = svm(x, label, np.where(label > 0, len(label) / len(positive), NEG * len(label) / len(negative)), RIDGE)
        model = Model(np.bincount(m[1], weights=m[2] * (white @ w[:-1])[m[0]], minlength=1 << BITS), float(w[-1]))
        score = np.zeros(len(words))
        for a in range(0, len(words), 20_000):
            chunk = T.Chunk(words[a : a + 20_000])
            score[a : a + 20_000] = model.word_scores(chunk.lower(), chunk.first, chunk.first + np.minimum(chunk.lengths, LONGEST))
        # clean words that the machine takes for offending become examples
        hard = clean[score[clean] > -0.7]
        hard = hard[np.argsort(-score[hard], kind="stable")[:6000]]
        negative = np.union1d(negative, hard)
    best = np.full((len(lists), TOP), LOW)
    for i, x in enumerate(lists):
        top = np.sort(score[x])[::-1][:TOP]
        best[i, : len(top)] = np.maximum(top, LOW)
    model.slope, model.offset = logistic(best, y.astype(float))
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, longest: int = 100_000) -> Model:
    """Train on at most `rows` labelled rows of docs(doc_id, text) and labels(doc_id, toxic), half of each class where there are so many, and the first `longest` characters of longer ones."""
    marked = labels.filter("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    pick = F.xxhash64("doc_id")
    # the ids are chosen before any text is read
    ids = [marked.filter(f"toxic = {k}").select("doc_id", "toxic").orderBy(pick, "doc_id").limit(rows // 2) for k in (0, 1)]
    sample = docs.select("doc_id", F.left("text", F.lit(longest)).alias("text"), pick.alias("h")).filter("text is not null").join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id")
    got, used = [], [0, 0]
    for r in sorted(sample.collect(), key=lambda r: (r.h, str(r.doc_id), r.text)):
        if used[r.toxic] < chars:
            used[r.toxic] += len(r.text)
            got.append((r.text, r.toxic))
    return train(got)


def score(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """The columns of keep and score (0 to 1, under the given name) of every row of docs(text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size
    schema = docs.select(*keep, F.lit(0.0).alias(name)).schema

    def run(batches):
        for batch in T.chunks(batches, CHARS):
            s = shared.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(s, pa.float64())], names=[*keep, name])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)
