"""Vectorised text primitives for work inside Spark tasks.

Texts arrive in bounded chunks (see :func:`chunks`); a chunk becomes one array of code points with a
sentinel after every text, and words, pre-tokens and their 64-bit hashes are found on that array
without a Python loop over words.
"""

import base64
import ctypes
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

END = 0x110000  # the sentinel after each text; no code point has this value
MASK = (1 << 64) - 1
L, N, S, O, E = 1, 2, 3, 0, 4


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection on 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def _char_table() -> np.ndarray:
    return mix(np.arange(END + 1, dtype=np.uint64))


_BASE = 0x2545F4914F6CDD1D  # odd, so that its powers have inverses
_powers: dict = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers.get("n", 0) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers.update(n=size, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    return _powers["up"], _powers["down"]


class Chunk:
    """Code points of some texts. codes: uint32, END after each text; first[i]: where text i begins."""

    def __init__(self, texts: list):
        texts = [t or "" for t in texts]
        self.joined = "\n".join(texts) + "\n"
        self.codes = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(self.lengths + 1) - 1
        self.codes[ends] = END
        self.first = ends - self.lengths
        self.n = len(texts)

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The text that each position lies in."""
        return np.searchsorted(self.first, at, side="right") - 1

    def lower(self) -> np.ndarray:
        """The code points with A-Z lower-cased."""
        out = self.codes.copy()
        out[(out >= 65) & (out <= 90)] += 32
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words [^\\x20\\x09-\\x0D]+."""
        c = self.codes
        blank = (c == 32) | (c - np.uint32(9) <= 4) | (c == END)
        edge = np.flatnonzero(np.diff(blank, prepend=True))  # starts and ends alternate; the last code is END
        return edge[::2], edge[1::2]

    def hashes(self, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of spans: a polynomial in a random value of each code point, finalised."""
        codes = self.codes if codes is None else codes
        up, down = _pow(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_char_table()[codes] * up[: len(codes)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def pretokens(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the matches of the 50k byte-level vocabulary's split pattern.

        Runs of letters, numbers and other signs are tokens, with one blank before them; of a run of white
        space all but the last sign is a token (all of it at the text's end); English clitics stand alone.
        """
        c, k = self.codes, _classes(self.codes)
        edge = np.ones(len(c), bool)
        edge[1:] = k[1:] != k[:-1]
        start = edge.copy()
        white = k == S
        last = white[:-1] & (k[1:] != S) & (k[1:] != E)  # the last sign of a run that something follows
        start[:-1][last] = True
        start[1:][edge[1:] & ~white[1:] & (k[1:] != E) & (c[:-1] == 32)] = False
        quote = np.flatnonzero((c[:-1] == 39) & start[:-1] & (k[1:] == L))
        if len(quote):
            after, kind = np.append(c, [END, END]), np.append(k, [E, E])
            a, b = after[quote + 1], after[quote + 2]
            one = np.isin(a, [ord(x) for x in "stmd"])
            two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            for hit, size in ((one, 2), (two & ~one, 3)):
                q = quote[hit]
                start[q + 1] = False
                start[(q + size)[kind[q + size] == L]] = True
        at = np.flatnonzero(start)
        ends = np.append(at[1:], len(c))
        real = k[at] != E
        return at[real], ends[real]


_class_table = np.full(END + 1, 255, np.uint8)
_class_table[END] = E
_LETTER, _NUMBER, _SPACE = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"\s")


def _classes(codes: np.ndarray) -> np.ndarray:
    k = _class_table[codes]
    if (k == 255).any():
        for u in np.unique(codes[k == 255]).tolist():
            ch = chr(u)
            _class_table[u] = L if _LETTER.match(ch) else N if _NUMBER.match(ch) else S if _SPACE.match(ch) else O
        k = _class_table[codes]
    return k


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def release() -> None:
    """Give freed memory back to the system: Spark keeps a task's Python worker for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def chunks(batches, limit: int = 1 << 21):
    """Arrow batches cut into chunks of at most about `limit` characters of their text column (one row at least)."""
    try:
        yield from _chunks(batches, limit)
    finally:
        release()


def _chunks(batches, limit: int):
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        size[:] = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        at, total = 0, np.cumsum(size + 1)
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The concatenation of arange(s, s + n) over the pairs of starts and lens."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lens) - lens), lens)
    return np.arange(total, dtype=np.int64) + shift


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of the given sizes; empty groups give 0."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


_codec = pa.Codec("zstd", compression_level=1)


def press(array: np.ndarray) -> bytes:
    """An array's bytes, compressed, with their size before them."""
    raw = np.ascontiguousarray(array).tobytes()
    return len(raw).to_bytes(8, "little") + (_codec.compress(raw, asbytes=True) if raw else b"")


def unpress(data: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(_codec.decompress(data[8:], size, asbytes=True) if size else b"", dtype)


@functools.cache
def rank_table(path: str) -> dict:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.cache
def encoder(path: str):
    """A byte-pair encoder over a rank file, without special tokens."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=rank_table(path), special_tokens={})


def distinct(chunk: Chunk, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct spans, the first place of each, and each span's index among them."""
    h = chunk.hashes(starts, ends)
    return np.unique(h, return_index=True, return_inverse=True)


_seen: dict = {}  # ids of pre-tokens that this worker has met
SEEN = 200_000  # entries at most


def encode_words(words: list, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the given pre-tokens in a row, and how many each has."""
    one, seen = encoder(path)._core_bpe.encode_single_piece, _seen.setdefault(path, {})
    if len(seen) > SEEN:
        seen.clear()
    ids = []
    for w in words:
        x = seen.get(w)
        if x is None:
            x = seen[w] = one(w.encode("utf-8", "surrogatepass"))
        ids.append(x)
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter((x for y in ids for x in y), np.uint32, int(lens.sum())), lens


def encode_chunk(texts: list, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts in a row, and how many belong to each; each distinct pre-token is encoded once."""
    chunk = Chunk(texts)
    starts, ends = chunk.pretokens()
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(chunk.n, np.int64)
    _, place, inverse = distinct(chunk, starts, ends)
    text = chunk.joined
    flat, lens = encode_words([text[a:b] for a, b in zip(starts[place].tolist(), ends[place].tolist())], path)
    each = lens[inverse]
    counts = sums(each, np.bincount(chunk.owner(starts), minlength=chunk.n))
    return flat[ranges((np.cumsum(lens) - lens)[inverse], each)], counts
