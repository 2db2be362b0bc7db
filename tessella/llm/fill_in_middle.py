"""Fill-in-the-middle texts: each document is cut at two token borders that a hash of its id names, and its parts change places.

A token is a run of white space with the word behind it, or white space at the text's end: [\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+.
Borders are found on whole numbers with one bit a byte (the text's first byte is the highest bit): bytes.translate makes
the class mask, one shift and two boolean operations leave the bits of tokens' last bytes, bit_count counts them, and the
byte of the k-th one is found by halving the number. White space is ASCII, so bytes of UTF-8 serve as well as code points.

Defined results: a null text counts as empty; an empty text, or one that holds a marker, is plain; a null id hashes as
no digits; repeated rows give repeated results; an empty table gives no rows; other columns are ignored.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SOLID = bytes(48 if b == 32 or 9 <= b <= 13 else 49 for b in range(256))  # digits of the mask: 1 for what is no white space
LEADS = bytes(48 if 0x80 <= b < 0xC0 else 49 for b in range(256))  # 1 for the first byte of a code point


def _mask(data: bytes, digits: bytes) -> int:
    return int(data.translate(digits), 2) if data else 0


def token_ends(data: bytes) -> int:
    """The bits of the tokens' last bytes among len(data) bits."""
    solid = _mask(data, SOLID)
    ends = solid & (solid ^ (solid << 1))
    return ends | 1 if data and not solid & 1 else ends


def select(mask: int, size: int, rank: int) -> int:
    """The place, from 0 at the highest of `size` bits, of the rank-th set bit, from 1: the half that holds it is halved again."""
    at = 0
    while size > 1:
        low = size // 2
        high = mask >> low
        before = high.bit_count()
        if rank <= before:
            mask, size = high, size - low
        else:
            mask, size, rank, at = mask & ((1 << low) - 1), low, rank - before, at + size - low
    return at


def cuts(data: bytes, h1: int, h2: int) -> tuple[int, int, int]:
    """Number of tokens, and where the prefix and the middle end, in bytes."""
    mask = token_ends(data)
    n = mask.bit_count()
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = (select(mask, len(data), k) + 1 if k else 0 for k in (a, b))
    return n, first, second


def arrange(data: bytes, form: str, first: int, second: int) -> bytes:
    """The document in its form, cut at two bytes."""
    prefix, middle, suffix = data[:first], data[first:second], data[second:]
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)) if form == "spm" else data


def restore(output: bytes, form: str) -> bytes:
    """The text that arrange() made the output of; no part holds a marker, so the first of each is the one put in."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    a, rest = output[len(first) :].split(second, 1)
    b, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (b, a) if form == "spm" else (a, b)
    return prefix + middle + suffix


def transform(docs: DataFrame, rate: int = 50, suffix_first: int = 80, seed: int = 42, texts: bool = False) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 (and output, the text) of every row of docs(doc_id, text).

    rate: documents in a hundred that change; suffix_first: those of them in a hundred that begin with their suffix (spm).
    One pass without a shuffle; a document's memory is a few times its own size.
    """
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string" + (", output string" if texts else "")
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), *([pa.string()] if texts else [])]
    names = [c.split()[0] for c in schema.split(", ")]

    def one(ident, data):
        sign = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(sign[k : k + 8], 16) for k in (0, 8, 16, 24))
        n, first, second = cuts(data, h1, h2)
        plain = not data or h3 % 100 >= rate or any(m in data for m in (PREFIX, SUFFIX, MIDDLE))
        form = "plain" if plain else "spm" if h4 % 100 < suffix_first else "psm"
        output = arrange(data, form, first, second)
        sizes = (None, None) if plain else (_mask(data[:first], LEADS).bit_count(), _mask(data[first:second], LEADS).bit_count())
        row = (ident, n, form, *sizes, hashlib.sha256(output).hexdigest(), hashlib.sha256(restore(output, form)).hexdigest())
        return (*row, output.decode()) if texts else row

    def run(batches):
        for batch in batches:
            rows = [one(i, t or b"") for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)
