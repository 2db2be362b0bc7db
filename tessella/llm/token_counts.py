"""Token counts of documents in flat token files.

A token file is nothing but ids of a fixed width, an end-of-document id after every document, and no
index. Files are split into blocks anywhere; each block finds its separators with one vectorised
comparison, and a prefix scan over the blocks' separator counts gives every separator its number in
the file, which stitches documents that cross block boundaries. The scan has two levels, blocks within
a span of blocks and spans within a file, so one huge file is no single task.

Beside a token file its writer leaves the ids of its documents in their order, from the same rows in the same task, so that
counts are given to documents by number without another look at the rows.

Defined results: an empty file has no documents; tokens behind the last separator form a document marked
closed = false; a document may be empty (n_tokens 0); a null text is written as an empty document; a token that
does not fit the width, or that is the end-of-document id itself, is an error; null ids come back as null.
"""

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tessella import session
from tessella.llm import textops as T

SEGMENTS = "file string, block long, part long, begin long, n_tokens long, closed boolean"
KEYS = "file string, doc_no long, doc_id long"
_NULL_ID = -(1 << 63)


class Block(InputPartition):
    def __init__(self, uri: str, start: int, size: int, number: int):
        self.uri, self.start, self.size, self.number = uri, start, size, number


class BlockReader(DataSourceReader):
    """Blocks of files of numbers of `width` bytes: option path, block (bytes)."""

    suffix, width = "", 1

    def __init__(self, options):
        self.path = options["path"]
        self.width = int(options.get("width", 2)) if self.suffix == ".tok" else self.width
        self.eod = int(options.get("eod", -1))
        self.block = max(1, int(options.get("block", 4 << 20)) // self.width) * self.width

    def partitions(self):
        fs, root = pafs.FileSystem.from_uri(self.path)
        files = sorted((f for f in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if f.is_file and f.path.endswith(self.suffix)), key=lambda f: f.path)
        return [Block(self.path + f.path[len(root) :], at, min(self.block, f.size - at), k) for f in files for k, at in enumerate(range(0, f.size, self.block))] or [Block("", 0, 0, 0)]

    def read(self, part):
        if part.size:
            fs, path = pafs.FileSystem.from_uri(part.uri)
            with fs.open_input_file(path) as f:
                f.seek(part.start)
                yield self.rows(part, path.rsplit("/", 1)[-1].removesuffix(self.suffix), f.read(part.size))


class SegmentReader(BlockReader):
    """Blocks of token files as segments between separators: option path, eod, width (bytes an id), block (bytes)."""

    suffix = ".tok"

    def rows(self, part, file: str, data: bytes):
        ids = np.frombuffer(data, f"<u{self.width}")
        stop = np.flatnonzero(ids == self.eod)
        begin = np.concatenate([[0], stop + 1])
        length = np.append(stop, len(ids)) - begin
        n = len(begin)
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * n), pa.array(np.full(n, part.number)), pa.array(np.arange(n)), pa.array(begin + part.start // self.width), pa.array(length), pa.array(np.arange(n) < len(stop))],
            names=["file", "block", "part", "begin", "n_tokens", "closed"],
        )


class KeyReader(BlockReader):
    """Blocks of the files of document ids, with their numbers."""

    suffix, width = ".ids", 8

    def rows(self, part, file: str, data: bytes):
        keys = np.frombuffer(data, "<i8")
        at = np.arange(len(keys)) + part.start // 8
        return pa.RecordBatch.from_arrays([pa.array([file] * len(keys)), pa.array(at), pa.array(keys, mask=keys == _NULL_ID)], names=["file", "doc_no", "doc_id"])


class Written(WriterCommitMessage):
    def __init__(self, names):
        self.names = names


class TokenWriter(DataSourceArrowWriter):
    """One flat file a task from rows with doc_id and text: option path, ranks (a rank file), eod, width (bytes an id).

    A task writes under names of its attempt; the driver gives them their final ones when the job commits.
    """

    def __init__(self, options):
        self.path, self.ranks, self.eod, self.width = options["path"], options["ranks"], int(options["eod"]), int(options.get("width", 2))

    def write(self, batches):
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        name = f"{root}/{TaskContext.get().partitionId():08d}"
        attempt = uuid.uuid4().hex
        with fs.open_output_stream(f"{name}.{attempt}.t") as f, fs.open_output_stream(f"{name}.{attempt}.i") as g:
            for batch in T.chunks(batches, 1 << 20):
                flat, counts = T.encode_chunk(batch.column("text").to_pylist(), self.ranks)
                if len(flat) and (int(flat.max()) >> (8 * self.width) or (flat == self.eod).any()):
                    raise ValueError(f"an id is too large for {self.width} bytes or the end of a document")
                whole = np.full(len(flat) + len(counts), self.eod, f"<u{self.width}")
                keep = np.ones(len(whole), bool)
                keep[np.cumsum(counts + 1) - 1] = False
                whole[keep] = flat
                f.write(whole.tobytes())
                g.write(pc.fill_null(batch.column("doc_id"), _NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        return Written([(f"{name}.{attempt}.t", f"{name}.tok"), (f"{name}.{attempt}.i", f"{name}.ids")])

    def commit(self, messages):
        fs, _ = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            for names in m.names if m else ():
                fs.move(*names)

    def abort(self, messages):
        fs, _ = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            for names in m.names if m else ():
                fs.delete_file(names[0])


class TokenFiles(DataSource):
    """format("token_files"): flat token files, read as segments or (option keys) as the ids beside them, written from rows with doc_id and text."""

    @classmethod
    def name(cls):
        return "token_files"

    def schema(self):
        return KEYS if self.options.get("keys") else SEGMENTS

    def reader(self, schema):
        return (KeyReader if self.options.get("keys") else SegmentReader)(self.options)

    def writer(self, schema, overwrite):
        return TokenWriter(self.options)


def write(docs: DataFrame, uri: str, path: str, eod: int, width: int = 2) -> None:
    """Tokenise docs(doc_id, text) by a rank file and write one flat token file a partition under uri, and the ids beside it."""
    if eod >> (8 * width):
        raise ValueError(f"{eod} is too large for {width} bytes")
    docs.sparkSession.dataSource.register(TokenFiles)
    docs.select(F.col("doc_id").cast("long"), "text").write.format("token_files").options(ranks=path, eod=eod, width=width).mode("append").save(uri)


def keys(spark: SparkSession, uri: str) -> DataFrame:
    """file, doc_no, doc_id of the documents of the token files under uri."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").options(keys="true").load(uri)


def count(spark: SparkSession, uri: str, eod: int, width: int = 2, block: int = 4 << 20, span: int = 1024) -> DataFrame:
    """file, doc_no (from 0 within the file), n_tokens, begin (id offset in the file), closed of every document."""
    spark.dataSource.register(TokenFiles)
    segments = session.cut(spark.read.format("token_files").options(eod=eod, width=width, block=block).load(uri))
    ends = segments.groupBy("file", "block").agg(F.count_if("closed").alias("n")).withColumn("span", F.floor(F.col("block") / span))
    within = Window.partitionBy("file", "span").orderBy("block")
    inner = ends.select("file", "span", "block", (F.sum("n").over(within) - F.col("n")).alias("inner"))
    spans = ends.groupBy("file", "span").agg(F.sum("n").alias("n"))
    outer = spans.select("file", "span", (F.sum("n").over(Window.partitionBy("file").orderBy("span")) - F.col("n")).alias("outer"))
    base = inner.join(outer, ["file", "span"]).select("file", "block", (F.col("inner") + F.col("outer")).alias("base"))
    numbered = segments.join(base, ["file", "block"]).withColumn("doc_no", F.col("base") + F.col("part"))
    # a document in one block is one row already; one across blocks has a row a block
    whole = numbered.groupBy("file", "doc_no").agg(F.sum("n_tokens").alias("n_tokens"), F.min("begin").alias("begin"), F.bool_or("closed").alias("closed"))
    return whole.filter("closed or n_tokens > 0")


def count_documents(docs: DataFrame, path: str, eod: int, block: int = 4 << 20, span: int = 1024) -> DataFrame:
    """doc_id, n_tokens and the place (file, doc_no, begin) of every row of docs(doc_id, text): written flat, then counted.

    A file whose documents and ids differ in number is an error.
    """
    spark = docs.sparkSession
    uri = f"{session.checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    uri = uri if ":/" in uri else f"file://{uri}"
    write(docs, uri, path, eod)
    both = keys(spark, uri).join(count(spark, uri, eod, block=block, span=span), ["file", "doc_no"], "full")
    whole = F.when(F.col("n_tokens").isNotNull() & F.col("closed"), F.col("n_tokens")).otherwise(F.raise_error(F.lit("token files and their ids differ")).cast("long"))
    out = session.cut(both.select("doc_id", whole.alias("n_tokens"), "file", "doc_no", "begin"))
    fs, root = pafs.FileSystem.from_uri(uri)
    fs.delete_dir(root)
    return out
