"""Token counts by a separator scan over flat token files.

A flat file is one run of token ids; each document ends with the separator and
nothing says where. The file is read in blocks of a fixed size that take no heed of
documents. Each block is searched for separators in one vector operation; what a
document has in several blocks is stitched together by a prefix scan over the
blocks' summaries, so blocks are searched independently of each other.
"""

from __future__ import annotations

import base64
import functools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._store import materialise, own_folder

#: A file of byte-level BPE ranks; its last id, one past the ranks, is free for the separator.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SEPARATOR = 50256
# Fixed value: the pattern that goes with the ranks.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_TOKENS = 1 << 19
#: Blocks that one task reads, one after the other.
_BLOCKS_A_TASK = 16
#: Blocks whose summaries one task scans.
_GROUP = 256


@functools.lru_cache(maxsize=2)
def encoder(ranks: str, pattern: str):
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _write(folder: str, ranks: str, pattern: str, separator: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(ranks, pattern).encode_ordinary, np.array([separator], dtype=dtype).tobytes()
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        out, path, size, ordinal = None, "", 0, 0
        for batch in batches:
            if out is None:
                # a name of this attempt's own: what a failed attempt leaves is never listed
                path = f"{base}/{uuid.uuid4().hex}.tokens"
                out = store.open_output_stream(path, compression=None)
            for text in batch.column("text").to_pylist():
                tokens = np.array(encode(text or ""), dtype=dtype).tobytes() + end
                out.write(tokens)
                size += len(tokens)
            ids = batch.column("doc_id")
            yield pa.record_batch([pa.array([path], pa.string()), pa.array([None], pa.int64()), pa.array([ordinal], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64()))], names=_WRITTEN)
            ordinal += len(ids)
        if out is not None:
            out.close()
            yield pa.record_batch([pa.array([path], pa.string()), pa.array([size], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.list_(pa.int64()))], names=_WRITTEN)

    return run


_WRITTEN = ["stream", "length", "ordinal", "doc_ids"]


def write_flat_files(documents: DataFrame, folder: str, ranks: str = RANKS, pattern: str = PATTERN, separator: int = SEPARATOR, dtype: str = "uint16") -> DataFrame:
    """Tokenises ``doc_id, text`` into flat files in ``folder`` (a URI that executors reach), one for each partition.

    Rows are files (``stream``, the path, and ``length`` in bytes) or lists of documents in the
    order of the file (``stream, ordinal, doc_ids``), which only name what the
    scan finds.
    """
    pyarrow.fs.FileSystem.from_uri(folder)[0].create_dir(pyarrow.fs.FileSystem.from_uri(folder)[1], recursive=True)
    written = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_write(folder, ranks, pattern, separator, dtype), "stream string, length long, ordinal long, doc_ids array<long>")
    return materialise(written, "tokens")


def _ranges(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for stream, block, start, n in zip(*(batch.column(c).to_pylist() for c in ("stream", "block", "start", "n")), strict=True):
                with store.open_input_file(re.sub(r"^[A-Za-z0-9.+-]+:(//[^/]*)?", "", stream)) as f:
                    f.seek(start)
                    yield pa.record_batch([pa.array([stream]), pa.array([block], pa.int64()), pa.array([f.read(n)], pa.binary())], names=["stream", "block", "tokens"])

    return run


def read_blocks(files: DataFrame, folder: str, block_tokens: int = BLOCK_TOKENS, dtype: str = "uint16") -> DataFrame:
    """The files of ``stream, length`` in blocks of so many tokens: ``stream, block, tokens``.

    Only names and lengths are listed; each task reads the byte ranges of its own blocks, so files
    of any size are read in parallel and no task holds more than a block. A file that
    ends within a token fails the job.
    """
    width = np.dtype(dtype).itemsize
    size = block_tokens * width
    whole = F.when(F.col("length") % width == 0, F.col("length")).otherwise(F.raise_error(F.concat(F.lit("ends within a token: "), "stream")).cast("long"))
    files = files.select("stream", whole.alias("length")).where("length > 0")
    total = files.agg(F.sum(F.ceil(F.col("length") / size))).first()[0] or 0
    blocks = files.select("stream", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("block"))
    start = F.col("block") * size
    ranges = blocks.select("stream", "block", start.alias("start"), F.least(F.lit(size), F.col("length") - start).alias("n"))
    return ranges.repartition(max(1, -(-total // _BLOCKS_A_TASK))).mapInArrow(_ranges(folder), "stream string, block long, tokens binary")


def read_flat_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, dtype: str = "uint16") -> DataFrame:
    """Blocks of existing flat files (a path or pattern of a file system that executors reach): ``stream`` (the file's path), ``block``, ``tokens``."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("stream"), "length")  # without the content
    first = files.select("stream").first()
    folder = re.sub(r"^(\w+):/(?!/)", r"\1:///", first.stream.rsplit("/", 1)[0]) if first else "file:///"
    return read_blocks(files, folder, block_tokens, dtype)


def _search(separator: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, found, head, tail, inner = [], [], [], [], []
            for tokens in batch.column("tokens"):
                x = np.frombuffer(tokens.as_buffer(), dtype)
                at = np.flatnonzero(x == separator)
                n.append(len(x))
                found.append(len(at))
                head.append(int(at[0]) if len(at) else len(x))
                tail.append(len(x) - int(at[-1]) - 1 if len(at) else len(x))
                inner.append((np.diff(at) - 1).tolist())
            yield pa.record_batch([batch.column("stream"), batch.column("block"), pa.array(n, pa.int64()), pa.array(found, pa.int64()), pa.array(head, pa.int64()), pa.array(tail, pa.int64()), pa.array(inner, pa.list_(pa.int64()))], names=["stream", "block", "n", "found", "head", "tail", "inner"])

    return run


def scan_separators(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = "uint16") -> DataFrame:
    """The length of every document in the streams of ``blocks(stream, block, tokens)``.

    Returns ``stream, ordinal, n_tokens``; ordinals count the documents of a stream
    from 0, separators are not counted. Two separators in a row hold an empty
    document. Tokens after the last separator of a stream are a last document.
    Streams without tokens, and an empty table, give no rows.
    """
    kind = blocks.schema["stream"].dataType.simpleString()
    summary = blocks.select("stream", "block", "tokens").mapInArrow(_search(separator, dtype), f"stream {kind}, block long, n long, found long, head long, tail long, inner array<long>")
    summary = materialise(summary.withColumn("part", F.floor(F.col("block") / _GROUP)), "summary")
    # within a part: tails before each block, separators before it, and tails before the last block with a separator
    inside = Window.partitionBy("stream", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    local = summary.withColumn("t", F.coalesce(F.sum("tail").over(inside), none)).withColumn("k", F.coalesce(F.sum("found").over(inside), none))
    local = local.withColumn("m", F.max(F.when(F.col("found") > 0, F.col("t"))).over(inside))
    parts = local.groupBy("stream", "part").agg(F.sum("tail").alias("pt"), F.sum("found").alias("pk"), F.max(F.when(F.col("found") > 0, F.col("t"))).alias("pm"))
    ahead = Window.partitionBy("stream").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("t0", F.coalesce(F.sum("pt").over(ahead), none)).withColumn("k0", F.coalesce(F.sum("pk").over(ahead), none))
    parts = parts.withColumn("m0", F.max(F.col("t0") + F.col("pm")).over(ahead)).select("stream", "part", "t0", "k0", "m0")
    placed = local.join(parts, ["stream", "part"])
    carried = F.col("t0") + F.col("t") - F.greatest(F.coalesce("m0", none), F.coalesce(F.col("t0") + F.col("m"), none))
    placed = placed.select("stream", "block", "n", "found", "head", "tail", "inner", (F.col("k0") + F.col("k")).alias("before"), carried.alias("carried"))
    ended = placed.where("found > 0").select("stream", "before", F.posexplode(F.concat(F.array(F.col("carried") + F.col("head")), "inner")).alias("i", "n_tokens"))
    ended = ended.select("stream", (F.col("before") + F.col("i")).alias("ordinal"), "n_tokens")
    rest = F.when(F.col("found") > 0, F.col("tail")).otherwise(F.col("carried") + F.col("n"))
    last = placed.groupBy("stream").agg(F.max_by(F.struct((F.col("before") + F.col("found")).alias("ordinal"), rest.alias("n_tokens")), "block").alias("x")).select("stream", "x.*")
    return ended.union(last.where("n_tokens > 0"))


def token_counts(documents: DataFrame, ranks: str = RANKS, pattern: str = PATTERN, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Tokens of every document, found by writing flat token files and scanning them.

    Reads ``doc_id, text``; returns ``doc_id, n_tokens`` for every row. A null or
    empty text has 0 tokens. Repeated rows and null ids are counted row by row; an
    empty table gives an empty result; further columns are not read.
    """
    folder = own_folder(documents.sparkSession, "tokens")
    stored = write_flat_files(documents, folder, ranks, pattern, separator)
    counted = scan_separators(read_blocks(stored.where("length is not null"), folder, block_tokens), separator)
    named = stored.where("ordinal is not null").select("stream", "ordinal", F.posexplode("doc_ids").alias("i", "doc_id"))
    named = named.select("stream", (F.col("ordinal") + F.col("i")).alias("ordinal"), "doc_id")
    return named.join(counted, ["stream", "ordinal"]).select("doc_id", "n_tokens")
