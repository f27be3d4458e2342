"""Token counts of flat, unindexed token files by a separator scan.

A token file is nothing but ids of a fixed width, documents one after the other, each ended by an
end-of-document id.  Files are read in blocks, by seeking, that know nothing of documents:
1. each block finds its separators in one vectorised comparison;
2. a prefix scan over the blocks of a file, of one small row each, gives the tokens and separators
   before each block and where its first document began;
3. each separator then ends a document whose start is the separator before it, in its own block or
   stitched from an earlier one.  Tokens after a file's last separator are an unfinished document.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stages
from .packing import _each, shared_tokens, token_path
from .shingles import buffers

#: The end-of-document token, by its name in the vocabulary, and ids in a block.
END = "<|endoftext|>"
BLOCK = 1 << 20


@functools.cache
def separator(path: str, name: str = END) -> tuple[int, int]:
    """(id, bytes of an id) of the token that ends documents; ids take two bytes if all do."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    end = t.token_to_id(name)
    if end is None:
        raise ValueError(f"the vocabulary has no {name}")
    return end, 2 if max(t.get_vocab().values()) < 1 << 16 else 4


def _opened(uri: str):
    """(file system, path) of a URI; file: is this machine's, others are what pyarrow knows (hdfs, s3, gs)."""
    from pyarrow import fs

    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, length) of the files under path; their content is not read."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")


def write_token_files(docs: DataFrame, root: str, path: str | None = None) -> DataFrame:
    """The documents as flat token files under root, one for each task; (file, ordinal, doc_id) in their order, and (file, length) of each.

    Rows tell what was written, so files of tasks that failed or ran twice are named nowhere.
    """
    path = path or token_path()
    end, width = separator(path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens = shared_tokens(path, special_as_text=True)
        files, folder = _opened(root)
        files.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bin"
        ordinal, length, out = 0, 0, None
        names = ["file", "ordinal", "doc_id", "length"]
        arrow = pa.int64()
        for batch in batches:
            arrow = batch.column(0).type
            out = out or files.open_output_stream(f"{folder}/{name}")
            data, at = buffers(batch.column(1))
            for _, text in _each(tokens, data, at):
                ids = np.append(np.frombuffer(text, "<u4"), np.uint32(end)).astype(f"<u{width}").tobytes()
                out.write(ids)
                length += len(ids)
            n = len(batch)
            yield pa.RecordBatch.from_arrays([pa.array([f"{root}/{name}"] * n, pa.string()), pa.array(np.arange(ordinal, ordinal + n)), batch.column(0), pa.nulls(n, pa.int64())], names)
            ordinal += n
        tokens.rest()
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{root}/{name}"]), pa.nulls(1, pa.int64()), pa.nulls(1, arrow), pa.array([length], pa.int64())], names)

    return docs.select("doc_id", "text").mapInArrow(run, f"file string, ordinal long, doc_id {kind}, length long")


def _separators(end: int, width: int, size: int):
    """(file, block, length) -> file, block, n (ids), ends (places of separators): the block's bytes, read by seeking."""

    def run(batches):
        import pyarrow as pa

        name, source = None, None
        for batch in batches:
            n, places, ends = [], [], [0]
            for file, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if file != name:
                    if source:
                        source.close()
                    files, at = _opened(file)
                    name, source = file, files.open_input_file(at)
                data = source.read_at(size * width, block * size * width)
                ids = np.frombuffer(data, f"<u{width}", len(data) // width)
                places.append(np.flatnonzero(ids == end))
                n.append(len(ids))
                ends.append(ends[-1] + len(places[-1]))
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(places) if places else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), found], ["file", "block", "n", "ends"])
        if source:
            source.close()

    return run


def scan_documents(files: DataFrame, stages: Stages, end: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """(file, block, place, ordinal, start, n_tokens, finished): one row for each document of the token files.

    files: (file, length), read in blocks of ``block`` ids; a file may be of any length.  start counts ids from the file's beginning, ordinal documents;
    block and place say which separator of which block ended the document.  n_tokens leaves the
    separator out.  Empty files have no documents; odd bytes at a file's end are dropped.  A file that
    is named twice is scanned once.
    """
    some = files.where("length > 0").select("file", "length").distinct()
    blocks = some.select("file", F.explode(F.expr(f"sequence(0L, (length - 1) div {block * width}L)")).alias("block"))
    blocks = blocks.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", F.floor(F.col("block") / 16)).sortWithinPartitions("file", "block")
    found = stages.put(blocks.mapInArrow(_separators(end, width, block), "file string, block long, n long, ends array<bigint>"), "separators")
    small = found.select("file", "block", "n", F.size("ends").alias("k"), F.when(F.size("ends") > 0, F.element_at("ends", -1)).alias("last_end"))
    scan = small.selectExpr("*", "sum(n) over (partition by file order by block) - n as tokens_before", "sum(k) over (partition by file order by block) - k as ends_before")
    before = "over (partition by file order by block rows between unbounded preceding and 1 preceding)"
    scan = scan.selectExpr("*", f"coalesce(max(tokens_before + last_end + 1) {before}, 0) as open_from", "lead(block) over (partition by file order by block) is null as is_last")
    scan = stages.put(scan, "scan")
    x = found.join(scan.drop("n", "k", "last_end"), ["file", "block"])
    done = x.select("file", "block", "tokens_before", "ends_before", "open_from", "ends", F.posexplode("ends").alias("place", "e"))
    start = F.when(F.col("place") == 0, F.col("open_from")).otherwise(F.col("tokens_before") + F.get("ends", F.col("place") - 1) + 1)
    done = done.select("file", "block", "place", (F.col("ends_before") + F.col("place")).alias("ordinal"), start.alias("start"), (F.col("tokens_before") + F.col("e") - start).alias("n_tokens"), F.lit(True).alias("finished"))
    tail = scan.where("is_last").select(
        "file", "block", F.lit(None).cast("int").alias("place"), (F.col("ends_before") + F.col("k")).alias("ordinal"),
        F.coalesce(F.col("tokens_before") + F.col("last_end") + 1, "open_from").alias("start"),
        (F.col("tokens_before") + F.col("n")).alias("stop"),
    )
    tail = tail.where("stop > start").select("file", "block", "place", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), F.lit(False).alias("finished"))
    return done.unionByName(tail)


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, file, ordinal, start for each row of docs (doc_id, text; other columns are ignored).

    The documents become flat token files in the shared folder, which are scanned; counts come from
    the scan alone, and a document's place in its file tells whose they are.  The strings of special
    tokens in a text are ordinary text, so no text holds the separator.  Null and empty texts count 0.
    Null doc_id and repeated rows: counted each.  Empty table: no rows.
    """
    stages = Stages(docs.sparkSession, "tokens")
    end, width = separator(path or token_path())
    written = stages.put(write_token_files(docs, f"{stages.root}/files", path), "names")
    found = scan_documents(written.where("length is not null").select("file", "length"), stages, end, width)
    names = written.where("ordinal is not null").select("file", "ordinal", "doc_id")
    return found.join(names, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
