"""SHA-256 of files too large for one task: read in pieces, each by a task that goes on from the state the one before left."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterable, Iterator
from multiprocessing.pool import ThreadPool

from pyspark import RDD
from pyspark.sql import SparkSession

#: Fixed value: files up to so many bytes are read by one task.
ONE_TASK = 1 << 28
#: Bytes of a piece and of a record in it. The last piece of a row may end within a record and is left to the next row, whose last record is a byte.
PIECES = ((1 << 25, 1 << 20), (1 << 20, 1 << 16), (1 << 20, 1))
CONTEXT = 112  # bytes of OpenSSL's SHA256_CTX: the digest so far, the count and a block that isn't full
State = tuple[int, bytes, bytes]  # bytes read, context, first four bytes


def _openssl() -> ctypes.CDLL:
    """The library below hashlib, whose own objects can't be taken from one process to another."""
    import _hashlib

    return ctypes.CDLL(_hashlib.__file__)


def resumable() -> bool:
    try:
        return all(hasattr(_openssl(), f"SHA256_{f}") for f in ("Init", "Update", "Final"))
    except (ImportError, AttributeError, OSError):
        return False


def begun() -> State:
    context = ctypes.create_string_buffer(CONTEXT)
    _openssl().SHA256_Init(context)
    return 0, context.raw, b""


def fed(state: State, records: Iterable[tuple[int, bytes]]) -> State:
    """``state`` after records (position, bytes), which must follow on what it has read."""
    done, raw, head = state
    update, context = _openssl().SHA256_Update, ctypes.create_string_buffer(raw, CONTEXT)
    for at, value in records:
        if at != done:
            raise ValueError(f"a record at {at} follows {done} bytes")
        update(context, bytes(value), ctypes.c_size_t(len(value)))
        done, head = done + len(value), (head + value[:4])[:4] if len(head) < 4 else head
    return done, context.raw, bytes(head)


def ended(state: State) -> tuple[str, str]:
    """(checksum, head) in the form of ``sha2`` and ``hex``."""
    out = ctypes.create_string_buffer(32)
    _openssl().SHA256_Final(out, ctypes.create_string_buffer(state[1], CONTEXT))
    return out.raw.hex(), state[2].hex().upper()


def literal(path: str) -> str:
    """A path whose pattern characters stand for themselves."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def in_pieces(spark: SparkSession, path: str) -> bool:
    """Whether Spark reads a file of this name in pieces as it is: not those it would unpack, by their ending, and those it takes for hidden."""
    hadoop = spark._jvm.org.apache.hadoop
    codec = hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(hadoop.fs.Path(path))
    return codec is None and not path.rsplit("/", 1)[-1].startswith(("_", "."))


def _pieces(spark: SparkSession, path: str) -> Iterator[tuple[RDD, int]]:
    done = 0
    for piece, record in PIECES:
        conf = {"mapreduce.input.fileinputformat.inputdir": re.sub(r"([\\,])", r"\\\1", literal(path)), "fixedlengthinputformat.record.length": str(record), **{f"mapreduce.input.fileinputformat.split.{m}size": str(piece) for m in ("min", "max")}}
        rows = spark.sparkContext.newAPIHadoopRDD("org.apache.hadoop.mapreduce.lib.input.FixedLengthInputFormat", "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.BytesWritable", conf=conf, batchSize=max(1, (1 << 16) // record))
        end = rows.getNumPartitions() - (record > 1)
        yield from ((rows, i) for i in range(done // piece, end))
        done = end * piece


def file_digests(spark: SparkSession, files: list[tuple[str, int]]) -> list[tuple[str, str, str]]:
    """(path, checksum, head) of files (path, length), side by side; of a file one piece after another, and only the state passes the driver."""

    def digest(file: tuple[str, int]) -> tuple[str, str, str]:
        path, length = file
        state = begun()
        for rows, i in _pieces(spark, path):
            state = spark.sparkContext.runJob(rows, lambda records, state=state: [fed(state, records)], [i])[0]
        if state[0] != length:
            raise OSError(f"{path}: {state[0]} of {length} bytes were read")
        return path, *ended(state)

    if not files:
        return []
    with ThreadPool(min(len(files), spark.sparkContext.defaultParallelism)) as pool:
        return pool.map(digest, files, chunksize=1)
