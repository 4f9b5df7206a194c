"""Token counts by scanning flat token files for the end-of-document identifier.

A flat file is one stream of fixed-width token ids in which an end-of-document id closes each
document; it has no index. It is held as rows (file, block, tokens) of raw little-endian bytes.
Each block is searched for the separator in one vectorised comparison, which leaves the separators'
places in the block. A prefix scan stitches the blocks: sums of lengths and of separators, and the
latest separator before each block, first within spans of ``SPAN`` blocks and then over the
spans, so no task holds more than ``SPAN`` summaries, or one summary for each span of a file.

Defined cases: a separator right after another closes an empty document of 0 tokens; tokens after
the last separator of a file are a last document that is not ``closed``; empty and null blocks
count as blocks without tokens; a null file is a file of its own; no blocks give no rows.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Tokens of a block that ``flatten`` writes, and blocks whose summaries one task stitches.
BLOCK, SPAN = 1 << 16, 1024


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def flatten(
    docs: DataFrame, path: str, pattern: str, separator: int, dtype: str = "<u2", block: int = BLOCK
) -> DataFrame:
    """Flat token files of all texts, one for each input partition, in blocks.

    Returns (file, block, tokens, closed_ids): the raw tokens, and the doc_ids of the documents whose
    separator lies in the block, in order, which only :func:`named` reads. Special tokens in a
    text are ordinary text; null is an empty text. The result must be stored before it is read, as
    files are numbered by partition.
    """
    if separator > np.iinfo(dtype).max:
        raise ValueError("the separator does not fit the token width")

    def run(batches):
        encoding, file = _encoding(path, pattern), TaskContext.get().partitionId()
        held, ids, number = [], [], 0
        size = 0

        def rows(last: bool):
            """Whole blocks of what is held; ``ids`` are (end of the document, doc_id)."""
            nonlocal held, ids, number, size
            flat = np.concatenate(held) if held else np.zeros(0, dtype)
            starts = range(0, len(flat) if last else len(flat) - len(flat) % block, block)
            out, at = [], 0
            for start in starts:
                names = []
                while at < len(ids) and ids[at][0] < start + block:
                    names.append(ids[at][1])
                    at += 1
                out.append((file, number, flat[start : start + block].tobytes(), names))
                number += 1
            done = len(starts) * block
            held, size = [flat[done:]], len(flat[done:])
            ids = [(end - done, name) for end, name in ids[at:]]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(column, kind)
                        for column, kind in zip(
                            zip(*out, strict=True),
                            (pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())),
                            strict=True,
                        )
                    ],
                    ["file", "block", "tokens", "closed_ids"],
                )

        for batch in common.bounded(batches):
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                tokens = np.array([*encoding.encode_ordinary(text or ""), separator], dtype)
                held.append(tokens)
                size += len(tokens)
                ids.append((size - 1, doc_id))
                if size >= 8 * block:
                    yield from rows(last=False)
        yield from rows(last=True)

    common.prepare(docs.sparkSession)
    schema = "file int, block long, tokens binary, closed_ids array<long>"
    return common.documents(docs, "text").mapInArrow(run, schema)


def scan(blocks: DataFrame, separator: int, dtype: str = "<u2") -> DataFrame:
    """(file, block, length, ends): tokens of a block and the places of its separators."""

    def run(batches):
        for batch in batches:
            lengths, ends = [], []
            for raw in batch.column("tokens").to_pylist():
                tokens = np.frombuffer(raw or b"", dtype)
                lengths.append(len(tokens))
                ends.append(np.flatnonzero(tokens == separator).astype(np.int32))
            yield common.record_batch(
                file=batch.column("file"), block=batch.column("block"),
                length=pa.array(lengths, pa.int64()), ends=pa.array(ends, pa.list_(pa.int32())),
            )

    common.prepare(blocks.sparkSession)
    read = blocks.select(
        F.col("file").cast("int").alias("file"), F.col("block").cast("long").alias("block"), "tokens"
    )
    return read.mapInArrow(run, "file int, block long, length long, ends array<int>")


def count_tokens(
    blocks: DataFrame, separator: int, dtype: str = "<u2", span: int = SPAN
) -> DataFrame:
    """(file, place, start, n_tokens, closed) for each document of the flat files.

    ``place`` numbers the documents of a file from 0, ``start`` is the first token's place in it.
    """
    scanned = common.stored(scan(blocks, separator, dtype), "token-ends").withColumn(
        "span", F.floor(F.col("block") / span)
    )
    here = Window.partitionBy("file", "span").orderBy("block")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1).cast("long"))
    summed = scanned.withColumns(
        {
            "offset": F.coalesce(F.sum("length").over(before), F.lit(0)),
            "place": F.coalesce(F.sum(F.size("ends").cast("long")).over(before), F.lit(0)),
        }
    ).withColumn("last", F.max(F.col("offset") + last).over(before))
    spans = scanned.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).groupBy(
        "file", "span"
    ).agg(
        F.sum("length").alias("length"),
        F.sum(F.size("ends").cast("long")).alias("places"),
        F.max(F.col("offset") + last).alias("end"),
    )
    over = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    placed = spans.withColumns(
        {
            "span_offset": F.coalesce(F.sum("length").over(over), F.lit(0)),
            "span_place": F.coalesce(F.sum("places").over(over), F.lit(0)),
        }
    ).withColumn("span_last", F.max(F.col("span_offset") + F.col("end")).over(over))
    starts = placed.select(
        F.col("file").alias("_file"), F.col("span").alias("_span"),
        "span_offset", "span_place", "span_last",
    )
    stitched = summed.join(
        starts, F.col("file").eqNullSafe(F.col("_file")) & (F.col("span") == F.col("_span"))
    ).select(
        "file",
        "ends",
        (F.col("span_offset") + F.col("offset")).alias("offset"),
        (F.col("span_place") + F.col("place")).alias("place"),
        F.coalesce(F.col("span_offset") + F.col("last"), "span_last", F.lit(-1)).alias("last"),
    )
    closed = stitched.select("*", F.posexplode("ends").alias("nth", "end")).select(
        "file",
        (F.col("place") + F.col("nth")).alias("place"),
        (
            F.when(
                F.col("nth") > 0,
                F.col("offset") + F.get("ends", F.col("nth") - 1).cast("long"),
            ).otherwise(F.col("last"))
            + 1
        ).alias("start"),
        (F.col("offset") + F.col("end")).alias("stop"),
        F.lit(True).alias("closed"),
    )
    tail = (
        placed.groupBy("file")
        .agg(
            F.sum("places").alias("place"),
            F.coalesce(F.max(F.col("span_offset") + F.col("end")) + 1, F.lit(0)).alias("start"),
            F.sum("length").alias("stop"),
        )
        .filter(F.col("stop") > F.col("start"))
        .withColumn("closed", F.lit(False))
    )
    return closed.unionByName(tail).select(
        "file", "place", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "closed"
    )


def named(blocks: DataFrame, span: int = SPAN) -> DataFrame:
    """(file, place, doc_id) of the documents that ``flatten`` wrote.

    Numbered like the ends: within spans of blocks, and spans by their sums.
    """
    ids = blocks.select(
        "file", "block", F.floor(F.col("block") / span).alias("span"), F.col("closed_ids").alias("ids")
    )
    size = F.size("ids").cast("long")
    over = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = ids.groupBy("file", "span").agg(F.sum(size).alias("n")).select(
        F.col("file").alias("_file"), F.col("span").alias("_span"),
        F.coalesce(F.sum("n").over(over), F.lit(0)).alias("start"),
    )
    here = Window.partitionBy("file", "span").orderBy("block")
    first = F.coalesce(F.sum(size).over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        ids.withColumn("first", first)
        .join(starts, F.col("file").eqNullSafe(F.col("_file")) & (F.col("span") == F.col("_span")))
        .select("file", (F.col("start") + F.col("first")).alias("first"), F.posexplode("ids").alias("nth", "doc_id"))
        .select("file", (F.col("first") + F.col("nth")).alias("place"), "doc_id")
    )
