"""Repeated byte strings by bucket-pointer refinement.

Start positions are put into buckets by what they begin with, and a bucket is refined by the bucket identifiers found
at later offsets; positions alone in their bucket leave. Three levels keep the number of rows small:

1. Of every string of ``length`` bytes one q-gram (the smallest hash in it) is its anchor, so equal strings have equal
   anchors at equal offsets. Neighbouring starts with the same anchor make one run; runs are bucketed by their
   anchor's q-gram, and a run whose anchor occurs nowhere else leaves.
2. Buckets are refined by the whole bytes that a run's strings cover. Runs that still share a bucket repeat as a whole.
3. One run of each remaining bucket is taken apart into starts. The identifier of a start is built from those of
   q-grams at later offsets, of twice the length each time, reusing the identifiers of the level before.

Identifiers are 64-bit hashes, compared together with the anchor's, so two different strings pass as equal with a
chance of about 2**-64 if they share the anchor's q-gram and 2**-128 if not.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenledger.llm.common import drop_saved, numbered, saved, small_batches, text_rows
from evenledger.llm.hashing import buffer_of, mix, powers, prefix_sums, span_hashes

STEP_BYTES = 1 << 19
LOW_BITS = np.uint64((1 << 20) - 1)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def grams(sums: np.ndarray, width: int) -> np.ndarray:
    """Identifiers of all strings of ``width`` bytes, by start."""
    inv = powers(1, len(sums), inverse=True)
    return mix((sums[width:] - sums[:-width]) * inv[: len(sums) - width])


def q_of(length: int) -> int:
    """Long q-grams let few near copies through, short ones give fewer runs."""
    return max(1, length * 2 // 5)


def run_batches(batches, length: int):
    q = q_of(length)
    for batch in small_batches(batches, "text", STEP_BYTES):
        buf, offsets = buffer_of(batch.column("text"))
        ids = np.asarray(batch.column("doc_id"))
        for at in range(0, len(buf), STEP_BYTES):
            part = buf[at : at + STEP_BYTES + length - 1]
            if len(part) < length:
                continue
            sums = prefix_sums(part, 1)
            ident = grams(sums, q)
            place = np.arange(len(ident), dtype=np.uint64)
            anchor = (sliding_min((ident & ~LOW_BITS) | place, length - q + 1) & LOW_BITS).astype(np.int64)
            lows = np.maximum(offsets[:-1] - at, 0)
            tops = np.minimum(offsets[1:] - at - length + 1, len(anchor))
            inside = lows < tops
            if not inside.any():
                continue
            marks = np.zeros(len(anchor) + 1, dtype=np.int8)
            marks[lows[inside]] += 1
            marks[tops[inside]] -= 1
            valid = np.cumsum(marks[:-1]).astype(bool)
            same = np.zeros(len(anchor), dtype=bool)
            same[1:] = (anchor[1:] == anchor[:-1]) & valid[1:] & valid[:-1]
            starts = np.flatnonzero(valid & ~same)
            more = np.append(same[1:], False)
            ends = np.flatnonzero(valid & ~more) + 1
            rows = np.searchsorted(offsets, starts + at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[rows]),
                    pa.array(starts + at - offsets[rows]),
                    pa.array((ends - starts).astype(np.int32)),
                    pa.array(ident[anchor[starts]].view(np.int64)),
                    pa.array(span_hashes(sums, starts, ends + length - 1, 1).view(np.int64)),
                ],
                names=["doc_id", "start", "n", "bucket", "whole"],
            )


def bytes_of(text: pa.Scalar) -> np.ndarray:
    raw = text.as_buffer()
    return np.frombuffer(raw, dtype=np.uint8) if raw.size else np.zeros(0, dtype=np.uint8)


def start_batches(batches, length: int):
    """(bucket, ident, doc_id, start) of each start of the runs given with a text."""
    q = q_of(length)
    for batch in small_batches(batches, "text", STEP_BYTES):
        for doc_id, text, runs in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("runs")):
            buf = bytes_of(text)
            runs = runs.values
            lows = np.asarray(runs.field("start"))
            counts = np.asarray(runs.field("n"))
            buckets = np.asarray(runs.field("bucket"))
            for low, count, bucket in zip(lows, counts, buckets):
                ident = refined(buf[low : low + count + length - 1], length, q)
                n = len(ident)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, bucket)), pa.array(ident.view(np.int64)), pa.array(np.full(n, doc_id)), pa.array(low + np.arange(n))],
                    names=["bucket", "ident", "doc_id", "start"],
                )


def refined(part: np.ndarray, length: int, q: int) -> np.ndarray:
    """Identifiers of all strings of ``length`` bytes from those of q-grams, doubling what they cover."""
    ident, covers = grams(prefix_sums(part, 1), q), q
    while covers < length:
        step = min(covers, length - covers)
        ident = mix(ident[:-step] * np.uint64(0x9E3779B97F4A7C15) + ident[step:])
        covers += step
    return ident




def repeated(docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<start, end>>): where strings of ``length`` bytes lie that also start elsewhere.

    Spans are byte positions in the text's UTF-8 form and may touch or overlap. Only documents with spans have a row.
    Null and short texts have none. Keys must be distinct.
    """
    rows = text_rows(docs, key, text)
    runs = saved(rows.mapInArrow(partial(run_batches, length=length), "doc_id long, start long, n int, bucket long, whole long"), "runs")
    shared = saved(runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("met")).where("met > 1").select("bucket"), "buckets")
    every, runs = runs, saved(runs.join(shared, "bucket"), "open-runs")
    drop_saved(every, shared)
    kinds = runs.groupBy("bucket", "whole").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "start", "n")).alias("one"))
    kinds = saved(kinds, "kinds")
    several = kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("bucket")
    copied = saved(kinds.where("copies > 1").select("bucket", "whole"), "copied")
    full = runs.join(copied, ["bucket", "whole"]).select("doc_id", "start", (F.col("start") + F.col("n") + F.lit(length - 1)).alias("end"))
    apart = kinds.join(several, "bucket").select("bucket", "one.*")
    listed = apart.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "bucket")).alias("runs"))
    starts = rows.join(listed, "doc_id").mapInArrow(partial(start_batches, length=length), "bucket long, ident long, doc_id long, start long")
    starts = saved(starts, "starts")
    met = saved(starts.groupBy("bucket", "ident").agg(F.count(F.lit(1)).alias("met")).where("met > 1").select("bucket", "ident"), "met")
    full = saved(full, "whole-runs")
    drop_saved(runs, kinds, copied)
    single = starts.join(met, ["bucket", "ident"]).select("doc_id", "start", (F.col("start") + F.lit(length)).alias("end"))
    spans = saved(full.unionByName(single).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    drop_saved(starts, met, full)
    return spans


def removed_mask(size: int, spans: pa.StructArray | None) -> np.ndarray:
    edges = np.zeros(size + 1, dtype=np.int32)
    if spans is not None:
        np.add.at(edges, np.asarray(spans.field("start")), 1)
        np.add.at(edges, np.asarray(spans.field("end")), -1)
    return np.cumsum(edges[:-1]) > 0


def with_spans(docs: DataFrame, length: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and spans of every row; keys may be null or repeated, a row given twice is two texts."""
    rows = numbered(docs)
    spans = repeated(rows, length, "_row", text).withColumnRenamed("doc_id", "_row")
    texts = rows.select("_row", F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return texts.join(spans, "_row", "left").drop("_row")


def cut_batches(batches, digest):
    """One row for each text: what ``digest(bytes, removed)`` makes of it."""
    for batch in small_batches(batches, "text", STEP_BYTES):
        out = []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            buf = bytes_of(text)
            out.append(digest(buf, removed_mask(len(buf), spans.values if spans.is_valid else None)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in zip(*out))], names=["doc_id", *(f"c{i}" for i in range(len(out[0])))])


def whole_characters(buf: np.ndarray, removed: np.ndarray) -> str:
    """What stays as text: a character goes only if all its bytes go."""
    tail = (buf & 0xC0) == 0x80
    if removed.any() and tail.any():
        first = np.maximum.accumulate(np.where(tail, 0, np.arange(len(buf))))
        lost = np.bincount(first, weights=~removed, minlength=len(buf)) == 0
        removed = lost[first]
    return buf[~removed].tobytes().decode("utf-8")


def text_digest(buf, removed):
    return (whole_characters(buf, removed), int(removed.sum()))


def remove_repeats(docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_removed): every text without the bytes that ``repeated`` covers; whole characters only."""
    rows = with_spans(docs, length, key, text).mapInArrow(partial(cut_batches, digest=text_digest), "doc_id long, c0 string, c1 long")
    return rows.select("doc_id", F.col("c0").alias("text"), F.col("c1").alias("n_removed"))


def text_batches(batches, text):
    """Rows with their text cut by the spans in the last column, which goes."""
    for batch in small_batches(batches, text, STEP_BYTES):
        out = []
        for value, spans in zip(batch.column(text), batch.column("_spans")):
            buf = bytes_of(value) if value.is_valid else None
            out.append(None if buf is None else whole_characters(buf, removed_mask(len(buf), spans.values if spans.is_valid else None)))
        at = batch.schema.get_field_index(text)
        yield batch.set_column(at, text, pa.array(out, pa.string())).drop_columns(["_spans"])


def cut_texts(docs: DataFrame, length: int = 400, text: str = "text") -> DataFrame:
    """The table with all its columns, its texts without the bytes that ``repeated`` covers; nulls stay null.

    No copy of a repeated passage stays, the first one neither. Rows are told apart by their place in the table.
    """
    rows = numbered(docs)
    spans = repeated(rows, length, "_row", text).toDF("_key", "_spans")
    found = rows.join(spans, rows["_row"] == spans["_key"], "left").select(*[rows[c] for c in docs.columns], "_spans")
    return found.mapInArrow(partial(text_batches, text=text), docs.schema)
