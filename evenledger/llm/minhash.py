"""Near-duplicate documents by b-bit MinHash.

Every document gives a set of word shingles. Bands of whole minima propose candidates; of each minimum only its low
bits are kept, packed into bit planes, and compared by counting equal bits, corrected for chance. What passes is
confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenledger.llm.common import drop_saved, likely_in, saved, small_batches, text_rows
from evenledger.llm.graph import components
from evenledger.llm.hashing import buffer_of, mix, words

#: Minima of a signature, low bits kept of each, and bands of ROWS minima. A pair of similarity 0.8 meets in no band
#: with a chance of (1 - 0.8**4)**32 = 5e-8.
MINIMA, BITS, BANDS, ROWS = 256, 2, 32, 4
#: One-bit minima of the finer signature that classes get in buckets with several components.
FINE = 2048
#: Classes of a bucket that are compared with one another at once.
BLOCK = 256
#: A pair is confirmed on full sets unless its estimate lies this many standard deviations under the bound.
DEVIATIONS = 5.5
BATCH_BYTES = 4 << 20

SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("print_a", T.LongType()),
        T.StructField("print_b", T.LongType()),
        T.StructField("planes", T.ArrayType(T.LongType())),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def shingles(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes; a text of fewer words gives its whole sequence as one."""
    buf, offsets = buffer_of(column)
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, _, found, row in words(buf, offsets):
        hashes.append(found)
        rows.append(row)
    hashes = np.concatenate(hashes)
    bounds = np.searchsorted(np.concatenate(rows), np.arange(len(offsets)))
    factors = np.random.default_rng(size).integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = hashes[a:b]
        if 0 < len(own) < size:
            yield mix(np.array([(own * factors[: len(own)]).sum() + np.uint64(len(own))], dtype=np.uint64))
        elif len(own):
            total = own[: len(own) - size + 1] * factors[0]
            for k in range(1, size):
                total = total + own[k : len(own) - size + 1 + k] * factors[k]
            yield np.unique(mix(total))
        else:
            yield own


def minima(found: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set, by blocks of the set."""
    low = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    x = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 512):
        values = factors[:, None] * x[None, at : at + 512]
        values += shifts[:, None]
        np.minimum(low, values.min(axis=1), out=low)
    return low


def signature_batches(batches, size: int):
    rng = np.random.default_rng(7)
    factors = (rng.integers(0, 2**31, MINIMA) * 2 + 1).astype(np.uint32)
    shifts = rng.integers(0, 2**32, MINIMA).astype(np.uint32)
    salts = mix(rng.integers(0, 2**63, MINIMA, dtype=np.uint64))
    band = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    weight = mix(np.arange(101, 101 + ROWS, dtype=np.uint64)) | np.uint64(1)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print_a", pa.int64()), ("print_b", pa.int64()), ("planes", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])
    for batch in small_batches(batches, "text", BATCH_BYTES):
        counts, prints, planes, bands = [], [], [], []
        for found in shingles(batch.column("text"), size):
            counts.append(len(found))
            again = mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            prints.append((found.sum(dtype=np.uint64), again.sum(dtype=np.uint64) ^ np.bitwise_xor.reduce(again)) if len(found) else (0, 0))
            if not len(found):
                planes.append(None)
                bands.append(None)
                continue
            low = minima(found, factors, shifts).astype(np.uint64)
            bits = mix(low ^ salts)
            planes.append(np.concatenate([np.packbits(((bits >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)).view(np.int64) for b in range(BITS)]))
            keys = (low[: BANDS * ROWS].reshape(BANDS, ROWS) * weight).sum(axis=1, dtype=np.uint64)
            bands.append(mix(keys + band).view(np.int64))
        prints = np.array(prints, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array(planes, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
            schema=schema,
        )


def set_batches(batches, size: int):
    for batch in small_batches(batches, "text", BATCH_BYTES):
        sets = [found.view(np.int64) for found in shingles(batch.column("text"), size)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "shingles"])


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: the share of minima whose low bits all agree, less what chance gives."""
    lanes = MINIMA // 64
    apart = F.lit(0)
    for lane in range(lanes):
        mixed = F.lit(0).cast("long")
        for bit in range(BITS):
            at = bit * lanes + lane
            mixed = mixed.bitwiseOR(a[at].bitwiseXOR(b[at]))
        apart = apart + F.bit_count(mixed)
    chance = 0.5**BITS
    return ((F.lit(MINIMA) - apart) / F.lit(float(MINIMA)) - F.lit(chance)) / F.lit(1 - chance)


def lowest_estimate(percent: int) -> float:
    chance = 0.5**BITS
    equal = chance + (1 - chance) * percent / 100
    return percent / 100 - DEVIATIONS * (equal * (1 - equal) / MINIMA) ** 0.5 / (1 - chance)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), of a saved table, whose full sets reach the similarity. Only the sets of the pairs are moved."""
    left = likely_in(sets, "doc_id", pairs.select("a")).select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    right = likely_in(sets, "doc_id", pairs.select("b")).select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    held = pairs.join(left, "a").join(right, "b").withColumn("_both", both)
    return held.where(F.col("_both") * 100 >= percent * (F.size("set_a") + F.size("set_b") - F.col("_both"))).select("a", "b")


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id, itself included), kept (doc_id = component_id).

    Documents are linked when 100 * intersection >= ``percent`` * union of their sets of ``size``-word shingles.
    Sets hold 64-bit hashes of shingles. Null and empty texts and texts without words have an empty set and stand alone.
    Rows that share an id must share its text and are then one document given several times; a row with a null id gets
    the component of its text and a null ``kept``. Where ids may be repeated at will, number the rows first
    (``common.numbered``), as the pipeline does.

    Documents with the same set are one class first, whose smallest id stands for it. In each band bucket every class
    is compared with the bucket's hub (the class that meets most others), then classes outside the bucket's largest
    component with another hub. What still lies outside is compared with the bucket's other components block by block
    on a finer signature. So a large group of copies costs a few comparisons for each member, and no link between
    components is lost.
    """
    rows = text_rows(docs, key, text)
    signed = saved(rows.mapInArrow(partial(signature_batches, size=size), SIGNED), "signed")
    full = signed.where("n_shingles > 0")
    classes = saved(full.groupBy("n_shingles", "print_a", "print_b").agg(F.min("doc_id").alias("rep")), "classes")
    reps = full.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "n_shingles", "planes", "bands")
    reps = saved(reps, "reps")
    every, signed = signed, saved(signed.select("doc_id", "n_shingles", "print_a", "print_b"), "prints")
    drop_saved(every)
    full = signed.where("n_shingles > 0")

    bands = reps.select("doc_id", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = saved(bands.join(shared, "bucket"), "met")
    degree = met.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    marked = saved(reps.join(degree, "doc_id").select("doc_id", "n_shingles", "planes", "degree"), "planes")
    sets = saved(likely_in(rows, "doc_id", marked.select("doc_id")).mapInArrow(partial(set_batches, size=size), "doc_id long, shingles array<long>"), "sets")

    ranked = met.join(marked.select("doc_id", "degree"), "doc_id")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("doc_id")).alias("minus"))).alias("hub"))
    stars = met.join(hubs, "bucket").select("doc_id", (-F.col("hub.minus")).alias("hub")).where("doc_id <> hub")
    votes = stars.groupBy("doc_id", "hub").agg(F.count(F.lit(1)).alias("votes"))
    first = votes.groupBy("doc_id").agg(F.max(F.struct("votes", (-F.col("hub")).alias("minus"))).alias("best"))
    pairs = saved(likely(first.select(F.col("doc_id").alias("a"), (-F.col("best.minus")).alias("b")), marked, percent), "pairs")
    links = saved(confirmed(pairs, sets, percent), "links")
    labels = saved(labelled(marked, links), "labels")
    drop_saved(pairs)
    pairs = saved(likely(hub_pairs(mixed_buckets(met, labels)), marked, percent), "pairs")
    before, links = links, saved(links.unionByName(confirmed(pairs, sets, percent)), "links")
    drop_saved(pairs, labels, before)
    labels = saved(labelled(marked, links), "labels")
    there = saved(mixed_buckets(met, labels), "mixed")
    drop_saved(met, labels, marked)
    pairs = open_pairs(there, sets, reps, percent)
    drop_saved(there, reps)
    before, links = links, saved(links.unionByName(confirmed(pairs, sets, percent)), "links")
    drop_saved(pairs, sets, before)
    linked = components(links)
    drop_saved(links)
    by_class = full.join(classes, ["n_shingles", "print_a", "print_b"]).select("doc_id", "n_shingles", "rep")
    found = by_class.join(linked.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def likely(pairs: DataFrame, marked: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose packed signatures do not speak against it."""
    left = marked.select(F.col("doc_id").alias("a"), F.col("planes").alias("pa"), F.col("n_shingles").alias("na"))
    right = marked.select(F.col("doc_id").alias("b"), F.col("planes").alias("pb"), F.col("n_shingles").alias("nb"))
    sized = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return pairs.join(left, "a").join(right, "b").where(sized & (estimate(F.col("pa"), F.col("pb")) >= lowest_estimate(percent))).select("a", "b")


def labelled(marked: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return marked.select("doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("label"))


def mixed_buckets(met: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, doc_id, label, main, n, outside) of buckets that hold several components; main is the largest one."""
    there = met.join(labels, "doc_id").select("bucket", "doc_id", "label")
    groups = there.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("size"))
    mixed = groups.groupBy("bucket").agg(F.count(F.lit(1)).alias("labels"), F.sum("size").alias("n"), F.max(F.struct("size", "label")).alias("top"))
    mixed = mixed.where("labels > 1").select("bucket", "n", F.col("top.label").alias("main"), (F.col("n") - F.col("top.size")).alias("outside"))
    return there.join(mixed, "bucket")


def hub_pairs(there: DataFrame) -> DataFrame:
    """Every class outside a bucket's main component with one class of it, chosen by hash."""
    hubs = there.where("label = main").groupBy("bucket").agg(F.max_by("doc_id", F.xxhash64("doc_id", F.lit(1))).alias("hub"))
    pairs = there.where("label <> main").join(hubs, "bucket")
    return pairs.select(F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b")).distinct()


def fine_batches(batches):
    rng = np.random.default_rng(11)
    factors = (rng.integers(0, 2**31, FINE) * 2 + 1).astype(np.uint32)
    shifts = rng.integers(0, 2**32, FINE).astype(np.uint32)
    salts = mix(rng.integers(0, 2**63, FINE, dtype=np.uint64))
    for batch in batches:
        fine, sizes = [], []
        for found in batch.column("shingles"):
            own = np.asarray(found.values).view(np.uint64)
            bits = mix(minima(own, factors, shifts).astype(np.uint64) ^ salts) & np.uint64(1)
            fine.append(np.packbits(bits.astype(np.uint8)).tobytes())
            sizes.append(len(own))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(fine, pa.binary())], names=["doc_id", "size", "fine"])


def block_pairs(batches, percent: int):
    """Likely pairs (a, b) of the classes of two blocks of one bucket, where it is the first bucket that both share."""
    share = percent / 100
    equal = 0.5 + share / 2
    least = FINE * (equal - DEVIATIONS * (equal * (1 - equal) / FINE) ** 0.5)
    for batch in batches:
        for r in range(batch.num_rows):
            outside, members = (batch.column(c)[r].values for c in ("outside", "members"))
            bucket = batch.column("bucket")[r].as_py()
            id_a, id_b, label_a, label_b, n_a, n_b = (np.asarray(x.field(f)) for f in ("doc_id", "label", "size") for x in (outside, members))
            bits_a, bits_b, bands_a, bands_b = (
                np.frombuffer(b"".join(x.field("fine").to_pylist()), dtype=np.uint64).reshape(len(x), -1) if f == "fine" else np.asarray(x.field("bands").flatten()).reshape(len(x), BANDS)
                for f in ("fine", "bands")
                for x in (outside, members)
            )
            apart = np.zeros((len(id_a), len(id_b)), dtype=np.int32)
            for k in range(bits_a.shape[1]):
                apart += np.bitwise_count(bits_a[:, k, None] ^ bits_b[None, :, k])
            low, high = np.minimum(n_a[:, None], n_b), np.maximum(n_a[:, None], n_b)
            good = (FINE - apart >= least) & (label_a[:, None] != label_b) & (low * 100 >= high * percent)
            i, j = np.nonzero(good)
            first = np.argmax(bands_a[i] == bands_b[j], axis=1)
            here = bands_a[i, first] == bucket
            i, j = i[here], j[here]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(id_a[i], id_b[j])), pa.array(np.maximum(id_a[i], id_b[j]))], names=["a", "b"])


def open_pairs(there: DataFrame, sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """All likely pairs of one bucket in different components, of which one end lies outside the main one.

    A bucket's classes are dealt into blocks, and blocks are compared with blocks on finer signatures.
    """
    own = there.select("doc_id").distinct()
    fine = sets.join(own, "doc_id", "left_semi").mapInArrow(fine_batches, "doc_id long, size long, fine binary")
    rows = saved(there.join(fine.join(reps.select("doc_id", "bands"), "doc_id"), "doc_id"), "fine")
    part = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / BLOCK)).alias("part")
    other = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("outside") / BLOCK)).alias("part")
    entry = F.struct("doc_id", "label", "size", "fine", "bands")
    members = rows.groupBy("bucket", part).agg(F.collect_list(entry).alias("members")).drop("part")
    outside = rows.where("label <> main").groupBy("bucket", other).agg(F.collect_list(entry).alias("outside")).drop("part")
    met = outside.join(members, "bucket")
    found = saved(met.mapInArrow(partial(block_pairs, percent=percent), "a long, b long").distinct(), "pairs")
    drop_saved(rows)
    return found
