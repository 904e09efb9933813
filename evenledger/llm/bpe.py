"""Byte-level BPE encoding and decoding with a given vocabulary.

Texts are split into pieces by the vocabulary's usual pattern, found here from the classes of neighbouring characters;
distinct pieces are encoded side by side. A long piece is unsplit text: it is halved down to leaves, the leaves are
encoded in parallel, and at each join a window of tokens around it is encoded anew and widened until it agrees with
both sides. This is exact: a row of tokens is the encoding of its bytes if every two neighbours are, and a window that
keeps the outermost token of each side joins neighbours that are.

Texts over ``LONG_BYTES`` are dealt out over tasks as segments, cut where the pattern always cuts, or, inside unsplit
text, anywhere; their joins are made in the same way.
"""

from __future__ import annotations

import json
import unicodedata
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from evenledger.llm.common import saved, small_batches, text_rows
from evenledger.llm.hashing import buffer_of, prefix_sums, span_hashes

BATCH_BYTES = 2 << 20
LONG_BYTES = 1 << 20
SEGMENT_BYTES = 1 << 18
#: Pieces longer than this many bytes are joined from leaves.
LEAF = 48
SPACE, LETTER, NUMBER, OTHER = range(4)
#: White space of the pattern (Unicode White_Space). Fixed values.
WHITE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
NONE = np.int32(0x7FFFFFFF)


def classes(splitter) -> np.ndarray:
    """Class of every code point. Where the Unicode tables at hand differ, the vocabulary's own splitter decides."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(every)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.finditer(pattern, text):
            table[ord(run[0][0]) : ord(run[0][-1]) + 1] = kind
    kinds = {"L": LETTER, "N": NUMBER}
    for c in every:
        if kinds.get(unicodedata.category(c)[0], OTHER) != table[ord(c)]:
            pieces = [piece for piece, _ in splitter.pre_tokenize_str("1" + c + "a")]
            table[ord(c)] = OTHER if len(pieces) == 3 else LETTER if len(pieces[0]) == 1 else NUMBER
    table[list(WHITE)] = SPACE
    return table


class Vocabulary:
    """Tables of a byte-level BPE file: merges in a hash table, bytes of every token, special tokens."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.classes = classes(Tokenizer.from_str(text).pre_tokenizer)
        ids = spec["model"]["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {b: chr(b) for b in printable}
        rest = [b for b in range(256) if b not in chars]
        chars |= {b: chr(256 + k) for k, b in enumerate(rest)}
        back = {c: b for b, c in chars.items()}
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for token, k in ids.items():
            spelled[k] = bytes(back[c] for c in token)
        for token, k in self.special.items():
            spelled[k] = token
        self.lengths = np.array([len(x) for x in spelled])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.first = np.array([ids[chars[b]] for b in range(256)], dtype=np.int32)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        keys = np.array([(ids[a] << 20) | ids[b] for a, b in pairs], dtype=np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
        bits = max(10, (16 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << bits, NONE, dtype=np.int32)
        slots = self._slots(keys)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), slots.tolist())):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.ranks[slot] = key, rank

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NONE where there is none."""
        keys = (left.astype(np.int64) << 20) | right
        slots = self._slots(keys)
        found = self.keys[slots]
        ranks = np.where(found == keys, self.ranks[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            ranks[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return ranks


def merge_all(vocab: Vocabulary, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, owner) of pieces given as first ids, in order: each round does every piece's best merge."""
    done_symbols, done_owner = [], []
    while len(symbols):
        joined = owner[1:] == owner[:-1]
        ranks = np.full(len(symbols), NONE, dtype=np.int32)
        at = np.flatnonzero(joined)
        ranks[at] = vocab.rank(symbols[at], symbols[at + 1])
        heads = np.flatnonzero(np.concatenate(([True], ~joined)))
        best = np.minimum.reduceat(ranks, heads)
        sizes = np.diff(np.append(heads, len(symbols)))
        own_best = np.repeat(best, sizes)
        over = own_best == NONE
        if over.any():
            done_symbols.append(symbols[over])
            done_owner.append(owner[over])
        hit = np.flatnonzero((ranks == own_best) & ~over)
        if not len(hit):
            break
        run = np.concatenate(([True], np.diff(hit) != 1))  # of "aaa" only every second pair can merge
        if not run.all():
            start = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - start) % 2 == 0]
        symbols = symbols.copy()
        symbols[hit] = vocab.merged[ranks[hit]]
        stay = ~over
        stay[hit + 1] = False
        symbols, owner = symbols[stay], owner[stay]
    if not done_symbols:
        return symbols, owner
    symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return symbols[order], owner[order]


def encode_many(vocab: Vocabulary, pieces: list[np.ndarray]) -> list[np.ndarray]:
    """Tokens of short pieces given as bytes."""
    owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    tokens, owner = merge_all(vocab, vocab.first[np.concatenate(pieces)], owner)
    return np.split(tokens, np.searchsorted(owner, np.arange(1, len(pieces))))


def join_all(vocab: Vocabulary, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Encodings of neighbouring encoded texts (one piece together), by windows that grow until both sides agree."""
    out: list[np.ndarray | None] = [None] * len(pairs)
    open_ = {i: 1 for i in range(len(pairs))}
    while open_:
        order = list(open_)
        windows = []
        for i in order:
            left, right = pairs[i]
            windows.append(spell(vocab, np.concatenate((left[-open_[i] :], right[: open_[i]]))))
        for i, found in zip(order, encode_windows(vocab, windows)):
            (left, right), k = pairs[i], open_[i]
            fits_left = k >= len(left) or found[0] == left[-k]
            fits_right = k >= len(right) or found[-1] == right[k - 1]
            if fits_left and fits_right:
                out[i] = np.concatenate((left[:-k], found, right[k:]))
                del open_[i]
            else:
                open_[i] = 2 * k
    return out


def encode_windows(vocab: Vocabulary, windows: list[np.ndarray]) -> list[np.ndarray]:
    short = [i for i, w in enumerate(windows) if len(w) <= 8 * LEAF]
    out: list[np.ndarray] = [None] * len(windows)
    if short:
        for i, found in zip(short, encode_many(vocab, [windows[i] for i in short])):
            out[i] = found
    for i, w in enumerate(windows):
        if out[i] is None:
            out[i] = encode_long(vocab, w)
    return out


def encode_long(vocab: Vocabulary, piece: np.ndarray) -> np.ndarray:
    """Tokens of one long piece: halves down to leaves, then joins upwards."""
    parts = encode_many(vocab, [piece[a : a + LEAF] for a in range(0, len(piece), LEAF)])
    while len(parts) > 1:
        joined = join_all(vocab, list(zip(parts[0::2], parts[1::2])))
        parts = joined + parts[len(parts) - len(parts) % 2 :]
    return parts[0]


def spell(vocab: Vocabulary, tokens: np.ndarray) -> np.ndarray:
    """Bytes of tokens."""
    lengths = vocab.lengths[tokens]
    ends = np.cumsum(lengths)
    index = np.repeat(vocab.starts[tokens] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    return vocab.bytes[index]


def split(vocab: Vocabulary, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of all pieces, classes of bytes); a special token is one piece."""
    n = len(buf)
    kind = vocab.classes[:128][np.minimum(buf, 127)]
    leads = np.flatnonzero(buf >= 0xC0)
    if len(leads):
        first = buf[leads].astype(np.int64)
        wide = np.append(buf, np.zeros(3, np.uint8)).astype(np.int64) & 0x3F
        two = ((first & 0x1F) << 6) | wide[leads + 1]
        three = ((first & 0x0F) << 12) | (wide[leads + 1] << 6) | wide[np.minimum(leads + 2, n + 2)]
        four = ((first & 0x07) << 18) | (wide[leads + 1] << 12) | (wide[np.minimum(leads + 2, n + 2)] << 6) | wide[np.minimum(leads + 3, n + 2)]
        code = np.where(first >= 0xF0, four, np.where(first >= 0xE0, three, two))
        found = vocab.classes[np.minimum(code, 0x10FFFF)]
        kind[leads] = found
        kind[leads + 1] = found
        for more, least in ((2, 0xE0), (3, 0xF0)):
            own = first >= least
            kind[leads[own] + more] = found[own]
    edge = np.zeros(n + 4, dtype=bool)
    edge[offsets] = True
    special = []
    raw = buf.tobytes()
    for token in vocab.special:
        at = raw.find(token)
        while at >= 0:
            if not edge[at + 1 : at + len(token)].any():
                edge[[at, at + len(token)]] = True
                special.append((at, at + len(token)))
            at = raw.find(token, at + len(token))
    change = edge[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    begin = change.copy()
    after = np.flatnonzero(change & ~edge[:n])
    after = after[after > 0]
    after = after[(kind[after - 1] == SPACE) & (kind[after] != SPACE)]
    last = after - 1
    for _ in range(3):
        last = last - ((buf[last] & 0xC0) == 0x80)
    begin[last] = True
    begin[after[buf[last] == 32]] = False
    quote = np.flatnonzero(buf[: max(0, n - 1)] == 39)
    quote = quote[begin[quote] & change[quote + 1] & ~edge[quote + 1] & (kind[quote + 1] == LETTER)]
    if len(quote):
        one = buf[quote + 1]
        two = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], buf[np.minimum(quote + 2, n - 1)], 0)
        size = np.where(np.isin(one, list(b"stmd")), 1, np.where(((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108), 2, 0))
        quote, size = quote[size > 0], size[size > 0]
        begin[quote + 1] = False
        ends = quote + 1 + size
        begin[ends[ends < n]] = True
    for a, b in special:
        begin[a + 1 : b] = False
    return np.flatnonzero(begin), kind


def encode_buffer(vocab: Vocabulary, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all texts in order, offsets of the texts among them)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    starts, _ = split(vocab, buf, offsets)
    ends = np.append(starts[1:], n)
    hashes = span_hashes(prefix_sums(buf, 1), starts, ends, 1)
    found, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    begin, stop = starts[first], ends[first]
    sizes = stop - begin
    tokens_of: list = []
    specials = {}
    for token, k in vocab.special.items():
        for i in np.flatnonzero(sizes == len(token)):
            if buf[begin[i] : stop[i]].tobytes() == token:
                specials[i] = k
    short = sizes <= LEAF
    short[list(specials)] = False
    places = np.flatnonzero(short)
    size = sizes[places]
    index = np.repeat(begin[places] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    tokens, owner = merge_all(vocab, vocab.first[buf[index]], np.repeat(places, size))
    for i in np.flatnonzero(~short):
        own = np.array([specials[i]], dtype=np.int32) if i in specials else encode_long(vocab, buf[begin[i] : stop[i]])
        tokens_of.append(own)
        owner = np.append(owner, np.full(len(own), i))
    tokens = np.concatenate([tokens, *tokens_of])
    order = np.argsort(owner, kind="stable")
    tokens, owner = tokens[order], owner[order]
    counts = np.bincount(owner, minlength=len(found))
    base = np.cumsum(counts) - counts
    each = counts[inverse]
    total = np.cumsum(each)
    out = tokens[np.repeat(base[inverse] - (total - each), each) + np.arange(total[-1])]
    bounds = np.concatenate(([0], total))[np.searchsorted(starts, offsets)]
    return out, bounds


def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        return Vocabulary(f.read())


def short_batches(batches, vocab, digest):
    vocab = vocab.value
    for batch in small_batches(batches, "text", BATCH_BYTES):
        buf, offsets = buffer_of(batch.column("text"))
        tokens, bounds = encode_buffer(vocab, buf, offsets)
        yield from digest(vocab, batch.column("doc_id").to_pylist(), tokens, bounds)


def segments(vocab: Vocabulary, buf: np.ndarray) -> list[tuple[int, int, bool]]:
    """(start, end, whether it goes on a piece that the segment before began) over one text.

    A change of class ends a piece whatever stands before and after, unless white space or an apostrophe before a
    letter comes first. Where a half segment has no such place, it is nearly all one run, which is cut in its middle.
    """
    out, at, joined = [], 0, False
    while at < len(buf):
        end, after = min(len(buf), at + SEGMENT_BYTES), False
        if end < len(buf):
            back, stop = end - SEGMENT_BYTES // 2, end
            while (buf[back] & 0xC0) == 0x80:
                back += 1
            while stop < len(buf) and (buf[stop] & 0xC0) == 0x80:
                stop += 1
            part = buf[back:stop]
            _, kind = split(vocab, part, np.array([0, len(part)]))
            change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
            cut = change[(kind[change - 1] != SPACE) & ((part[change - 1] != 39) | (kind[change] != LETTER))]
            low = max(at, back - 32)
            raw = buf[low : stop + 32].tobytes()
            for token in vocab.special:
                found = raw.find(token)
                while found >= 0:
                    inside = (cut + back > low + found) & (cut + back < low + found + len(token))
                    cut = cut[~inside]
                    found = raw.find(token, found + len(token))
            if len(cut):
                end = back + int(cut[-1])
            else:
                edges = np.concatenate(([0], change, [len(part)]))
                longest = int(np.argmax(np.diff(edges)))
                end, after = back + int(edges[longest] + edges[longest + 1]) // 2, True
                while (buf[end] & 0xC0) == 0x80:
                    end += 1
        out.append((at, end, joined))
        at, joined = end, after
    return out


def segment_batches(batches, vocab):
    vocab = vocab.value
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            buf = np.frombuffer(text.as_buffer(), dtype=np.uint8)
            for k, (a, b, joined) in enumerate(segments(vocab, buf)):
                yield pa.RecordBatch.from_arrays([pa.array([doc_id]), pa.array([k]), pa.array([joined]), pa.array([buf[a:b].tobytes()])], names=["doc_id", "part", "joined", "text"])


def part_batches(batches, vocab):
    vocab = vocab.value
    for batch in small_batches(batches, "text", BATCH_BYTES):
        buf, offsets = buffer_of(batch.column("text"))
        tokens, bounds = encode_buffer(vocab, buf, offsets)
        ids = [tokens[a:b].astype("<i4").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("joined"), pa.array(ids, pa.binary())], names=["doc_id", "part", "joined", "ids"])


def joined_batches(batches, vocab, digest):
    """Long texts from their encoded segments: joined in pairs, neighbours first."""
    vocab = vocab.value
    for batch in batches:
        for doc_id, parts in zip(batch.column("doc_id").to_pylist(), batch.column("parts")):
            rows = parts.values
            pieces = [np.frombuffer(x.as_buffer(), dtype="<i4") for x in rows.field("ids")]
            goes_on = rows.field("joined").to_pylist()
            while len(pieces) > 1:
                pairs = list(zip(pieces[0::2], pieces[1::2]))
                touch = goes_on[1::2]
                inner = iter(join_all(vocab, [p for p, t in zip(pairs, touch) if t]))
                done = [next(inner) if t else np.concatenate(p) for p, t in zip(pairs, touch)]
                goes_on = goes_on[0::2]
                pieces = done + pieces[len(pieces) - len(pieces) % 2 :]
            tokens = pieces[0]
            yield from digest(vocab, [doc_id], tokens, np.array([0, len(tokens)]))


def encode(docs: DataFrame, path: str, digest, schema: str, key: str = "doc_id", text: str = "text", long_bytes: int = LONG_BYTES) -> DataFrame:
    """What ``digest(vocabulary, ids of texts, tokens, offsets)`` yields as record batches for the encoded texts.

    Every text is encoded whole; a null text is empty and has no tokens. The file is read by the driver and
    broadcast. Texts of over ``long_bytes`` bytes are encoded in segments by many tasks and joined again, by a number of
    their row: keys may be null or repeated.
    """
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(load(path))
    rows = text_rows(docs, key, text)
    size = F.octet_length("text")
    short = rows.where(size <= long_bytes).mapInArrow(partial(short_batches, vocab=vocab, digest=digest), schema)
    long = saved(rows.where(size > long_bytes).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    parts = long.select(F.col("row").alias("doc_id"), "text").mapInArrow(partial(segment_batches, vocab=vocab), "doc_id long, part long, joined boolean, text binary")
    parts = parts.repartition("doc_id", "part").mapInArrow(partial(part_batches, vocab=vocab), "doc_id long, part long, joined boolean, ids binary")
    listed = parts.groupBy(F.col("doc_id").alias("row")).agg(F.array_sort(F.collect_list(F.struct("part", "joined", "ids"))).alias("parts"))
    listed = listed.join(long.select("row", "doc_id"), "row").select("doc_id", "parts")
    return short.unionByName(listed.mapInArrow(partial(joined_batches, vocab=vocab, digest=digest), schema))


def text_digest(vocab, doc_ids, tokens, bounds):
    """(doc_id, ids) of each text."""
    ids = [tokens[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])


def decoded(vocab: Vocabulary, tokens: np.ndarray) -> bytes:
    """UTF-8 of the text that tokens stand for; bytes that are no character become U+FFFD."""
    raw = spell(vocab, tokens).tobytes()
    return raw.decode("utf-8", "replace").encode()
