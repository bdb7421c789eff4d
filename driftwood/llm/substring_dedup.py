"""Removal of long repeated byte strings by fingerprints.

This stands in for prefix-free parsing with suffix arrays: there is no phrase
dictionary, parse or rank.  Only equality of strings of ``LENGTH`` bytes
decides what is removed, and grouping by hashes finds that with partial
aggregates; an order of all suffixes is not needed for it.

A byte is removed when a string of ``LENGTH`` bytes that covers it also
starts anywhere else in the corpus, the same document included.  Matches
never cross documents, and strings are judged on the input.

**Triggers.**  A rolling hash over ``GRAM`` bytes marks fingerprints: a
position triggers when its hash is the smallest of some ``LENGTH - GRAM + 1``
consecutive ones.  Equal strings of ``LENGTH`` bytes trigger at the same
places, so every repeated string holds a trigger, at the same offset in all
its occurrences.

**Blocks.**  All occurrences of one trigger string form a block.  An entry of
a block is a distinct surrounding of the trigger, as far as strings that hold
it can reach, counted by a partial aggregate: in highly repetitive text nearly
everything ends there.  Surroundings that differ are gathered per block, and
for every ``t`` the strings that begin ``t`` bytes before the trigger are
compared by their hashes.

A block of more than ``HOT`` entries is not gathered.  Its offsets are cut in
up to ``PARTS`` ranges of ``t``; its entries are dealt out by the bytes that
all strings of a range share, and those that agree on every byte the strings
of the range cover are one entry again, counted by a partial aggregate.  What
still has more than ``HOT`` entries is cut further, down to single values of
``t``, where the shared bytes are the whole string and one entry is left.  So
a task never gathers more than ``HOT`` entries of a block, however often a
passage repeats and however its surroundings differ.

Positions are compared by hashes of 64 bits within blocks of equal 64-bit
trigger hashes.

Null text is empty.  Texts shorter than ``LENGTH`` lose nothing.  A row that
repeats another (id and text) is a document of its own, so both lose what
they share.  Empty tables give empty results.  The columns named in ``keep``
pass through unless they are named like an output.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.llm.arrowtext import group_bounds, longs, slices_by_chars, text_bytes, whole_groups
from driftwood.llm.components import stored
from driftwood.llm.linking import maybe_in
from driftwood.llm.minhash import mix

LENGTH = 400
GRAM = 128
HOT = 4096
PARTS = 8
BYTES_AT_A_TIME = 1_000_000

# an odd base, so that its powers can be undone
BASE = np.uint64(0x9E3779B97F4A7C55)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sized_powers(base: np.uint64, n: int) -> np.ndarray:
    """At least ``n`` powers (sizes are rounded up, so that few are made)."""
    return _powers(int(base), 1 << max(16, int(n - 1).bit_length()))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of every ``width`` consecutive values (``len(x) - width + 1``)."""
    step = 1
    while 2 * step <= width:
        x = best(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return best(x[:-rest], x[rest:]) if rest else x


class Parsed:
    """Rolling hashes and triggers of several texts, one after the other."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, length: int, gram: int):
        n = len(raw)
        self.offsets = offsets
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _sized_powers(BASE, n)[:n], out=sums[1:])
        self.sums, self.undo = sums, _sized_powers(UNBASE, n + 1)
        width = length - gram + 1
        self.at = np.zeros(0, np.int64)
        if n < length:
            return
        hashes = mix((sums[gram:] - sums[:-gram]) * self.undo[:n - gram + 1])
        ends = np.repeat(offsets[1:], np.diff(offsets))
        low = _sliding(hashes, width, np.minimum)                       # one value per string of ``length``
        low[ends[:len(low)] - np.arange(len(low)) < length] = 0         # strings that leave their text
        padded = np.zeros(len(hashes) + width - 1, np.uint64)
        padded[width - 1:width - 1 + len(low)] = low
        self.at = np.flatnonzero((_sliding(padded, width, np.maximum) == hashes) & (hashes != 0))
        self.at = self.at[ends[self.at] - self.at >= gram]
        self.hashes = hashes[self.at]

    def substring(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the strings ``[start, end)``, with their lengths."""
        return mix((self.sums[end] - self.sums[start]) * self.undo[start] + (end - start).astype(np.uint64))


def _surroundings(at: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int, gram: int):
    """For triggers at ``at`` in texts ``[begin, end)``: what the strings that
    hold them can reach, and the first and last place where one can start."""
    left = np.maximum(begin, at - (length - gram))
    right = np.minimum(end, at + length)
    return left, right, left, np.minimum(at, end - length)


def _triggers(length: int, gram: int):
    """Rows ``row, text`` → one row per trigger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_chars(batch, 1, BYTES_AT_A_TIME):
                raw, offsets = text_bytes(part.column(1))
                p = Parsed(raw, offsets, length, gram)
                if not len(p.at):
                    continue
                text = np.searchsorted(offsets, p.at, "right") - 1
                begin, end = offsets[text], offsets[text + 1]
                left, right, first, last = _surroundings(p.at, begin, end, length, gram)
                around = mix(p.substring(left, right) + (p.at - left).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [longs(p.hashes), longs(around), part.column(0).take(pa.array(text)),
                     pa.array((p.at - begin).astype(np.int32)), pa.array((first - begin).astype(np.int32)),
                     pa.array((last - begin).astype(np.int32))],
                    names=["trigger", "around", "row", "at", "first", "last"])

    return run


def _parts(length: int, gram: int):
    """Rows ``row, text, entries`` → every entry once per part of its range of
    ``t``: keyed by block, part and shared bytes, ``around`` by what the
    strings of the part cover."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, entries in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8", "replace")
                out = []
                for e in entries:
                    at, n = e["at"], e["t1"] - e["t0"] + 1
                    left, right = min(at, reach), min(len(data) - at, length)
                    parts = min(PARTS, n)
                    for i in range(parts):
                        t0, t1 = e["t0"] + n * i // parts, e["t0"] + n * (i + 1) // parts - 1
                        if left >= t0 and right >= length - t1:          # else no string of this part fits
                            far, near = min(t1, left), max(t0, length - right)
                            key = _digest(e["key"], (t0, t1), data[at - t0:at + length - t1])
                            around = _digest(key, (near, far), data[at - far:at - near + length])
                            out.append((key, around, row, at, at - far, at - near, t0, t1, e["alone"]))
                if out:
                    columns = zip(*out)
                    kinds = [pa.int64()] * 3 + [pa.int32()] * 5 + [pa.bool_()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)],
                        names=["key", "around", "row", "at", "first", "last", "t0", "t1", "alone"])

    return run


def _blocks(length: int, gram: int):
    """Rows ``row, text, entries`` → the surroundings of each entry, keyed by block."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, entries in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8", "replace")
                out = []
                for e in entries:
                    at = e["at"]
                    lo = max(0, at - reach)
                    out.append((e["key"], row, at, e["alone"], at - lo, e["t0"], e["t1"], data[lo:at + length]))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                        names=["key", "row", "at", "alone", "left", "t0", "t1", "string"])

    return run


def _digest(key: int, part: tuple[int, int], string: bytes) -> int:
    h = blake2b(string, digest_size=8, key=b"%d:%d:%d" % (key, *part))
    return int.from_bytes(h.digest(), "big", signed=True)


def _repeats(length: int, gram: int):
    """Whole blocks → ``row, first, last``: ranges of starts that repeat."""
    reach = length - gram
    width = reach + length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            n = table.num_rows
            if n < 2:
                continue
            key, row, at, alone, left, t0, t1 = (table.column(i).to_numpy() for i in range(7))
            strings = table.column(7).to_pylist()
            right = np.fromiter(map(len, strings), np.int64, n) - left
            text = np.zeros((n, width), np.uint64)
            for i, s in enumerate(strings):
                text[i, reach - left[i]:reach + right[i]] = np.frombuffer(s, np.uint8)
            text += np.uint64(1)
            text *= _sized_powers(BASE, width)[:width]
            sums = np.zeros((n, width + 1), np.uint64)
            np.cumsum(text, axis=1, out=sums[:, 1:])
            del text
            bounds = group_bounds(key)
            block = mix(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).astype(np.uint64) + np.uint64(0x5DEECE))
            again = np.zeros((n, reach + 1), bool)
            for t in range(reach + 1):
                fits = np.flatnonzero((t >= t0) & (t <= t1) & (t <= left) & (length - t <= right))
                if len(fits) < 2:
                    continue
                c = reach - t
                h = (mix(sums[fits, c + length] - sums[fits, c]) ^ block[fits])
                order = np.argsort(h)
                same = h[order[1:]] == h[order[:-1]]
                again[fits[order[1:][same]], t] = True
                again[fits[order[:-1][same]], t] = True
            again &= alone[:, None]
            edge = np.zeros((n, reach + 3), np.int8)
            edge[:, 1:-1] = again
            step = np.diff(edge, axis=1)
            i, begin = np.nonzero(step == 1)
            _, stop = np.nonzero(step == -1)
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[i]), pa.array((at[i] - (stop - 1)).astype(np.int32)),
                     pa.array((at[i] - begin).astype(np.int32))], names=["row", "first", "last"])

    return run


def _merged(ranges, length: int) -> list[tuple[int, int]]:
    """Removed spans (end exclusive) of sorted ranges of starts."""
    out: list[list[int]] = []
    for first, last in ranges:
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(s, e) for s, e in out]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _cut(keep: list[str], schema: T.StructType, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        k = len(keep)
        for batch in batches:
            for part in slices_by_chars(batch, k, 4 * BYTES_AT_A_TIME):
                sizes, spans, left = [], [], []
                for text, ranges in zip(part.column(k).to_pylist(), part.column(k + 1).to_pylist()):
                    data = (text or "").encode("utf-8", "replace")
                    gone = _merged(sorted((r["first"], r["last"]) for r in ranges or ()), length)
                    at, pieces = 0, []
                    for s, e in gone:
                        pieces.append(data[at:s])
                        at = e
                    pieces.append(data[at:])
                    sizes.append(len(data))
                    spans.append([{"start": s, "end": e} for s, e in gone])
                    left.append(b"".join(pieces))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(k)] + [pa.array(sizes, pa.int64()), pa.array(spans, span),
                                                          pa.array(left, pa.binary())], names=schema.names)

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep=("doc_id",),
                   length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``keep`` plus ``n_bytes``, ``spans`` (removed runs in bytes, end
    exclusive) and ``kept`` (the remaining bytes)."""
    if not 0 < gram < length:
        raise ValueError("the rolling hash must cover less than a string")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row = F.xxhash64(F.col(f"`{doc_id}`"), t, F.lit(1))
    rows = docs.select(row.alias("row"), t.alias("text"))
    found = stored(rows.where(F.octet_length("text") >= length).mapInArrow(
        _triggers(length, gram), "trigger long, around long, row long, at int, first int, last int"), "triggers")

    # blocks: triggers that occur twice, and their distinct surroundings
    twice = stored(found.groupBy("trigger").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("trigger"), "trigger-keys")
    blocks = stored(maybe_in(found, F.col("trigger"), twice, "trigger").where("_dw_hit").drop("_dw_hit")
                    .join(twice, "trigger"), "trigger-blocks")
    level = blocks.select(F.col("trigger").alias("key"), "around", "row", "at", "first", "last",
                          F.lit(0).alias("t0"), F.lit(length - gram).alias("t1"), F.lit(True).alias("alone"))

    def with_texts(entries: DataFrame) -> DataFrame:
        wanted = stored(entries.groupBy(F.col("row").alias("r"))
                        .agg(F.collect_list(F.struct("key", "at", "alone", "t0", "t1")).alias("entries")), "trigger-wanted")
        return maybe_in(rows, F.col("row"), wanted, "r").where("_dw_hit").join(wanted, F.col("row") == F.col("r")) \
            .select("row", "text", "entries").dropDuplicates(["row"])     # rows that repeat have one entry

    whole, small = [], []
    while True:
        entries = stored(level.groupBy("key", "around").agg(
            F.count(F.lit(1)).alias("c"), F.min(F.struct("row", "at")).alias("one"), F.min("alone").alias("alone"),
            F.min("t0").alias("t0"), F.min("t1").alias("t1")).withColumn("alone", F.col("alone") & (F.col("c") == 1)),
            "trigger-entries")
        whole.append(level.join(entries.where("c > 1").select("key", "around"), ["key", "around"], "left_semi")
                     .select("row", "first", "last"))
        # surroundings that differ: gathered while they are few, else cut into ranges
        mixed = entries.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.max("alone").alias("some")) \
            .where("k > 1 and some").select("key", (F.col("k") > HOT).alias("hot"))
        rest = stored(entries.join(mixed, "key").select("key", F.col("one.row").alias("row"), F.col("one.at").alias("at"),
                                                        "alone", "t0", "t1", "hot"), "trigger-mixed")
        small.append(rest.where("not hot"))
        hot = rest.where("hot")
        if hot.isEmpty():
            break
        level = stored(with_texts(hot).mapInArrow(_parts(length, gram), "key long, around long, row long, at int, first int, "
                                                                        "last int, t0 int, t1 int, alone boolean"), "trigger-parts")
    partly = with_texts(reduce(DataFrame.unionByName, small)).mapInArrow(
        _blocks(length, gram), "key long, row long, at int, alone boolean, left int, t0 int, t1 int, string binary") \
        .repartition("key").sortWithinPartitions("key") \
        .mapInArrow(_repeats(length, gram), "row long, first int, last int")
    ranges = stored(reduce(DataFrame.unionByName, whole, partly).groupBy(F.col("row").alias("_dw_r"))
                    .agg(F.collect_set(F.struct("first", "last")).alias("_dw_ranges")), "repeat-ranges")

    keep = [c for c in keep if c not in ("n_bytes", "spans", "kept")]
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_bytes", T.LongType()), T.StructField("spans", SPANS), T.StructField("kept", T.BinaryType())])
    every = docs.select(*[F.col(f"`{c}`") for c in keep], t.alias("_dw_text"), row.alias("_dw_row"))
    every = maybe_in(every, F.col("_dw_row"), ranges, "_dw_r")
    same = every.where("not _dw_hit").select(*[F.col(f"`{c}`") for c in keep], F.octet_length("_dw_text").cast("long").alias("n_bytes"),
                                    F.array().cast(SPANS).alias("spans"), F.encode("_dw_text", "UTF-8").alias("kept"))
    cut = every.where("_dw_hit").join(ranges, F.col("_dw_row") == F.col("_dw_r"), "left") \
        .select(*[F.col(f"`{c}`") for c in keep], "_dw_text", "_dw_ranges").mapInArrow(_cut(keep, schema, length), schema)
    return same.unionByName(cut)
