"""Byte-level BPE encoding and decoding of whole texts.

Text is split by the tokenizer's pattern; each piece (pre-token) is merged
on its own.  Merging uses a *hierarchical-bitmap rank queue*: one bucket per
merge rank holds the list positions whose pair has that rank, a two-level
bitmap tells which buckets are filled, and find-first-set walks it to the
lowest rank.  The pieces form a doubly linked list, so a merge touches two
neighbours only; entries whose pair has changed meanwhile are stale and are
skipped when they surface.  A pre-token of n bytes costs O(n log n) however
long it is (a rescan of all pairs after every merge would be quadratic).

Within one rank the leftmost pair merges first, so the ids equal those of
the reference encoder for rank files (lowest rank first, leftmost first).

Null text is encoded as empty text: no ids, decoded bytes empty.  Rows are
independent of each other: repeated rows give repeated results, an empty
table gives an empty result, and other input columns pass through untouched
unless they clash with an output name (the output wins).
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from driftwood.llm.arrowtext import slices_by_chars

# distinct stretches a worker keeps (twice: after a space, and others), and the text
# (in characters) that is cut and merged at a time
CACHE_ENTRIES = 200_000
CHARS_AT_A_TIME = 1_000_000

# The Unicode property White_Space, as a character class body.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes → rank from a rank file (base64 token, space, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _category_class(first: str) -> str:
    """Body of a character class of all code points whose category starts with ``first``."""
    out, start = [], None
    for cp in range(sys.maxunicode + 2):
        inside = cp <= sys.maxunicode and unicodedata.category(chr(cp))[0] == first
        if inside and start is None:
            start = cp
        elif not inside and start is not None:
            out.append(re.escape(chr(start)) if start == cp - 1
                       else f"{re.escape(chr(start))}-{re.escape(chr(cp - 1))}")
            start = None
    return "".join(out)


@lru_cache(maxsize=4)
def compile_pattern(pattern: str) -> re.Pattern:
    """The tokenizer's split pattern for Python's ``re``.

    ``\\p{L}``, ``\\p{N}`` and ``\\s`` are written out as character classes
    of the Unicode properties they stand for.
    """
    body = pattern
    for prop, cls in (("\\p{L}", _category_class("L")), ("\\p{N}", _category_class("N")),
                      ("\\s", WHITE_SPACE)):
        parts, inside, i = [], False, 0
        while i < len(body):
            if body.startswith(prop, i):
                parts.append(cls if inside else f"[{cls}]")
                i += len(prop)
                continue
            if body[i] == "\\":                      # an escaped character
                parts.append(body[i:i + 2])
                i += 2
                continue
            inside = body[i] == "[" or (inside and body[i] != "]")
            parts.append(body[i])
            i += 1
        # the negated white space of ``\S`` outside a class
        body = "".join(parts)
    return re.compile(body.replace("\\S", f"[^{WHITE_SPACE}]"))


def _sorted_distinct(x: np.ndarray) -> np.ndarray:
    """``np.unique`` without its cost for many small arrays."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


class RankQueueEncoder:
    """Merges pre-tokens by the hierarchical-bitmap rank queue.

    Many pre-tokens go through one queue together: they lie side by side in
    one linked list without a pair across their borders, so the merges of
    one never touch another, and a bucket is drained for all of them.  The
    list holds ids; the rank of two neighbours, which is the id they merge
    to, is looked up by both ids.

    Large buckets are drained with array operations, while many pre-tokens
    still wait for the frequent, low ranks.  Where a merge would lead to a rank
    not above its own (trained ranks hardly ever do), which has to go first,
    that bucket and all after it are drained entry by entry.
    """

    WORD = 256                                             # ranks per bitmap word
    BYTES = 250_000                                        # of pre-tokens that are merged at a time: 300 bytes of memory each
    MANY, LARGE, PATIENCE = 20_000, 24, 64                 # bytes, bucket entries, small buckets in a row

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = n = max(ranks.values(), default=0) + 1
        self.low = [0] * (-(-n // self.WORD))
        self.of_byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.of_bytes = np.full(1 << 16, -1, np.int64)     # rank of two single bytes
        self.merged: dict[int, int] = {}                   # rank of two ids, left * size + right
        for token, rank in ranks.items():
            if len(token) == 2:
                self.of_bytes[token[0] << 8 | token[1]] = rank
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i], -1), ranks.get(token[i:], -1)
                if left >= 0 and right >= 0:
                    self.merged[left * n + right] = rank
        keys = np.array(sorted(self.merged), np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.values = np.array([self.merged[k] for k in keys.tolist()] + [-1], np.int64)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token (none empty)."""
        ranks, out = self.ranks, []
        long = []                                          # pre-tokens that are no token themselves
        for piece in pieces:
            rank = ranks.get(piece, -1)
            out.append([rank])
            if rank < 0:
                long.append(len(out) - 1)
        ends = np.cumsum([len(pieces[i]) for i in long])
        start = 0
        while start < len(long):                           # runs of at most BYTES, or one longer pre-token
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + self.BYTES, side="right")))
            for i, ids in zip(long[start:stop], self._merge([pieces[i] for i in long[start:stop]])):
                out[i] = ids
            start = stop
        return out

    def _merge(self, pieces: list[bytes]) -> Iterator[list[int]]:
        get, width, size = self.merged.get, self.WORD, self.size
        raw = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        total = len(raw)
        ends = np.cumsum([len(p) for p in pieces])
        ranks = np.full(total, -1, np.int64)               # rank of (position, successor); -1: none
        ranks[:-1] = self.of_bytes[raw[:-1] << 8 | raw[1:]]
        ranks[ends - 1] = -1
        after, before = np.arange(1, total + 1), np.arange(-1, total - 1)
        after[ends - 1] = -1                               # no neighbours across pre-tokens
        before[ends[:-1]] = before[0] = -1
        # the bitmap words, one bit per filled word, and the buckets
        low, top, buckets = self.low, 0, {}
        filled = np.flatnonzero(ranks >= 0)
        top = self._fill(buckets, top, filled, ranks[filled])
        ids = self.of_byte[raw]
        if total >= self.MANY:
            top = self._drain_large(ids, ranks, after, before, buckets, top)
        buckets = {r: np.concatenate(parts).tolist() for r, parts in buckets.items()}
        ids, pair, after, before = ids.tolist(), ranks.tolist(), after.tolist(), before.tolist()

        while top:
            # find-first-set, level by level: the lowest filled rank
            w = (top & -top).bit_length() - 1
            word = low[w]
            rank = w * width + (word & -word).bit_length() - 1
            bucket = buckets.pop(rank)
            low[w] = word & (word - 1)
            if not low[w]:
                top ^= 1 << w
            bucket.sort()                                  # leftmost first within a pre-token
            row = rank * size
            for k, i in enumerate(bucket):
                if pair[i] != rank:                        # stale: this pair is gone
                    continue
                j = after[i]
                ids[i] = rank
                ids[j] = pair[j] = -1
                nxt = after[i] = after[j]
                lowest = rank
                r = -1
                if nxt >= 0:
                    before[nxt] = i
                    r = get(row + ids[nxt], -1)
                    if r >= 0:
                        if r in buckets:
                            buckets[r].append(i)
                        else:
                            buckets[r] = [i]
                            v = r // width
                            low[v] |= 1 << r % width
                            top |= 1 << v
                        if r <= lowest:
                            lowest = r - 1
                pair[i] = r
                prev = before[i]
                if prev >= 0:
                    r = get(ids[prev] * size + rank, -1)
                    if r >= 0 and r != pair[prev]:
                        if r in buckets:
                            buckets[r].append(prev)
                        else:
                            buckets[r] = [prev]
                            v = r // width
                            low[v] |= 1 << r % width
                            top |= 1 << v
                        if r <= lowest:
                            lowest = r - 1
                    pair[prev] = r
                if lowest < rank and k + 1 < len(bucket):
                    # a pair of this or a lower rank came up: the rest waits its turn
                    rest = bucket[k + 1:]
                    if rank in buckets:
                        buckets[rank] += rest
                    else:
                        buckets[rank] = rest
                        low[w] |= 1 << rank % width
                        top |= 1 << w
                    break
        left = np.array(ids, np.int64)
        kept = np.add.reduceat(left >= 0, np.concatenate([[0], ends[:-1]]), dtype=np.int64)
        left, at = left[left >= 0].tolist(), 0
        for n in kept.tolist():
            yield left[at:at + n]
            at += n


    def _fill(self, buckets: dict, top: int, places: np.ndarray, ranks: np.ndarray) -> int:
        """Put places into the buckets of their ranks; the new top bits."""
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()] if len(ranks) else []
        for r, s, e in zip(ranks[cuts].tolist(), cuts, cuts[1:] + [len(ranks)]):
            if r in buckets:
                buckets[r].append(places[s:e])
            else:
                buckets[r] = [places[s:e]]
                w = r // self.WORD
                self.low[w] |= 1 << r % self.WORD
                top |= 1 << w
        return top

    def _drain_large(self, ids, pair, after, before, buckets: dict, top: int) -> int:
        """Drain buckets, lowest rank first, until they have become small."""
        low, width, small = self.low, self.WORD, 0
        while top and small < self.PATIENCE:
            w = (top & -top).bit_length() - 1
            rank = w * width + (low[w] & -low[w]).bit_length() - 1
            low[w] &= low[w] - 1
            if not low[w]:
                top ^= 1 << w
            bucket = buckets.pop(rank)
            at = bucket[0] if len(bucket) == 1 else np.concatenate(bucket)
            small = small + 1 if len(at) < self.LARGE else 0
            at = at[pair[at] == rank]                      # the others are stale
            if not len(at):
                continue
            every = at = _sorted_distinct(at)              # leftmost first
            chained = np.flatnonzero(after[at[:-1]] == at[1:])
            if len(chained):                               # a run of one token: every other pair
                starts = np.ones(len(at), bool)
                starts[chained + 1] = False
                first = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            gone = after[at]
            ahead = after[gone]
            some = ahead >= 0
            was = ids[at], ids[gone], pair[gone]
            # a neighbour that this bucket merges, too, is met unmerged first
            early = self._ranks(rank, ids[ahead[some]])
            ids[at], ids[gone], pair[gone] = rank, -1, -1
            after[at] = ahead
            before[ahead[some]] = at[some]
            behind = before[at]
            changed = _sorted_distinct(np.concatenate([at, behind[behind >= 0]]))
            follows = after[changed]
            new = np.where(follows >= 0, self._ranks(ids[changed], ids[follows]), -1)
            if ((early >= 0) & (early <= rank)).any() or ((new >= 0) & (new <= rank)).any():
                ids[at], ids[gone], pair[gone] = was
                after[at] = gone
                before[ahead[some]] = gone[some]
                return self._fill(buckets, top, every, np.full(len(every), rank, np.int64))
            fresh = (new >= 0) & (new != pair[changed])
            pair[changed] = new
            top = self._fill(buckets, top, changed[fresh], new[fresh])
        return top

    def _ranks(self, left, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 for none."""
        keys = left * self.size + right
        found = np.searchsorted(self.keys, keys)
        return np.where(self.keys[found] == keys, self.values[found], -1)


# Pieces that begin and end where pre-tokens of a CUTTABLE pattern do.
_COARSE = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
_WHITE = re.compile(f"[{WHITE_SPACE}]")
# Fixed value: the pattern for which that is known; texts are cut for no other.
CUTTABLE = ("'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+",)


def _uncollected(method: Callable) -> Callable:
    """The cyclic garbage collector waits until the call is over: it would walk
    the remembered stretches again and again, and nothing here makes a cycle."""

    @wraps(method)
    def run(*args):
        was = gc.isenabled()
        gc.disable()
        try:
            return method(*args)
        finally:
            if was:
                gc.enable()

    return run


class Tokenizer:
    """Encoding and decoding of whole texts, or counting, with a bounded cache.

    A text is first cut into stretches without inner white space (with the
    single space before them): no pre-token crosses such a border.  Each
    distinct stretch is split by the tokenizer's pattern and merged once.
    Ids of a stretch are kept as decimal numbers joined by one space.

    Cutting at every space is enough where each space is followed by
    something else than white space; what lies between two spaces is kept as
    a whole, made of its stretches if it has line breaks inside.  Other texts
    are cut by a regular expression.  Texts are cut for the patterns
    ``CUTTABLE`` only; for another pattern a text is one stretch.
    """

    def __init__(self, rank_path: str, pattern: str):
        self.ranks = load_ranks(rank_path)
        self.split = compile_pattern(pattern).findall
        self.cuttable = pattern in CUTTABLE
        self.queue = RankQueueEncoder(self.ranks)
        self.raw = {r: b for b, r in self.ranks.items()}
        self.names = {r: str(r) for r in self.raw}
        self.known: dict[str, tuple[str, bytes]] = {}      # stretch → ids, decoded bytes
        self.spaced: dict[str, tuple[str, bytes] | None] = {}   # the same of what follows a space
        self.counts: dict[str, int] = {}                   # stretch → number of ids
        self.recent: list[str] = []
        self.recent_spaced: list[str] = []

    def stretches(self, text: str) -> list[str]:
        """Cut a text; the parts joined give the text."""
        return _COARSE.findall(text) if self.cuttable else [text] if text else []

    def _new(self, known: dict, stretches: set[str]) -> list[str]:
        """The stretches that ``known`` lacks.

        Once it holds ``CACHE_ENTRIES``, what one call adds is kept for that
        call only: the first, mostly frequent stretches stay.
        """
        if len(known) > CACHE_ENTRIES:
            for s in self.recent:
                known.pop(s, None)
        self.recent = list(stretches.difference(known))
        return self.recent

    def _pieces(self, new: list[str]) -> tuple[list[list[str]], dict[str, list[int]]]:
        """The pre-tokens of each stretch, and the ids of every distinct one, merged once."""
        cut = list(map(self.split, new))
        pieces = list(set().union(*cut))
        return cut, dict(zip(pieces, self.queue.encode([p.encode("utf-8", "replace") for p in pieces])))

    @_uncollected
    def count_tokens(self, texts: list[str]) -> list[int]:
        """Number of ids of each text."""
        cut = [self.stretches(t) for t in texts]
        counts = self.counts
        new = self._new(counts, set().union(*cut))
        pieces, ids = self._pieces(new)
        size = {p: len(x) for p, x in ids.items()}
        for s, got in zip(new, pieces):
            counts[s] = sum([size[p] for p in got])
        return [sum(map(counts.__getitem__, got)) for got in cut]

    def _joined(self, new: list[str]) -> Iterator[tuple[str, tuple[str, bytes]]]:
        """Each stretch with its ids joined by one space, and those ids decoded."""
        cut, spaced = list(map(self.split, new)), self.spaced
        pieces = set().union(*cut)
        of = {p: spaced.get(p[1:]) for p in pieces if p[0] == " "}      # merged with other stretches before
        todo = [p for p in pieces if of.get(p) is None]
        name, raw = self.names.__getitem__, self.raw.__getitem__
        for p, ids in zip(todo, self.queue.encode([p.encode("utf-8", "replace") for p in todo])):
            of[p] = (" ".join(map(name, ids)), b"".join(map(raw, ids)))
        for s, got in zip(new, cut):
            if len(got) == 1:
                yield s, of[got[0]]
            else:
                parts = [of[p] for p in got]
                yield s, (" ".join([x[0] for x in parts]), b"".join([x[1] for x in parts]))

    def _after_space(self, parts: set[str]) -> None:
        """Make known what follows a space; None if that space belongs elsewhere."""
        spaced = self.spaced
        if len(spaced) > CACHE_ENTRIES:
            for p in self.recent_spaced:
                spaced.pop(p, None)
        self.recent_spaced = list(parts.difference(spaced))
        plain, mixed = [], {}
        for p in self.recent_spaced:
            white = _WHITE.search(p)
            if white is None and p:
                plain.append(" " + p)
            elif not p or white.start() == 0:
                spaced[p] = None
            else:
                mixed[p] = _COARSE.findall(" " + p)
        for s, value in self._joined(plain):
            spaced[s[1:]] = value
        if mixed:
            self._make_known(set().union(*mixed.values()))
            for p, cut in mixed.items():
                got = [self.known[s] for s in cut]
                spaced[p] = (" ".join([g[0] for g in got]), b"".join([g[1] for g in got]))

    def _make_known(self, stretches: set[str]) -> None:
        known = self.known
        for s, value in self._joined(self._new(known, stretches)):
            known[s] = value

    @_uncollected
    def encode_joined(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """Per text: its ids joined by one space, and those ids decoded."""
        out: list = [None] * len(texts)
        if self.cuttable:
            cut = [t.split(" ") for t in texts]
            self._after_space(set().union(*[parts[1:] for parts in cut]))
            begins = [_COARSE.findall(parts[0]) for parts in cut]
            spaced = self.spaced
            after = [[spaced[p] for p in parts[1:]] for parts in cut]
            slow = [i for i, got in enumerate(after) if None in got]
        else:
            begins, after, slow = [[] for _ in texts], [], range(len(texts))
        whole = {i: self.stretches(texts[i]) for i in slow}
        self._make_known(set().union(*begins, *whole.values()))
        known = self.known
        for i in range(len(texts)):
            got = [known[s] for s in whole[i]] if i in whole else [known[s] for s in begins[i]] + after[i]
            out[i] = (" ".join([g[0] for g in got]), b"".join([g[1] for g in got]))
        return out

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.encode_joined([text])[0][0].split(" ") if x]

    def decode(self, ids) -> bytes:
        return b"".join([self.raw[i] for i in ids])


@lru_cache(maxsize=2)
def tokenizer(rank_path: str, pattern: str, use: str = "encode") -> Tokenizer:
    """One tokenizer per worker process, rank file and use."""
    return Tokenizer(rank_path, pattern)


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, text: str = "text",
                     keep=("doc_id",), with_ids: bool = True) -> DataFrame:
    """Ids, their digest and the digest of the decoded bytes for every text.

    Result: the columns ``keep`` of the input, ``n_tokens``, ``ids`` (array of
    int; only ``with_ids``), ``ids_sha256`` and ``decoded_sha256``.  The file
    at ``rank_path`` must be readable on the executors (installed there).
    """
    keep = [c for c in keep if c not in ("n_tokens", "ids", "ids_sha256", "decoded_sha256")]
    fields = [docs.schema[c] for c in keep]
    extra = [T.StructField("n_tokens", T.LongType())] + \
        ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []) + \
        [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(rank_path, pattern)
        for batch in batches:
            for part in slices_by_chars(batch, len(keep), CHARS_AT_A_TIME):
                counts, ids, id_sha, out_sha = [], [], [], []
                texts = [t or "" for t in part.column(len(keep)).to_pylist()]
                for joined, raw in tok.encode_joined(texts):
                    counts.append(joined.count(" ") + 1 if joined else 0)
                    if with_ids:
                        ids.append(np.fromstring(joined, np.int32, sep=" "))
                    id_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                    out_sha.append(hashlib.sha256(raw).hexdigest())
                cols = [part.column(i) for i in range(len(keep))] + [pa.array(counts, pa.int64())] + \
                    ([_id_lists(ids)] if with_ids else []) + \
                    [pa.array(id_sha, pa.string()), pa.array(out_sha, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=keep + [f.name for f in extra])

    return docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].alias("_dw_text")) \
        .mapInArrow(run, T.StructType(fields + extra))
