"""Suffix-array removal of repeated byte strings across documents.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller id.
Comparing all suffixes of a corpus would move it many times over, so suffixes are sorted where they can
matter:

1. Documents are dealt to chunks. In every window of LENGTH bytes the k-gram with the least hash is the
   window's anchor, so equal windows have equal anchors at equal places. A chunk sends each distinct
   anchor hash (five bytes) once to a bucket; buckets answer which hashes other chunks have as well.
2. Each chunk sends the contexts of its shared anchors, equal ones once, with the least and greatest
   document id. A bucket sorts them, and then the suffixes of different contexts of one anchor, in deep-shallow
   manner: multikey quicksort over the first words, then a blind trie for each group that still agrees. Runs of
   suffixes that agree in LENGTH bytes share their least document id, which goes back to the chunks.
3. Each chunk marks the windows whose least id is smaller than the document's own.

An anchor that is frequent in many chunks (a common line has another context at each occurrence) is hot: its
contexts are not sent to one bucket. Each chunk sends the hashes of their windows, equal ones once, to buckets by
the window's hash, so equal windows still meet, and what meets in a bucket is bounded by the number of chunks for
each window. A hot anchor's windows count as equal where anchor key and 64-bit window hash agree; all others are
compared byte by byte. A reply finds its contexts by the anchor's key and XXH3 of the context (over 100 bits together).

All three steps read one shuffle of the texts.

Edge cases: NULL text is empty; texts under LENGTH bytes lose nothing; a very long text is one chunk's; rows with
a NULL id come after all others, and rows with the same id never count as earlier than each other (repeated rows
keep what they share); an empty table gives an empty result. Other columns are not read by ``repeated_spans`` and
may have any name; ``remove_repeats`` keeps them.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import all_nullable, release, small_batches, table

LENGTH, GRAM = 50, 20
#: Bytes of text in a chunk on average, bytes of anchor hashes in a bucket.
CHUNK_BYTES, BUCKET_BYTES = 4_000_000, 8_000_000
#: An anchor is hot where HEAVY or more of its places lie in each of HEAVY_CHUNKS chunks, or where MANY_CHUNKS chunks have it.
HEAVY, HEAVY_CHUNKS, MANY_CHUNKS = 16, 16, 2048
#: Eight-byte words that multikey quicksort looks at before blind tries take over.
SHALLOW_WORDS = 3
#: Suffixes that a bucket sorts at once, where no single anchor has more.
STEP = 60_000
LAST = 2**63 - 1
_RNG = np.random.default_rng(20)
_MIX = [np.uint64(int(x) | 1) for x in _RNG.integers(1, 2**63, 2)]
_TURN = [np.uint32(int(x) | 1) for x in _RNG.integers(1, 2**32, 4)]
_CODEC = pa.Codec("zstd", compression_level=1)


def _pack(a: np.ndarray) -> bytes:
    """Array to compressed bytes, its length in front."""
    raw = np.ascontiguousarray(a).tobytes()
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def _unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(_CODEC.decompress(data[8:], int.from_bytes(data[:8], "little")), dtype)


# ---- anchors ----------------------------------------------------------------------------------------


def _gram_order(data: np.ndarray, k: int) -> np.ndarray:
    """A number for the k bytes (four or more) from each place, by doubling: the same for the same bytes, else as good as random; never zero."""
    word = np.ndarray(len(data) - 3, "<u4", data, strides=(1,))
    part, size, n = (word ^ word >> np.uint32(15)) * _TURN[0], 4, len(data) - k + 1
    while size * 2 <= k:
        low, high = part[: len(part) - size] * _TURN[1], part[size:]
        part, size = low + (high ^ high >> np.uint32(13)), size * 2
    if size < k:
        rest = part[k - size :]
        part = part[:n] * _TURN[2] + (rest ^ rest >> np.uint32(11))
    part = (part ^ part >> np.uint32(16)) * _TURN[3]
    return (part ^ part >> np.uint32(15)) | np.uint32(1)


def _gram_hashes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes."""
    words = -(-rows.shape[1] // 8)
    padded = np.zeros((len(rows), words * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    out = np.zeros(len(rows), np.uint64)
    for word in padded.view("<u8").astype(np.uint64, copy=False).T:
        out = (out ^ word) * _MIX[0]
        out = (out ^ out >> np.uint64(32)) * _MIX[1]
        out ^= out >> np.uint64(29)
    return out


def _sliding(a: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each window of width."""
    size = 1
    while size * 2 <= width:
        a = pick(a[: len(a) - size], a[size:])
        size *= 2
    return pick(a[: len(a) - (width - size)], a[width - size :]) if size < width else a


class Chunk:
    """The documents of one chunk as one byte array, and their anchors."""

    def __init__(self, docs: pa.Table, length: int, gram: int):
        self.length, self.gram, self.width = length, gram, length - gram + 1
        self.ids = docs["doc_id"].to_numpy()
        text = docs["text"].cast(pa.large_binary()).combine_chunks()
        edges = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        self.data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]] if len(text) else np.empty(0, np.uint8)
        self.starts, self.ends = edges[:-1] - edges[0], edges[1:] - edges[0]
        self.valid = np.ones(len(self.data), bool)
        for a, b in zip(np.maximum(self.starts, self.ends - length + 1).tolist(), self.ends.tolist()):
            self.valid[a:b] = False
        self.least = np.zeros(len(self.data), np.uint32)
        self.places, self.order = self._anchors()
        self.hashes = _gram_hashes(_at(self.data, gram, self.places))

    def _anchors(self, block: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
        """Anchors and their grams' numbers; ``least`` has that of the anchor of each window."""
        w, n, places, orders = self.width, len(self.data), [], []
        for i in range(0, n, block):
            low, high = max(0, i - w + 1), min(n, i + block + self.length + w)
            if high - low < self.length:
                break
            h = _gram_order(self.data[low:high], self.gram)
            least = _sliding(h, w, np.minimum) * self.valid[low : low + len(h) - w + 1]
            self.least[low : low + len(least)] = least
            edge = np.zeros(w - 1, np.uint32)
            most = _sliding(np.concatenate([edge, least, edge]), w, np.maximum)
            at = np.flatnonzero(h == most)
            at = at[(at + low >= i) & (at + low < i + block)]
            places.append(at + low)
            orders.append(h[at])
        return (np.concatenate(places), np.concatenate(orders)) if places else (np.empty(0, np.int64), np.empty(0, np.uint32))

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        """The document number at each place."""
        return np.searchsorted(self.ends, places, side="right")

    def contexts(self, anchors: np.ndarray) -> np.ndarray:
        """A row for each of these anchors (by number): its bytes from width-1 before to length after, where a window that it
        anchors lies (zero elsewhere), then the least and greatest distance from such a window's start to the anchor."""
        w, size = self.width, self.width - 1 + self.length
        reach = w - 1
        padded = np.concatenate([np.zeros(reach, np.uint8), self.data, np.zeros(self.length, np.uint8)])
        least = np.concatenate([np.zeros(reach, np.uint32), self.least])
        inside = np.arange(size, dtype=np.uint8)
        out = np.empty((len(anchors), size + 2), np.uint8)
        for i in range(0, len(anchors), 8192):
            some = anchors[i : i + 8192]
            p = self.places[some]
            mine = _at(least, w, p) == self.order[some][:, None]  # window starts p-reach .. p
            far = (reach - mine.argmax(axis=1)).astype(np.uint8)
            near = mine[:, ::-1].argmax(axis=1).astype(np.uint8)
            held = (inside >= (reach - far)[:, None]) & (inside < (reach - near + self.length)[:, None])
            np.multiply(_at(padded, size, p), held, out=out[i : i + 8192, :-2])
            out[i : i + 8192, -2], out[i : i + 8192, -1] = near, far
        return out


def _at(a: np.ndarray, width: int, places: np.ndarray) -> np.ndarray:
    """A row of ``width`` elements from each place."""
    if not len(places):
        return np.empty((0, width), a.dtype)
    return np.lib.stride_tricks.as_strided(a, (len(a) - width + 1, width), (a.itemsize, a.itemsize))[places]


def _strings(rows: np.ndarray) -> list[bytes]:
    """Each row of bytes."""
    return np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel().tolist()


def context_keys(rows: np.ndarray) -> np.ndarray:
    """XXH3 of each row of bytes."""
    out = np.empty(len(rows), np.uint64)
    for i in range(0, len(rows), 1 << 16):
        some = _strings(rows[i : i + (1 << 16)])
        out[i : i + (1 << 16)] = np.fromiter(map(xxhash.xxh3_64_intdigest, some, repeat(50)), np.uint64, len(some))
    return out


def _begins(*keys: np.ndarray) -> np.ndarray:
    """Where runs begin in sorted keys."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _by_both(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """An order by first, then second; only where first is equal, second is looked at."""
    order = np.argsort(first)
    begin = _begins(first[order])
    tied = np.repeat(_lengths(begin, len(order)) > 1, _lengths(begin, len(order)))
    some = order[tied]
    order[tied] = some[np.lexsort((second[some], first[some]))]
    return order


def _lengths(begins: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(begins, n))


def _ranges(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... size-1 for each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def windows(rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context row, distance from its start to the anchor, hash) for each window that the context rows' anchors anchor."""
    reach = rows.shape[1] - 2 - length
    near, far = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    counts = far - near + 1
    owner = np.repeat(np.arange(len(rows)), counts)
    distance = near[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    flat, hashes = rows.ravel(), np.empty(len(owner), np.uint64)
    for i in range(0, len(owner), 1 << 16):
        o, d = owner[i : i + (1 << 16)], distance[i : i + (1 << 16)]
        hashes[i : i + (1 << 16)] = context_keys(_at(flat, length, o * rows.shape[1] + reach - d))
    return owner, distance, hashes


# ---- deep-shallow suffix sorting --------------------------------------------------------------------


class BlindTrie:
    """Strings of one length by the places where they branch; only a leaf's string is ever compared in full."""

    def __init__(self, first: bytes, number: int):
        self.root = [first, [number]]  # a leaf: [string, numbers]; a branch: (place, {byte: node})
        self.leaves = {first: self.root[1]}  # strings that are held already are not looked for

    def add(self, s: bytes, number: int) -> None:
        held = self.leaves.setdefault(s, mine := [number])
        if held is not mine:
            held.append(number)
            return
        node = self.root
        while type(node) is tuple:  # blind: any leaf below agrees up to where it must differ
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = node[0]
        at = len(s) - ((int.from_bytes(s) ^ int.from_bytes(other)).bit_length() + 7 >> 3)  # the first byte that differs
        above, key, node = None, None, self.root
        while type(node) is tuple and node[0] < at:
            above, key, node = node, s[node[0]], node[1][s[node[0]]]
        if type(node) is tuple and node[0] == at:
            node[1][s[at]] = [s, mine]
            return
        branch = (at, {s[at]: [s, mine], other[at]: node})
        if above is None:
            self.root = branch
        else:
            above[1][key] = branch

    def groups(self):
        """Equal strings' numbers, in the strings' order."""
        todo = [self.root]
        while todo:
            node = todo.pop()
            if type(node) is tuple:
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node[1]


def _partition(order: np.ndarray, words: np.ndarray, start: np.ndarray, size: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One step of multikey quicksort on all given segments of ``order`` at once: each is split by its pivot's word
    at its depth. The parts below and above stay at that depth, the equal part goes one word deeper."""
    segment, at = np.repeat(np.arange(len(start)), size), np.repeat(start, size) + _ranges(size)
    value = words[order[at], depth[segment]]
    first = np.cumsum(size) - size
    three = np.stack([value[first], value[first + size // 2], value[first + size - 1]])
    pivot = np.maximum(np.minimum(three[0], three[1]), np.minimum(np.maximum(three[0], three[1]), three[2]))  # their median
    side = (value > pivot[segment]).astype(np.int8) + (value >= pivot[segment])
    moved, counts, below = np.empty(len(at), np.int64), [], np.zeros(len(start), np.int64)
    for part in range(3):
        mine = side == part
        seen = np.cumsum(mine)
        count = np.add.reduceat(mine.astype(np.int64), first)
        moved[mine] = (start + below - seen[first] + mine[first])[segment[mine]] + seen[mine] - 1
        counts.append(count)
        below = below + count
    order[moved] = order[at].copy()
    starts = np.concatenate([start, start + counts[0], start + counts[0] + counts[1]])
    return starts, np.concatenate(counts), np.concatenate([depth, depth + 1, depth])


def sort_suffixes(rows: np.ndarray, shallow: int = SHALLOW_WORDS, groups: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, run): order sorts the byte rows; run numbers the rows, in that order, by the place where their run of equal rows begins.

    Multikey quicksort on eight-byte words splits all segments of a depth at once, three ways by each one's pivot,
    down to ``shallow`` words. What still agrees there is ordered by a blind trie; tries of one leaf alone and of two
    strings are made for all groups together. With ``groups`` (ascending) only rows of one group are compared.
    """
    n, length = rows.shape
    shallow = min(shallow, -(-length // 8))
    padded = np.zeros((n, -(-length // 8) * 8), np.uint8)
    padded[:, :length] = rows
    words, beyond = padded.view(">u8")[:, :shallow].astype(np.uint64), padded.view(np.uint64)[:, shallow:]
    order, run, deep = np.arange(n), np.arange(n), [np.empty((2, 0), np.int64)]
    start = np.zeros(min(n, 1), np.int64) if groups is None else _begins(groups)
    size, depth = _lengths(start, n), np.zeros(len(start), np.int64)
    while True:
        tied = size > 1
        done = tied & (depth == shallow)
        deep.append(np.stack([start[done], size[done]]))
        start, size, depth = start[tied & ~done], size[tied & ~done], depth[tied & ~done]
        if not len(start):
            break
        start, size, depth = _partition(order, words, start, size, depth)
    start, size = np.concatenate(deep, axis=1)
    rest = rows[:, min(8 * shallow, length) :]
    differ = np.zeros(len(start), bool)
    segment = np.repeat(np.arange(len(start)), size)
    at, first = np.repeat(start, size) + _ranges(size), np.repeat(start, size)
    for i in range(0, len(at), 1 << 15):
        part = slice(i, i + (1 << 15))
        differ[segment[part][(beyond[order[at[part]]] != beyond[order[first[part]]]).any(axis=1)]] = True
    leaf = np.repeat(~differ, size)
    run[at[leaf]] = first[leaf]
    two = start[differ & (size == 2)]
    if len(two):
        a, b = rest[order[two]], rest[order[two + 1]]
        place = (a != b).argmax(axis=1)
        turn = two[a[np.arange(len(two)), place] > b[np.arange(len(two)), place]]
        order[turn], order[turn + 1] = order[turn + 1], order[turn]
    many = differ & (size > 2)
    for i in range(0, int(many.sum()), 1 << 12):
        first, count = start[many][i : i + (1 << 12)], size[many][i : i + (1 << 12)]
        at = np.repeat(first, count) + _ranges(count)
        mine, strings, sorted_, runs, done = order[at], _strings(rest[order[at]]), [], [], 0
        for a, k in zip(first.tolist(), count.tolist()):
            trie = BlindTrie(strings[done], done)
            for j in range(done + 1, done + k):
                trie.add(strings[j], j)
            done += k
            for same in trie.groups():
                sorted_ += same
                runs += [a] * len(same)
                a += len(same)
        order[at], run[at] = mine[sorted_], runs
    return order, run


def _least(order: np.ndarray, run: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of its run, run's least id) for each row."""
    begin = _begins(run)
    number = np.empty(len(order), np.int64)
    number[order] = np.repeat(np.arange(len(begin)), _lengths(begin, len(run)))
    least = np.minimum.reduceat(ids[order], begin) if len(begin) else np.empty(0, np.int64)
    return number, least


def least_ids(rows: np.ndarray, keys: np.ndarray, ids: np.ndarray, length: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, near, far, id) arrays: the windows of context row ``row`` at distances near..far from the anchor, whose
    key is keys[row], have least document id ``id``."""
    if not len(rows):
        return (np.empty(0, np.int64),) * 4
    reach = rows.shape[1] - 2 - length
    by_key = np.argsort(keys, kind="stable")
    rows, keys, ids = rows[by_key], keys[by_key], ids[by_key]
    flat = rows.ravel()
    begin = _begins(keys)
    anchor = np.repeat(np.arange(len(begin)), _lengths(begin, len(keys)))
    order, run = sort_suffixes(rows, groups=keys)
    context, least = _least(order, run, ids)
    one = order[_begins(run)]  # a row of each different context; contexts of one anchor follow each other
    many = np.bincount(anchor[one], minlength=anchor[-1] + 1)
    near, far = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    alone = many[anchor] == 1
    found = [(by_key[alone], near[alone], far[alone], least[context[alone]])]
    # different contexts of one anchor: their windows of one distance from it are sorted against each other
    mixed = np.flatnonzero(many[anchor[one]] > 1)
    told = [np.empty((4, 0), np.int64)]
    cuts = np.append(_begins(anchor[one[mixed]]), len(mixed))
    edges = np.append(0, np.cumsum(far[one[mixed]] - near[one[mixed]] + 1))[cuts]
    i = 0
    while i < len(cuts) - 1:
        j = max(i + 1, int(np.searchsorted(edges, edges[i] + step, side="right")) - 1)
        part = mixed[cuts[i] : cuts[j]]
        i = j
        row = one[part]
        sizes = far[row] - near[row] + 1
        owner, distance = np.repeat(part, sizes), np.repeat(near[row], sizes) + _ranges(sizes)
        place = np.repeat(anchor[row], sizes) * (reach + 1) + distance
        by = np.argsort(place, kind="stable")
        owner, distance, place = owner[by], distance[by], place[by]
        suffixes = _at(flat, length, one[owner] * rows.shape[1] + reach - distance)
        number, low = _least(*sort_suffixes(suffixes, groups=place), least[owner])
        back = np.lexsort((distance, owner))
        owner, distance, low = owner[back], distance[back], low[number[back]]
        begin = _begins(owner, low)
        told.append(np.stack([owner[begin], distance[begin], distance[begin + _lengths(begin, len(owner)) - 1], low[begin]]))
    told = np.concatenate(told, axis=1)
    row = np.flatnonzero(~alone)
    a, b = np.searchsorted(told[0], context[row]), np.searchsorted(told[0], context[row], side="right")
    answer = told[:, np.repeat(a, b - a) + _ranges(b - a)]
    found.append((by_key[np.repeat(row, b - a)], *answer[1:]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _texts(data: np.ndarray, ends: np.ndarray, most: int = 1 << 30) -> pa.ChunkedArray:
    """Binary values, one after the other in data, that end at ends; in arrays whose last values begin before the next ``most`` bytes."""
    starts, arrays = np.append(0, ends[:-1]), []
    cuts = np.append(_begins(starts // most), len(ends))
    for i, j in zip(cuts, cuts[1:]):
        offsets = np.append(starts[i:j], ends[j - 1]) - starts[i]
        arrays.append(pa.Array.from_buffers(pa.binary(), int(j - i), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[starts[i] : ends[j - 1]])]))
    return pa.chunked_array(arrays, pa.binary())


# ---- the three steps --------------------------------------------------------------------------------

_SHORT = np.dtype("<u8")


def _dealt(keys: np.ndarray, buckets: int):
    """(bucket, places of its keys) for keys dealt by remainder."""
    b = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], b[order][1:] != b[order][:-1], [True]])) if len(order) else np.array([0])
    for i, j in zip(cuts, cuts[1:]):
        yield int(b[order[i]]), order[i:j]


def _packed(rows: np.ndarray, key: str, buckets: int, hot: bool) -> list[tuple[int, bool, bytes]]:
    """(bucket, hot, its rows) for rows dealt by a key; the rows are copied once, however many buckets there are."""
    return [(b, hot, _pack(rows[i])) for b, i in _dealt(rows[key], buckets)]


def _five(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def repeated_spans(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, keep: list[str] | None = None, heavy: int = HEAVY, heavy_chunks: int = HEAVY_CHUNKS, many_chunks: int = MANY_CHUNKS) -> DataFrame:
    """One row for each row of df: row (a struct of the ``keep`` columns, the id by default), n_bytes, spans (array of start and end, in bytes) and kept (the remaining bytes)."""
    small_batches(df.sparkSession)
    gram = GRAM
    kept = df.select(*[F.col(f"`{c}`") for c in ([id_col] if keep is None else keep)])
    row = F.struct(*[F.col(f"`{c}`") for c in kept.columns]).cast(all_nullable(kept.schema))
    docs = df.select(row.alias("row"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    total = docs.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    chunks = int(max(1, total // chunk_bytes))
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(chunks)).cast("int"))
    # few chunks: a bucket for each; a large corpus: as its anchors (about a sixteenth of the places, five bytes each) need
    buckets = min(chunks, max(512, total * 5 // 16 // BUCKET_BYTES))
    # so many bits of the hash that, without the part that names the bucket, five bytes hold them
    key = lambda h: h >> np.uint64(64 - 40 - buckets.bit_length() + 1)

    def anchors(docs: pa.Table) -> pa.Table:
        release()
        chunk = docs["chunk"][0].as_py()
        keys, places = np.unique(key(Chunk(docs, length, gram).hashes), return_counts=True)
        out = [(b, often, _five(some[at] // np.uint64(buckets))) for often, some in ((False, keys[places < heavy]), (True, keys[places >= heavy])) for b, at in _dealt(some, buckets)]
        return pa.table({"bucket": pa.array([b for b, _, _ in out], pa.int32()), "chunk": pa.array([chunk] * len(out), pa.int32()), "often": pa.array([o for _, o, _ in out], pa.bool_()), "data": pa.array([d for _, _, d in out], pa.binary())})

    def shared(sent: pa.Table) -> pa.Table:
        release()
        bucket, parts = sent["bucket"][0].as_py(), [_from_five(d.as_py()) for d in sent["data"]]
        sizes = [len(p) for p in parts]
        keys, chunk, often = np.concatenate(parts), np.repeat(sent["chunk"].to_numpy(), sizes), np.repeat(np.array(sent["often"].to_pylist(), bool), sizes)
        order = np.argsort(keys, kind="stable")
        keys, chunk, often = keys[order], chunk[order], often[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        size = np.diff(np.append(begin, len(keys)))
        hot = (size > 1) & ((np.add.reduceat(often.astype(np.int64), begin) >= heavy_chunks) | (size >= many_chunks)) if len(keys) else np.empty(0, bool)
        many, hot = np.repeat(size > 1, size), np.repeat(hot, size)
        keys, chunk, hot = keys[many] * np.uint64(buckets) + np.uint64(bucket), chunk[many], hot[many]
        rows = []
        for flag in (False, True):
            k, c = keys[hot == flag], chunk[hot == flag]
            order = np.argsort(c, kind="stable")
            k, c = k[order], c[order]
            cuts = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1], [True]])) if len(c) else np.array([0])
            rows += [(int(c[i]), flag, _pack(k[i:j])) for i, j in zip(cuts, cuts[1:])]
        return pa.table({"chunk": pa.array([c for c, _, _ in rows], pa.int32()), "hot": pa.array([h for _, h, _ in rows], pa.bool_()), "data": pa.array([d for _, _, d in rows], pa.binary())})

    width = 2 * length - gram + 2
    sent_row = np.dtype([("key", "<u8"), ("least", "<i8"), ("most", "<i8"), ("row", "u1", (width,))])
    window_row = np.dtype([("key", "<u8"), ("window", "<u8"), ("least", "<i8"), ("most", "<i8")])
    window_reply = np.dtype([("key", "<u8"), ("window", "<u8"), ("id", "<i8")])
    reply_row = np.dtype([("key", "<u8"), ("context", "<u8"), ("id", "<i8"), ("near", "u1"), ("far", "u1")])

    def contexts(docs: pa.Table, told: pa.Table) -> pa.Table:
        release()
        if not docs.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int32()), "hot": pa.array([], pa.bool_()), "data": pa.array([], pa.binary())})
        c, number = Chunk(docs, length, gram), docs["chunk"][0].as_py()
        keys, doc = key(c.hashes), c.ids[c.doc_of(c.places)]
        suspect = np.zeros(len(keys), bool)
        order = np.argsort(keys)
        if len(order):
            begin = _begins(keys[order])
            one = keys[order][begin]
            least, most = np.minimum.reduceat(doc[order], begin), np.maximum.reduceat(doc[order], begin)
            wanted = least != most  # anchors of several documents of this chunk
            if told.num_rows:
                known = np.sort(np.concatenate([_unpack(d.as_py(), "<u8") for d in told["data"]]))
                wanted |= known[np.minimum(np.searchsorted(known, one), len(known) - 1)] == one
            suspect[order] = np.repeat(wanted, _lengths(begin, len(order)))
        at = np.flatnonzero(suspect)
        rows = c.contexts(at)
        same = context_keys(rows)
        order = _by_both(keys[at], same)
        at = at[order]
        begin = _begins(keys[at], same[order])
        out = np.zeros(len(begin), sent_row)
        out["key"], out["row"] = keys[at][begin], rows[order[begin]]
        if len(begin):
            out["least"], out["most"] = np.minimum.reduceat(doc[at], begin), np.maximum.reduceat(doc[at], begin)
        del rows
        said = [_unpack(d.as_py(), "<u8") for d, h in zip(told["data"], told["hot"].to_pylist()) if h]
        hot = np.isin(out["key"], np.concatenate(said)) if said else np.zeros(len(out), bool)
        sent = _packed(out[~hot], "key", buckets, False)
        if hot.any():
            some = out[hot]
            owner, _, hashes = windows(some["row"], length)
            order = np.lexsort((hashes, some["key"][owner]))
            owner, hashes, keys = owner[order], hashes[order], some["key"][owner[order]]
            begin = _begins(keys, hashes)
            w = np.zeros(len(begin), window_row)
            w["key"], w["window"] = keys[begin], hashes[begin]
            w["least"], w["most"] = np.minimum.reduceat(some["least"][owner], begin), np.maximum.reduceat(some["most"][owner], begin)
            sent += _packed(w, "window", buckets, True)
        return pa.table({"bucket": pa.array([b for b, _, _ in sent], pa.int32()), "chunk": pa.array([number] * len(sent), pa.int32()), "hot": pa.array([h for _, h, _ in sent], pa.bool_()), "data": pa.array([d for _, _, d in sent], pa.binary())})

    def by_target(out: np.ndarray, to: np.ndarray, hot: bool) -> pa.Table:
        order = np.argsort(to, kind="stable")
        to = to[order]
        cuts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]])) if len(to) else np.array([0])
        replies = [(int(to[i]), _pack(out[order[i:j]])) for i, j in zip(cuts, cuts[1:])]
        return pa.table({"chunk": pa.array([c for c, _ in replies], pa.int32()), "hot": pa.array([hot] * len(replies), pa.bool_()), "data": pa.array([d for _, d in replies], pa.binary())})

    def equal_windows(sent: pa.Table) -> pa.Table:
        parts = [_unpack(d.as_py(), window_row) for d in sent["data"]]
        rows, chunk = np.concatenate(parts), np.repeat(sent["chunk"].to_numpy(), [len(p) for p in parts])
        order = np.lexsort((rows["window"], rows["key"]))
        rows, chunk = rows[order], chunk[order]
        begin = np.flatnonzero(np.concatenate([[True], (rows["key"][1:] != rows["key"][:-1]) | (rows["window"][1:] != rows["window"][:-1])]))
        least = np.repeat(np.minimum.reduceat(rows["least"], begin), np.diff(np.append(begin, len(rows))))
        told = least < rows["most"]
        out = np.zeros(int(told.sum()), window_reply)
        out["key"], out["window"], out["id"] = rows["key"][told], rows["window"][told], least[told]
        return by_target(out, chunk[told], True)

    def sorted_runs(sent: pa.Table) -> pa.Table:
        release()
        hot = sent["hot"].combine_chunks()
        out = [equal_windows(sent.filter(hot))] if pa.compute.any(hot).as_py() else []
        sent = sent.filter(pa.compute.invert(hot))
        if not sent.num_rows:
            return out[0]
        parts = [_unpack(d.as_py(), sent_row) for d in sent["data"]]
        rows, chunk = np.concatenate(parts), np.repeat(sent["chunk"].to_numpy(), [len(p) for p in parts])
        del parts
        at, near, far, least = least_ids(rows["row"], rows["key"], rows["least"], length)
        told = least < rows["most"][at]
        at = at[told]
        reply = np.zeros(len(at), reply_row)
        reply["key"], reply["near"], reply["far"], reply["id"] = rows["key"][at], near[told], far[told], least[told]
        some, back = np.unique(at, return_inverse=True)
        reply["context"] = context_keys(rows["row"][some])[back]
        return pa.concat_tables([*out, by_target(reply, chunk[at], False)])

    def anchors_of(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
        return np.flatnonzero(known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys)

    def matches(values: np.ndarray, said: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray]:
        """(number of the value, reply) for all replies, sorted by ``name``, that a value has."""
        names = np.ascontiguousarray(said[name])
        low = np.searchsorted(names, values)
        high, there = low.copy(), names[np.minimum(low, len(names) - 1)] == values
        high[there] = np.searchsorted(names, values[there], side="right")
        mine = np.repeat(np.arange(len(values)), high - low)
        return mine, said[np.repeat(low, high - low) + np.arange(len(mine)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)]

    spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(docs: pa.Table, told: pa.Table) -> pa.Table:
        release()
        c = Chunk(docs, length, gram) if docs.num_rows else None
        removed = np.zeros(len(c.data) if c else 0, bool)
        if c and told.num_rows:
            edge, keys = np.zeros(len(c.data) + 1, np.int32), key(c.hashes)
            flags = told["hot"].to_pylist()
            parts = [_unpack(d.as_py(), reply_row) for d, h in zip(told["data"], flags) if not h]
            if parts:
                said = np.concatenate(parts)
                at = anchors_of(np.unique(said["key"]), keys)
                places = c.places[at]
                mine, reply = matches(context_keys(c.contexts(at)), said[np.argsort(said["context"], kind="stable")], "context")
                hit = (reply["id"] < c.ids[c.doc_of(places[mine])]) & (reply["key"] == keys[at][mine])
                place, reply = places[mine][hit], reply[hit]
                np.add.at(edge, place - reply["far"], 1)
                np.add.at(edge, place - reply["near"] + length, -1)
            parts = [_unpack(d.as_py(), window_reply) for d, h in zip(told["data"], flags) if h]
            if parts:
                said = np.concatenate(parts)
                said = said[np.argsort(said["window"], kind="stable")]
                at = anchors_of(np.unique(said["key"]), keys)
                at = at[np.argsort(keys[at], kind="stable")]
                for i in range(0, len(at), 8192):
                    some = at[i : i + 8192]
                    rows = c.contexts(some)
                    same = context_keys(rows)
                    order = _by_both(keys[some], same)  # windows of equal contexts are looked for once
                    begin = _begins(keys[some][order], same[order])
                    size = _lengths(begin, len(some))
                    owner, distance, hashes = windows(rows[order[begin]], length)
                    mine, reply = matches(hashes, said, "window")
                    hit = reply["key"] == keys[some][order[begin[owner[mine]]]]
                    one, least = mine[hit], np.repeat(reply["id"][hit], size[owner[mine[hit]]])
                    place = c.places[some][order[np.repeat(begin[owner[one]], size[owner[one]]) + _ranges(size[owner[one]])]]
                    start = (place - np.repeat(distance[one], size[owner[one]]))[least < c.ids[c.doc_of(place)]]
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + length, -1)
            removed = np.cumsum(edge[:-1], out=edge[:-1]) > 0
            del edge
        if not c:
            return pa.table({"row": docs["row"], "n_bytes": pa.array([], pa.int64()), "spans": pa.array([], spans_kind), "kept": pa.array([], pa.binary())})
        first = np.zeros(len(removed) + 1, bool)  # places where a document begins, and the end
        first[c.starts] = first[-1] = True
        start = np.flatnonzero(removed & (first[:-1] | ~np.append(False, removed)[:-1]))
        end = np.flatnonzero(removed & (first[1:] | ~np.append(removed, False)[1:])) + 1
        of = c.doc_of(start)
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=len(c.ends)))), pa.int32())
        spans = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(x - c.starts[of], pa.int64()) for x in (start, end)], fields=list(spans_kind.value_type)))
        sizes = c.ends - c.starts
        gone = np.bincount(of, end - start, len(sizes)).astype(np.int64)
        kept = _texts(c.data[~removed], np.cumsum(sizes - gone))
        return pa.table({"row": docs["row"], "n_bytes": pa.array(sizes, pa.int64()), "spans": spans, "kept": kept})

    by_chunk = lambda: dealt.groupBy("chunk")
    one = by_chunk().applyInArrow(anchors, "bucket int, chunk int, often boolean, data binary").groupBy("bucket").applyInArrow(shared, "chunk int, hot boolean, data binary")
    two = by_chunk().cogroup(one.groupBy("chunk")).applyInArrow(contexts, "bucket int, chunk int, hot boolean, data binary").groupBy("bucket").applyInArrow(sorted_runs, "chunk int, hot boolean, data binary")
    span = T.StructType().add("start", "long").add("end", "long")
    schema = T.StructType().add("row", all_nullable(kept.schema)).add("n_bytes", "long").add("spans", T.ArrayType(span)).add("kept", "binary")
    return by_chunk().cogroup(two.groupBy("chunk")).applyInArrow(cut, schema)


def remove_repeats(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with the repeated bytes taken out of its texts (a character cut in half becomes U+FFFD)."""
    others = [c for c in df.columns if c != text_col]
    cut = repeated_spans(df, length, id_col, text_col, keep=others)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return cut.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in df.columns])


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return spans.select("row.doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
