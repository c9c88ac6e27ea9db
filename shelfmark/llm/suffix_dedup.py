"""Removal of repeated 100-byte strings with a sparse, distributed suffix array and deep-shallow sorting.

Of each ``length``-byte window the last smallest ``GRAM``-byte hash is the anchor, so equal windows have equal anchors at the same place. Suffixes are
sorted only where an anchor starts, once forwards and once (reversed) backwards from it:

1. Tasks count their anchors; the counts meet in sections of a Bloom filter of fixed size. Anchors seen once are dropped where they are
   read. A full filter only passes more.
2. A passed anchor goes out with the bytes around it that its windows cover. Equal surroundings in one task go out once; the later ones
   are repeats already.
3. Anchors are dealt by hash. A task sorts the bytes after and before its anchors; from the common prefixes of neighbours it gets classes of
   equal prefixes for every length, so a window is a pair of classes, and all but the first of equal windows are repeats. Surroundings that
   repeated rows send from several tasks count once.
4. Anchors seen ``HOT`` times or more (second filter) skip step 3: their windows go out by a 128-bit hash each, and the first occurrence is a minimum that
   tasks reduce before the shuffle. So no task gathers the surroundings of a passage that very many documents hold.

Found spans return to their document, which loses the bytes that they cover.

Defined results: null and empty texts have no bytes. Documents come in the order of their id (a whole number; null first), rows that repeat an id in the
order of a hash of their text; rows that repeat id and text are one document and are cleaned alike. Removal may cut characters; what is left is
given as bytes. Other columns are carried or ignored as asked.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import places
from .common import in_scratch, parts, text_of
from .pieces import spread
from .rows import as_rows, field, row_type, slices
from .suffix_sort import sort_rows

LENGTH, GRAM = 100, 32
HOT = 1000
SHALLOW = 40
PIECE = 4 << 20
FLUSH = 1 << 19
CHUNK = 24 << 20
FILTER_WORDS = 1 << 20  # of 64 bits, so 8 MB a filter
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
LOW = np.uint64(0xFFFFFF)


def anchors(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``hash, place, first window, last window`` of each anchor of the texts that lie one after another in ``data``."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    load = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    m = len(data) - GRAM + 1
    h = np.zeros(m, np.uint64)
    for k in range(GRAM // 8):
        x = load[8 * k : 8 * k + m] * ODD[k]
        h ^= x ^ (x >> np.uint64(29))
        h *= ODD[(k + 1) % 4]
    h ^= h >> np.uint64(32)
    h *= ODD[1]
    h ^= h >> np.uint64(29)
    low = (h & ~LOW) | (LOW - np.arange(m, dtype=np.uint64))  # of equal hashes the last one is smallest
    span, reach = length - GRAM + 1, 1
    while 2 * reach <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[: n], low[span - reach : span - reach + n])
    at = (LOW - (low & LOW)).astype(np.int64)
    valid = np.zeros(n + 1, np.int8)
    some = ends - begins >= length
    valid[begins[some]] += 1
    np.add.at(valid, ends[some] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(valid[:n], dtype=np.int8))
    if not len(window):
        return anchors(data[:0], begins[:0], ends[:0], length)
    chosen = at[window]
    first = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)]))
    last = np.append(first[1:], len(window)) - 1
    place = chosen[first]
    return h[place], place, window[first], window[last]


def pieces_of(texts: list[bytes], length: int = LENGTH):
    """Texts joined to buffers of about ``PIECE`` bytes, long ones in overlapping pieces: buffer, begins, ends, text number and offset of each piece."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(len(text) - length + 1, 0), PIECE):
            piece = text[start : start + PIECE + length - 1]
            held.append((i, start, piece))
            size += len(piece)
            if size >= PIECE:
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def joined(held):
    sizes = np.array([len(p) for _, _, p in held], np.int64)
    ends = np.cumsum(sizes)
    return np.frombuffer(b"".join(p for _, _, p in held), np.uint8), ends - sizes, ends, np.array([i for i, _, _ in held]), np.array([s for _, s, _ in held], np.int64)


def passes(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    at, mask = places(h, len(words))
    return words[at] & mask == mask


def section_bits(words: int, sections: int) -> int:
    return (words // sections).bit_length() - 1


def repeated_anchors(texts: DataFrame, text_col: str, length: int, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Bloom filters of the anchors that occur twice or more, and of those that occur ``hot`` times or more."""
    sections = 256
    while sections < 2 * parts(texts.sparkSession) and sections < FILTER_WORDS:
        sections *= 2
    shift = section_bits(FILTER_WORDS, sections)

    def count(batches):
        held, size = [], 0

        def rows():
            h, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, int))
            section = places(h, FILTER_WORDS)[0] >> shift
            order = np.argsort(section, kind="stable")
            h, n, section = h[order], np.minimum(n[order], 65535).astype(np.uint16), section[order]
            cuts = np.flatnonzero(np.concatenate([[True], section[1:] != section[:-1]])) if len(h) else np.zeros(0, int)
            edges = np.append(cuts, len(h))
            pick = lambda a: pa.array([a[x:y].tobytes() for x, y in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(section[cuts].astype(np.int64)), pick(h), pick(n)], ["section", "h", "n"])

        for _, own in slices(batches, text_col):
            for data, begins, ends, _, _ in pieces_of(own.to_pylist(), length):
                h = anchors(data, begins, ends, length)[0]
                held.append(h)
                size += len(h)
                if size > FLUSH:
                    yield rows()
                    held, size = [], 0
        yield rows()

    def total(table: pa.Table) -> pa.Table:
        h = np.frombuffer(b"".join(table["h"].to_pylist()), np.uint64)
        n = np.frombuffer(b"".join(table["n"].to_pylist()), np.uint16)
        own, which = np.unique(h, return_inverse=True)
        sums = np.bincount(which, n, len(own))
        start = table["section"][0].as_py() << shift
        out = []
        for least in (2, hot):
            words = np.zeros(1 << shift, np.uint64)
            at, mask = places(own[sums >= least], FILTER_WORDS)
            np.bitwise_or.at(words, at - start, mask)
            out.append(words.tobytes())
        return pa.table({"start": [start], "twice": pa.array([out[0]], pa.binary()), "hot": pa.array([out[1]], pa.binary())})

    counted = as_rows(texts, [text_col]).mapInArrow(count, "section bigint, h binary, n binary")
    twice, often = np.zeros(FILTER_WORDS, np.uint64), np.zeros(FILTER_WORDS, np.uint64)
    for r in counted.groupBy("section").applyInArrow(total, "start bigint, twice binary, hot binary").toLocalIterator():
        twice[r.start : r.start + (1 << shift)] = np.frombuffer(r.twice, np.uint64)
        often[r.start : r.start + (1 << shift)] = np.frombuffer(r.hot, np.uint64)
    return twice, often


SENT = "kind int, key bigint, key2 bigint, id bigint, t bigint, at bigint, room int, bytes binary"
AROUND, WINDOW, SPAN = 0, 1, 2


def send(texts: DataFrame, twice, often, length: int) -> DataFrame:
    """Surroundings of passed anchors, windows of hot ones, and spans that repeat an earlier surrounding of the same task.

    ``at`` is the anchor's place (a window's or span's start) in the text, ``room`` the bytes before the anchor (a span's length).
    """

    def work(batches):
        seen: dict[tuple[int, bytes], tuple] = {}
        spans: list[tuple] = []
        held = 0

        def emit():
            kind, key, key2, ids, ts, ats, room, raw = ([] for _ in range(8))
            add = lambda *x: [c.append(v) for c, v in zip((kind, key, key2, ids, ts, ats, room, raw), x, strict=True)]
            for (left, around), (_, i, t, at, h, hot) in seen.items():
                if not hot:
                    add(AROUND, h, 0, i, t, at, left, around)
            windows: dict[int, tuple] = {}
            for (left, around), (rank, i, t, at, _, hot) in seen.items():
                if hot:
                    for k in range(len(around) - length + 1):
                        w = xxhash.xxh3_128_intdigest(around[k : k + length])
                        mine = (rank[0], rank[1], at - left + k)
                        if (old := windows.get(w)) is None:
                            windows[w] = (mine, i, t)
                        else:
                            first, last = ((mine, i, t), old) if mine < old[0] else (old, (mine, i, t))
                            windows[w] = first
                            if first[0] != last[0]:
                                spans.append((last[1], last[2], last[0][2], length))
            for w, (mine, i, t) in windows.items():
                add(WINDOW, signed(w >> 64), signed(w & (2**64 - 1)), i, t, mine[2], 0, b"")
            for i, t, at, size in spans:
                add(SPAN, 0, 0, i, t, at, size, b"")
            seen.clear()
            spans.clear()
            kinds = [pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip((kind, key, key2, ids, ts, ats, room, raw), kinds, strict=True)],
                ["kind", "key", "key2", "id", "t", "at", "room", "bytes"],
            )

        for batch, own in slices(batches, "text"):
            ids, ts = field(batch, "id").to_pylist(), field(batch, "t").to_pylist()
            for data, begins, ends, number, offset in pieces_of(own.to_pylist(), length):
                h, place, low, high = anchors(data, begins, ends, length)
                ok = np.flatnonzero(passes(twice.value, h))
                h, place, low, high = h[ok], place[ok], low[ok], high[ok]
                hot = passes(often.value, h)
                piece = np.searchsorted(begins, low, "right") - 1
                raw = data.tobytes()
                rows = zip(number[piece].tolist(), (place - begins[piece] + offset[piece]).tolist(), h.view(np.int64).tolist(), low.tolist(), place.tolist(), high.tolist(), hot.tolist(), strict=True)
                for i, at, key, a, p, b, is_hot in rows:
                    name = (p - a, raw[a : b + length])
                    mine = ((-1 if ids[i] is None else 0, ids[i] or 0), ts[i], at)
                    new = (mine, ids[i], ts[i], at, key, is_hot)
                    if (old := seen.get(name)) is None:
                        seen[name] = new
                        held += len(name[1]) + 200
                    elif mine != old[0]:
                        first, last = (new, old) if mine < old[0] else (old, new)
                        seen[name] = first
                        spans.append((last[1], last[2], last[3] - name[0], len(name[1])))
                if held > CHUNK or len(spans) > FLUSH:
                    yield emit()
                    held = 0
        yield emit()

    return as_rows(texts, ["id", "t", "text"]).mapInArrow(work, SENT)


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def repeats_among(key, order, at, room, around: list[bytes], length: int, shallow: int) -> tuple[np.ndarray, ...]:
    """Row, start and size of each run of repeated windows; rows come with the most binding first: ``order`` gives each row's rank."""
    n, reach = len(key), length - GRAM
    rank = np.argsort(order)  # places by rank
    key, at, room = key[rank], at[rank], room[rank]
    around = [around[i] for i in rank.tolist()]
    sizes = np.array([len(a) for a in around], np.int64)
    flat = np.frombuffer(b"".join(around), np.uint8)
    begin = np.cumsum(sizes) - sizes
    after, before = np.zeros((n, length), np.uint8), np.zeros((n, 8 + reach), np.uint8)
    ahead = sizes - room
    rows = np.repeat(np.arange(n), ahead)
    after[rows, spread(np.zeros(n, np.int64), ahead)] = flat[spread(begin + room, ahead)]
    # Backwards, the anchor's hash goes first, so that only rows of one anchor compare.
    before[:, :8] = key.astype(np.int64).view(np.uint64).astype(">u8").view(np.uint8).reshape(n, 8)
    rows = np.repeat(np.arange(n), room)
    back = spread(np.zeros(n, np.int64), room)
    before[rows, 8 + back] = flat[np.repeat(begin + room, room) - 1 - back]
    classes = []
    for table in (after, before):
        sorted_rows, common = sort_rows(table, shallow)
        classes.append((sorted_rows, common))
    most = np.minimum(room, reach)
    least = np.maximum(length - ahead, 0)
    dup = np.zeros((n, reach + 2), bool)
    of = np.empty(n, np.int64)
    pair = np.empty(n, np.int64)
    for left in range(reach + 1):
        use = np.flatnonzero((least <= left) & (left <= most))
        if len(use) < 2:
            continue
        (fwd, fwd_common), (bwd, bwd_common) = classes
        of[fwd] = np.cumsum(fwd_common < length - left)
        pair[bwd] = np.cumsum(bwd_common < 8 + left)
        both = of[use] * (n + 1) + pair[use]
        _, first = np.unique(both, return_index=True)
        again = np.ones(len(use), bool)
        again[first] = False
        dup[use[again], left] = True
    step = np.diff(np.concatenate([np.zeros((n, 1), np.int8), dup.astype(np.int8)], axis=1), axis=1)
    row, low = np.nonzero(step == 1)
    row_end, high = np.nonzero(step == -1)
    start = at[row] - (high - 1)
    return rank[row], start, (high - low) - 1 + length


def sorted_spans(around: DataFrame, length: int, shallow: int) -> DataFrame:
    """Spans of repeated windows of anchors that are dealt by their hash and sorted."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        key, at, room, t = (table[c].to_numpy() for c in ("key", "at", "room", "t"))
        ids = table["id"]
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        number = ids.fill_null(0).to_numpy()
        own = np.lexsort((room, at, t, number, known))
        again = np.zeros(len(own), bool)  # the same surrounding of a repeated row, from another task or flush: no repeat of itself
        again[1:] = np.all([x[own[1:]] == x[own[:-1]] for x in (known, number, t, at, room)], axis=0)
        own = own[~again]
        around = table["bytes"].take(pa.array(own)).to_pylist()
        row, start, size = repeats_among(key[own], np.arange(len(own)), at[own], room[own].astype(np.int64), around, length, shallow)
        pick = pa.array(own[row])
        return pa.RecordBatch.from_arrays(
            [ids.combine_chunks().take(pick), table["t"].combine_chunks().take(pick), pa.array(start), pa.array(size)], ["id", "t", "start", "size"]
        )

    def work(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > CHUNK:
                table = pa.Table.from_batches(held)
                key = table["key"].to_numpy()
                cut = int(np.searchsorted(key, key[-1]))  # the last anchor may go on in the next batch
                if cut:
                    yield solve(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
                    size = sum(b.nbytes for b in held)
        if held and sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held))

    dealt = around.select("key", "id", "t", "at", "room", "bytes").repartition(parts(around.sparkSession), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(work, "id bigint, t bigint, start bigint, size bigint")


def window_spans(windows: DataFrame, length: int) -> DataFrame:
    """Spans of all but the first of equal windows."""
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", "t", "at")
    first = windows.groupBy("key", "key2").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return windows.join(first, ["key", "key2"]).where(~order.eqNullSafe(F.col("first"))).select(
        "id", "t", F.col("at").alias("start"), F.lit(length).cast("bigint").alias("size")
    )


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: list[str], length: int = LENGTH, hot: int = HOT, shallow: int = SHALLOW
) -> DataFrame:
    """``row`` (the carried columns, which include id and text), ``n_bytes, n_removed, n_spans`` long, ``kept`` binary."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text")).withColumn("t", F.xxhash64("text"))
    twice, often = (spark.sparkContext.broadcast(x) for x in repeated_anchors(texts, "text", length, hot))
    path = in_scratch(spark, "suffixes")
    send(texts, twice, often, length).write.option("compression", "zstd").parquet(path)
    sent = spark.read.parquet(path)
    spans = (
        sorted_spans(sent.where(F.col("kind") == AROUND), length, shallow)
        .unionByName(window_spans(sent.where(F.col("kind") == WINDOW), length))
        .unionByName(sent.where(F.col("kind") == SPAN).select("id", "t", F.col("at").alias("start"), F.col("room").cast("bigint").alias("size")))
    )
    lists = spans.groupBy("id", "t").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    rows = as_rows(docs, carry).withColumn("id", F.col("row").getField(id_col).cast("bigint"))
    rows = rows.withColumn("t", F.xxhash64(F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))))
    found = lists.select(F.col("id").alias("found_id"), F.col("t").alias("found_t"), "spans")
    met = rows.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("t") == F.col("found_t")), "left").select("row", "spans")

    def cut(batches):
        for batch, own in slices(batches, text_col):
            out = []
            for text, spans in zip(own.to_pylist(), batch["spans"].to_pylist(), strict=True):
                runs: list[list[int]] = []
                for s in sorted((x["start"], x["start"] + x["size"]) for x in spans or ()):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append(list(s))
                kept, at = [], 0
                for a, b in runs:
                    kept.append(text[at:a])
                    at = b
                out.append((len(text), sum(b - a for a, b in runs), len(runs), b"".join([*kept, text[at:]])))
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True))],
                ["row", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return met.mapInArrow(cut, f"row {row_type(docs, carry)}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
