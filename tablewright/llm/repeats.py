"""Removal of repeated byte strings by a depth-limited radix sort of the windows.

A window is `length` consecutive bytes of a text. Windows are ordered only through their `length` bytes, by passes from
the most significant digit; after the last pass the equal groups are exactly the repeated windows, and every byte that
one covers goes. A window's digits are read from its anchor on, the position of its smallest hash of DIGIT bytes: equal
windows have their anchor at the same place, and all windows of a text share few anchors, so that the first passes sort
anchors instead of windows.

* Pass 1, digit: the DIGIT bytes at the anchor. Anchors with a digit of their own leave: nothing equals their windows.
* Pass 2, digit: all bytes that the windows of an anchor cover. Equal groups are repeated as a whole and are done.
* Pass 3, digit: the single window, only for anchors that share the first digit but not the second. Equal groups are
  the repeated windows left.

Digits travel as 64-bit hashes. Within a slice of text equal groups of pass 2 are settled at once and send one member
on, so a passage in very many texts sends one row per slice. Texts are worked on in segments of bounded size.

Null texts are empty; texts shorter than a window keep everything. Repeated rows are repetitions of each other and
lose all their windows. A null doc_id is a value like any other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import map_texts, mixed, parts, raw_texts, stored

LENGTH, DIGIT = 200, 56
SEGMENT_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_PLACE = np.uint64((1 << 28) - 1)


class Digits:
    """Hashes of any substring of a buffer, equal for equal bytes wherever they stand."""

    powers = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    def __init__(self, raw: np.ndarray) -> None:
        n = len(raw)
        if len(Digits.powers) < n + 1:
            for name, base in (("powers", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n + 1, base, np.uint64)
                steps[0] = 1
                setattr(Digits, name, np.multiply.accumulate(steps))
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[raw] * Digits.powers[:n], out=self.total[1:])

    def at(self, start: np.ndarray, size) -> np.ndarray:
        return mixed((self.total[start + size] - self.total[start]) * Digits.inverse[start])

    def everywhere(self, size: int) -> np.ndarray:
        n = len(self.total) - size
        return mixed((self.total[size:] - self.total[:n]) * Digits.inverse[:n])


def _anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` hashes the place of its smallest, the leftmost of equal ones."""
    n = len(hashes) - width + 1
    ranked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    rows = np.full(-(-len(ranked) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    rows[:len(ranked)] = ranked
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & _PLACE).astype(np.int64)


def anchored(texts: list[bytes], length: int = LENGTH, digit: int = DIGIT):
    """Runs of windows with the same anchor, over all texts: text, first window, windows, first digit, second digit."""
    found = []
    width = length - digit + 1
    for owners, offsets, raw in _segments(texts, length):
        digits = Digits(raw)
        anchor = _anchors(digits.everywhere(digit), width)
        sizes = np.diff(np.append(offsets[:, 0], len(raw)))
        last = np.repeat(offsets[:, 0] + sizes - length, sizes)[:len(anchor)]
        valid = np.arange(len(anchor)) <= last
        starts = valid.copy()
        starts[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        starts[offsets[:, 0][offsets[:, 0] < len(starts)]] = True
        starts &= valid
        stops = valid.copy()
        stops[:-1] &= starts[1:] | ~valid[1:]
        first, end = np.flatnonzero(starts), np.flatnonzero(stops)
        place = anchor[first]
        one = digits.at(place, digit)
        two = mixed(digits.at(first, end - first + length) ^ one * np.uint64(3) ^ (place - first).astype(np.uint64) << np.uint64(17))
        which = np.searchsorted(offsets[:, 0], first, "right") - 1
        found.append((owners[which], first - offsets[which, 0] + offsets[which, 1], end - first + 1, one, two))
    if not found:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _segments(texts: list[bytes], length: int):
    """Buffers of about SEGMENT_BYTES: text numbers, (place in the buffer, place in the text), bytes.

    A long text comes in segments that overlap by a window less one byte, so each window is in exactly one.
    """
    step = SEGMENT_BYTES
    owners, offsets, pieces, size = [], [], [], 0
    for number, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, step):
            piece = text[start:start + step + length - 1]
            owners.append(number)
            offsets.append((size, start))
            pieces.append(piece)
            size += len(piece)
            if size >= step:
                yield np.array(owners), np.array(offsets), np.frombuffer(b"".join(pieces), np.uint8)
                owners, offsets, pieces, size = [], [], [], 0
    if pieces:
        yield np.array(owners), np.array(offsets), np.frombuffer(b"".join(pieces), np.uint8)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("row"))


ENTRY = np.dtype([("one", "<u8"), ("two", "<u8"), ("row", "<i8"), ("first", "<u4"), ("windows", "u1"), ("many", "u1")])
FOUND = "row long, first int, windows int, whole boolean, ask boolean"


def _found(row, first, windows, whole, ask) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"row": pa.array(row, pa.int64()), "first": pa.array(first, pa.int32()),
                                       "windows": pa.array(windows, pa.int32()), "whole": pa.array(whole, pa.bool_()), "ask": pa.array(ask, pa.bool_())})


def _passes(docs: DataFrame, length: int, digit: int) -> DataFrame:
    """Passes 1 and 2. Rows of FOUND: runs of windows that are repeated as a whole, and runs to ask window by window."""
    buckets = parts(docs.sparkSession)

    def emit(batch):
        rows = np.array(batch.column("row").to_pylist(), np.int64)
        owner, first, windows, one, two = anchored(raw_texts(batch), length, digit)
        if not len(owner):
            return
        order = np.argsort(two, kind="stable")
        fresh = np.append(True, two[order][1:] != two[order][:-1])
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(order)))
        go, stay = order[fresh], order[~fresh]
        entries = np.empty(len(go), ENTRY)
        for name, column in (("one", one[go]), ("two", two[go]), ("row", rows[owner[go]]), ("first", first[go]), ("windows", windows[go]), ("many", sizes > 1)):
            entries[name] = column
        bucket = (entries["one"] % np.uint64(buckets)).astype(np.int64)
        dealt = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[dealt], np.arange(buckets + 1))
        some = np.flatnonzero(np.diff(cuts))
        none = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "row": none, "first": none.cast(pa.int32()), "windows": none.cast(pa.int32()),
                                          "entries": [entries[dealt[cuts[b]:cuts[b + 1]]].tobytes() for b in some]})
        if len(stay):
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(np.arange(len(stay)) % buckets, pa.int32()), "row": rows[owner[stay]], "first": pa.array(first[stay], pa.int32()),
                "windows": pa.array(windows[stay], pa.int32()), "entries": pa.nulls(len(stay), pa.binary())})

    def sort(batches):
        held: dict[int, list] = {}
        for batch in batches:
            done = batch.filter(pc.is_null(batch.column("entries")))
            if done.num_rows:
                yield _found(done.column("row"), done.column("first"), done.column("windows"), [True] * done.num_rows, [False] * done.num_rows)
            for b, e in zip(batch.column("bucket").to_pylist(), batch.column("entries").to_pylist()):
                if e is not None:
                    held.setdefault(b, []).append(np.frombuffer(e, ENTRY))
        for b in list(held):
            e = np.concatenate(held.pop(b))
            e = e[np.lexsort((e["two"], e["one"]))]
            new_two = np.append(True, (e["two"][1:] != e["two"][:-1]) | (e["one"][1:] != e["one"][:-1]))
            new_one = np.append(True, e["one"][1:] != e["one"][:-1])
            group = np.cumsum(new_two) - 1
            weight = np.bincount(group, 1 + e["many"])
            whole = weight[group] >= 2
            contested = np.bincount(np.cumsum(new_one) - 1, new_two)[np.cumsum(new_one) - 1] >= 2
            ask = contested & (~whole | new_two)
            out = np.flatnonzero(whole | ask)
            for k in range(0, len(out), 1 << 16):
                i = out[k:k + (1 << 16)]
                yield _found(e["row"][i], e["first"][i].astype(np.int32), e["windows"][i].astype(np.int32), whole[i], ask[i])

    emitted = map_texts(_keyed(docs).drop("doc_id"), emit, "bucket int, row long, first int, windows int, entries binary")
    return stored(emitted.repartitionById(buckets, F.col("bucket")).mapInArrow(sort, FOUND), "repeat_runs")


def _zipped(docs: DataFrame) -> DataFrame:
    """Texts compressed before they are shuffled, with the digest they have when nothing is removed."""
    import zstandard

    def shrink(batch):
        z = zstandard.ZstdCompressor(level=1)
        texts = raw_texts(batch)
        yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_bytes": pa.array(map(len, texts), pa.int64()),
                                          "sha": [hashlib.sha256(t).hexdigest() for t in texts], "packed": [z.compress(t) for t in texts]})

    return map_texts(_keyed(docs), shrink, "row long, doc_id long, n_bytes long, sha string, packed binary")


WINDOW = np.dtype([("digit", "<u8"), ("row", "<i8"), ("at", "<u4")])
#: Marks a window that is known to be repeated and wants no answer.
NO_ANSWER = 0xFFFFFFFF


def _single_windows(hit: DataFrame, length: int) -> DataFrame:
    """Pass 3: row and first byte of the repeated windows among those asked for."""
    import zstandard

    buckets = parts(hit.sparkSession)

    def emit(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            held: list[np.ndarray] = []
            for row, packed, runs in zip(*(batch.column(c).to_pylist() for c in ("row", "packed", "runs"))):
                asks = [r for r in runs if r["ask"]]
                if not asks:
                    continue
                first = np.array([r["first"] for r in asks])
                windows = np.array([r["windows"] for r in asks])
                at = np.repeat(first - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
                raw = np.frombuffer(unzip.decompress(packed), np.uint8)
                made = np.empty(len(at), WINDOW)
                made["digit"], made["row"], made["at"] = Digits(raw).at(at, length), row, at
                known = np.repeat([r["whole"] for r in asks], windows)
                made["row"][known], made["at"][known] = 0, NO_ANSWER
                held.append(made)
                if sum(map(len, held)) > 1 << 20:
                    yield from dealt(np.concatenate(held))
                    held = []
            if held:
                yield from dealt(np.concatenate(held))

    def dealt(made: np.ndarray):
        known = made["at"] == NO_ANSWER
        made = np.concatenate([made[~known], np.unique(made[known])])
        bucket = (made["digit"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        some = np.flatnonzero(np.diff(cuts))
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "entries": [made[order[cuts[b]:cuts[b + 1]]].tobytes() for b in some]})

    def sort(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for b, e in zip(batch.column("bucket").to_pylist(), batch.column("entries").to_pylist()):
                held.setdefault(b, []).append(np.frombuffer(e, WINDOW))
        for b in list(held):
            e = np.concatenate(held.pop(b))
            e = e[np.argsort(e["digit"], kind="stable")]
            group = np.cumsum(np.append(True, e["digit"][1:] != e["digit"][:-1])) - 1
            open_ = e["at"] != NO_ANSWER
            out = np.flatnonzero(open_ & (np.bincount(group, np.where(open_, 1, 2))[group] >= 2))
            for k in range(0, len(out), 1 << 16):
                i = out[k:k + (1 << 16)]
                yield pa.RecordBatch.from_pydict({"row": e["row"][i], "at": e["at"][i].astype(np.int32)})

    asked = hit.where(F.exists("runs", lambda r: r["ask"])).select("row", "packed", "runs")
    return (asked.mapInArrow(emit, "bucket int, entries binary").repartitionById(buckets, F.col("bucket"))
            .mapInArrow(sort, "row long, at int"))


def without_repeats(docs: DataFrame, length: int = LENGTH, digit: int = DIGIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes; null where nothing was removed)."""
    import zstandard

    runs = (_passes(docs, length, digit).groupBy("row")
            .agg(F.collect_list(F.struct("first", "windows", "whole", "ask")).alias("runs")))
    seen = stored(_zipped(docs).join(runs, "row", "left").withColumn("packed", F.when(F.col("runs").isNotNull(), F.col("packed"))), "repeat_texts",
                  compression="uncompressed")
    hit = seen.where("runs IS NOT NULL")
    single = stored(_single_windows(hit, length).groupBy("row").agg(F.collect_list("at").alias("single")), "repeat_windows")

    def cut(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "runs", "single")))
            out: dict[str, list] = {c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for doc_id, packed, found, more in rows:
                raw = np.frombuffer(unzip.decompress(packed), np.uint8)
                change = np.zeros(len(raw) + 1, np.int64)
                whole = [r for r in found if r["whole"]]
                first = np.array([r["first"] for r in whole] + (more or []), np.int64)
                stop = np.array([r["first"] + r["windows"] - 1 + length for r in whole] + [a + length for a in more or []], np.int64)
                np.add.at(change, first, 1)
                np.add.at(change, stop, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = raw[~gone].tobytes()
                for c, value in zip(out, (doc_id, len(raw), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()),
                                          hashlib.sha256(kept).hexdigest(), kept)):
                    out[c].append(value)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(out["doc_id"], pa.int64()), **{c: out[c] for c in list(out)[1:]}})

    cleaned = hit.join(single, "row", "left").select("doc_id", "packed", "runs", "single").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    whole = seen.where("runs IS NULL").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                                              F.col("sha").alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"))
    return whole.unionByName(cleaned)
