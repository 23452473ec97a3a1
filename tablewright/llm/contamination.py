"""Benchmark decontamination with an Aho-Corasick automaton.

The automaton holds every window of `width` consecutive words of the normalised test texts; a text with fewer words is
one window. Its symbols are the distinct words of the test texts, so it has at most `width` states per word of them. A
document is normalised the same way, scanned once, and the word positions of its hits are mapped back to byte offsets of
the original text.

Test texts of up to `part_bytes` make one automaton, which every worker process builds once. More of them are cut into
pieces that overlap by `width - 1` words and dealt into parts; documents are then written out with a row number, scanned
once per part, and the hits of all parts are joined by row. Neither driver nor task ever holds more than one part.

Words are runs of a-z, 0-9 and all non-ASCII characters after A-Z are lower-cased. Null and empty texts have no words:
such a document is never hit and such an item has no window. Items may share windows: a hit counts for each. Repeated
document rows are judged each for itself; without items nothing is hit. Very long documents and items are scanned whole.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import map_texts, raw_texts, stored

WIDTH = 10
#: Bytes of test texts behind one automaton, some 300 MB in each worker process.
PART_BYTES = 4 << 20
#: Words of an item that stay together when test texts are dealt into parts.
PIECE_WORDS = 4096

_WORD = set(range(48, 58)) | set(range(97, 123)) | set(range(128, 256))
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _WORD else 32 for c in range(256))
#: Stands for all words that no test text has.
OTHER = "\0"


def folded(text: bytes) -> bytes:
    """The text byte by byte: A-Z lower-cased, everything that is not part of a word blanked."""
    return text.translate(_FOLD)


def pieces(words: list[bytes], width: int, most: int = PIECE_WORDS) -> list[list[bytes]]:
    """Runs of words that together have the windows of all words, each once."""
    return [words[i:i + most + width - 1] for i in range(0, max(1, len(words) - width + 1), most)]


def windows(words: list[bytes], width: int = WIDTH) -> list[list[bytes]]:
    if not words:
        return []
    return [words[i:i + width] for i in range(max(1, len(words) - width + 1))]


class Machine:
    """Windows as strings with one character per word; each knows its number of words and its items."""

    def __init__(self, items: list[tuple[str, bytes]], width: int = WIDTH) -> None:
        import ahocorasick

        self.symbols: dict[bytes, str] = {}
        owners: dict[str, set[str]] = defaultdict(set)
        for item, text in items:
            for window in windows([self._symbol(w) for w in folded(text).split()], width):
                owners["".join(window)].add(item)
        self.found = ahocorasick.Automaton()
        for window, ids in owners.items():
            self.found.add_word(window, (len(window), tuple(sorted(ids))))
        if owners:
            self.found.make_automaton()

    def _symbol(self, word: bytes) -> str:
        number = len(self.symbols) + 1
        return self.symbols.setdefault(word, chr(number if number < 0xD800 else number + 0x800))

    def scan(self, text: bytes) -> tuple[int, np.ndarray, set[str]]:
        """Number of words, whether each is hit, and the items that occur."""
        words = folded(text).split()
        hit, items = np.zeros(len(words), bool), set()
        if words and len(self.found):
            get = self.symbols.get
            for last, (n, ids) in self.found.iter("".join([get(w, OTHER) for w in words])):
                hit[last - n + 1:last + 1] = True
                items.update(ids)
        return len(words), hit, items


def runs(hit: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last position, exclusive, of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).tolist()
    return zip(edges[::2], edges[1::2])


def hit_spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte offsets in the original text of the runs of hit words."""
    if not hit.any():
        return []
    body = np.frombuffer(folded(text), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], body.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    return [(int(starts[a]), int(ends[b - 1])) for a, b in runs(hit)]


_MACHINES: dict[str, Machine] = {}


class Part:
    """Test texts that fit one automaton, sent to the executors; each worker process builds the automaton once."""

    def __init__(self, items: DataFrame, width: int) -> None:
        rows = items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("i"), "text").collect()
        self.key, self.width = uuid.uuid4().hex, width
        self.items = items.sparkSession.sparkContext.broadcast([(str(r["i"]), r["text"].encode()) for r in rows])

    def machine(self) -> Machine:
        if self.key not in _MACHINES:
            _MACHINES.clear()
            _MACHINES[self.key] = Machine(self.items.value, self.width)
        return _MACHINES[self.key]


def dealt(benchmark: DataFrame, width: int, part_bytes: int) -> list[DataFrame]:
    """The test texts in parts, usually a single one."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= part_bytes:
        return [benchmark]

    def cut(batch):
        ids, texts = [], []
        for item, text in zip(batch.column("item_id").to_pylist(), raw_texts(batch)):
            for piece in pieces(folded(text).split(), width):
                ids.append(item)
                texts.append(b" ".join(piece).decode())
        yield pa.RecordBatch.from_pydict({"item_id": pa.array(ids, pa.string()), "text": pa.array(texts, pa.string())})

    # Hashing fills parts evenly but for single pieces; twice the number leaves room for the uneven rest.
    n = -(-2 * size // part_bytes)
    named = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    cuts = map_texts(named, cut, "item_id string, text string")
    table = stored(cuts.distinct().withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "test_pieces")
    return [table.where(F.col("part") == k) for k in range(n)]


def _judged(batch: pa.RecordBatch, found: list[tuple[int, np.ndarray, set[str]]]) -> pa.RecordBatch:
    spans = [[{"start": a, "end": b} for a, b in hit_spans(text, hit)] for text, (_, hit, _) in zip(raw_texts(batch), found)]
    n_hit = [int(hit.sum()) for _, hit, _ in found]
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id"), "n_words": [n for n, _, _ in found], "n_hit": n_hit, "n_items": [len(i) for *_, i in found],
        "items_sha256": [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for *_, i in found],
        "contaminated": [n > 0 for n in n_hit], "spans": pa.array(spans, pairs)})


JUDGED = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean,"
          " spans array<struct<start:long,end:long>>")


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: words, hit words, items with occurring windows and their digest, and the hit spans in bytes."""
    parts = dealt(benchmark, width, part_bytes)
    if len(parts) == 1:
        part = Part(parts[0], width)

        def judge(batch):
            machine = part.machine()
            yield _judged(batch, [machine.scan(text) for text in raw_texts(batch)])

        return map_texts(docs.select("doc_id", "text"), judge, JUDGED)

    rows = stored(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "scanned_texts")
    hits = reduce(DataFrame.unionByName, [_hits(rows, Part(items, width)) for items in parts])
    merged = hits.groupBy("row").agg(F.flatten(F.collect_list("runs")).alias("runs"),
                                     F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def unite(batch):
        found = []
        for text, marked, items in zip(raw_texts(batch), batch.column("runs").to_pylist(), batch.column("items").to_pylist()):
            hit = np.zeros(len(folded(text).split()), bool)
            for run in marked or ():
                hit[run["start"]:run["stop"]] = True
            found.append((len(hit), hit, set(items or ())))
        yield _judged(batch, found)

    return map_texts(rows.join(merged, "row", "left").select("doc_id", "text", "runs", "items"), unite, JUDGED)


def _hits(rows: DataFrame, part: Part) -> DataFrame:
    """row, runs of hit words and items of the documents that a part hits; written out, after which the part is given up."""

    def find(batch):
        machine = part.machine()
        found = [machine.scan(text) for text in raw_texts(batch)]
        mine = [k for k, (*_, items) in enumerate(found) if items]
        marked = [[{"start": a, "stop": b} for a, b in runs(found[k][1])] for k in mine]
        pairs = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_pydict({"row": batch.column("row").take(pa.array(mine, pa.int64())), "runs": pa.array(marked, pairs),
                                          "items": pa.array([sorted(found[k][2]) for k in mine], pa.list_(pa.string()))})

    out = stored(map_texts(rows.select("row", "text"), find, "row long, runs array<struct<start:long,stop:long>>, items array<string>"), "hits")
    part.items.destroy()
    return out


def clean_only(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows without a hit, with all their columns."""

    def without(rows: DataFrame, part: Part) -> DataFrame:
        @F.pandas_udf("boolean")
        def clean(texts):
            machine = part.machine()
            return texts.map(lambda t: not machine.scan((t or "").encode())[2])

        return rows.where(clean(F.col("text")))

    *others, last = dealt(benchmark, width, part_bytes)
    for items in others:
        part = Part(items, width)
        docs = stored(without(docs, part), "clean_so_far")
        part.items.destroy()
    return without(docs, Part(last, width))


SQL = r"""
WITH RECURSIVE b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN lens)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
q AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN q ON d.doc_id = q.doc_id
"""
