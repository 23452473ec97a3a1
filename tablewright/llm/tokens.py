"""Token-id output: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

File format, in one folder:

* `ranks`: one row per id in use, `rank` (0 is the most frequent) and `id`.
* `blocks`: a run of consecutive documents per row, in ascending doc_id order by `place`. `doc_ids` and `lengths` list
  the documents and their numbers of tokens, `control` holds two bits per token (its rank takes 1 to 4 bytes, four
  tokens to a control byte, the first in the lowest bits), `data` the ranks' little-endian bytes without the zeros above.

Reading looks up the byte lengths of four tokens at once by control byte, and ids by rank, in numpy tables.

Null and empty texts hold the end id alone. Documents with a null doc_id come first; rows that share a doc_id follow
each other in the order of their contents. `round_trip` reads special-token strings in a
text as the tokenizer file does; elsewhere they are ordinary text unless `special` is set.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import map_texts, parts, stored
from tablewright.session import work_folder

END_ID = 2
#: Tokens in a block, unless one document alone has more.
BLOCK_TOKENS = 1 << 18
#: Pieces a worker remembers the ids of; beyond, the half seen most often stays.
MOST_PIECES = 1_000_000
#: Words a worker remembers besides, for pieces that differ by the marks behind them.
MOST_WORDS = 200_000
#: Longer pieces do not outlive a thinning.
LONG_PIECE = 64
#: Characters of texts with special tokens, which are one piece each, that a task remembers.
MOST_SPECIAL = 1 << 24
#: Marks the first piece of a text, which has no blank before it; a lone surrogate is in no text.
FIRST = "\ud800"
BREAK = f" \n{FIRST}"
#: New pieces that are encoded in one run.
RUN_PIECES = 2000
#: A piece of Latin letters with marks behind: the pre-tokenizer of byte-level BPE makes two words of it, whatever stands around.
WORD = re.compile(r"(\n?\ud800)?([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]*)")

LENGTHS = np.stack([(np.arange(256) >> shift) & 3 for shift in (0, 2, 4, 6)], 1).astype(np.int64) + 1


class PieceEncoder:
    """Encodes texts piece by piece and remembers pieces.

    A single blank or line break between two characters that are not white space always ends a token of this byte-level
    BPE, so the text may be cut before it and equal pieces need to be encoded once only.
    """

    safe_cut = re.compile(r"(?<=\S) (?=\S)")

    class Known(dict):
        """Piece to number; pieces not yet known get the next number and are noted."""

        def __init__(self) -> None:
            super().__init__()
            self.new: list[str] = []

        def __missing__(self, piece: str) -> int:
            number = self[piece] = len(self)
            self.new.append(piece)
            return number

    class Words(dict):
        """Words, their blank included, to ids: what the library's model makes of one pre-tokenized word."""

        def __init__(self, model) -> None:
            super().__init__()
            from tokenizers import pre_tokenizers

            self.model = model
            signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.signs = {c: signs.pre_tokenize_str(chr(c))[0][0] for c in (32, *range(33, 127), *range(0xC0, 0x250))}

        def __missing__(self, word: str) -> tuple[int, ...]:
            if len(self) >= MOST_WORDS:
                self.clear()
            ids = self[word] = tuple(t.id for t in self.model.tokenize(word.translate(self.signs)))
            return ids

    def __init__(self, path: str, special: bool = False) -> None:
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        names = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.special = re.compile("|".join(names)) if names else None
        self.line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        made = json.loads(self.tokenizer.to_str())
        cutter = made["pre_tokenizer"] or {}
        # Words go straight to the model where the file has nothing but the byte-level cut in front of it.
        straight = (cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
                    and not made["normalizer"] and all(t["special"] for t in made["added_tokens"]))
        self.words = self.Words(self.tokenizer.model) if straight else None
        self.known, self.special_size = self.Known(), 0
        self.ids, self.uncut, self.uses = np.empty(0, np.uint32), np.empty(0, bool), np.empty(0, np.int64)
        self.begin, self.length = np.empty(0, np.int64), np.empty(0, np.int64)

    def thin(self) -> None:
        """Keep the pieces seen twice or more, at most half of the room and the most frequent ones; uses are halved."""
        pieces = list(self.known)
        short = np.fromiter(map(len, pieces), np.int64, len(pieces)) <= LONG_PIECE
        kept = np.flatnonzero((self.uses > 1) & short)
        if len(kept) > MOST_PIECES // 2:
            kept = np.sort(kept[np.argsort(-self.uses[kept], kind="stable")[:MOST_PIECES // 2]])
        length = self.length[kept]
        begin = np.cumsum(length) - length
        self.ids = self.ids[np.arange(length.sum()) + np.repeat(self.begin[kept] - begin, length)]
        self.begin, self.length, self.uncut, self.uses = begin, length, self.uncut[kept], self.uses[kept] // 2
        self.known, self.special_size = self.Known(), 0
        self.known.update((pieces[k], i) for i, k in enumerate(kept.tolist()))

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def _learn(self) -> None:
        """Encode the new pieces: words one by one, most others in long runs with a line break, a token of its own, between two."""
        new, self.known.new = self.known.new, []
        if not new:
            return
        found = [self._word(p) for p in new]
        words = np.array([f is not None for f in found])
        begin, length = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        uncut = np.zeros(len(new), bool)
        length[words] = [len(f) for f in found if f is not None]
        begin[words] = len(self.ids) + np.cumsum(length[words]) - length[words]
        made = [np.fromiter(chain.from_iterable(f for f in found if f is not None), np.uint32, int(length.sum()))]
        others = np.flatnonzero(~words)
        if len(others):
            ids, begin[others], length[others], uncut[others] = self._others([new[i] for i in others])
            begin[others] += len(self.ids) + len(made[0])
            made.append(ids)
        self.ids = np.concatenate([self.ids, *made])
        self.begin, self.length = np.append(self.begin, begin), np.append(self.length, length)
        self.uncut, self.uses = np.append(self.uncut, uncut), np.append(self.uses, np.zeros(len(new), np.int64))

    def _word(self, piece: str) -> tuple[int, ...] | None:
        """Ids of a piece that is a word with marks behind it, else None."""
        match = self.words is not None and WORD.fullmatch(piece)
        if not match or (self.special and match[1] == FIRST and self.special.search(piece)):
            return None
        ids = self.words[match[2] if match[1] else " " + match[2]]
        if match[3]:
            ids += self.words[match[3]]
        return (self.line_break, *ids) if match[1] and match[1] != FIRST else ids

    def _others(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, the begin and length of each, and whether its text needs a more careful cut."""
        # A piece after a blank is known without it; the first piece of a text or line carries a mark.
        bodies = [p[p.index(FIRST) + 1:] if FIRST in p[:2] else " " + p for p in new]
        whole = np.array([bool(b and b[-1] > " " and not b[-1].isspace() and not (b[1:2] if b[0] == " " else b[0]).isspace() and b != " ")
                          for b in bodies])
        broken = np.array([p[:1] == "\n" for p in new])
        plain = whole & np.array(["\n" not in b and not (self.special and self.special.search(b)) for b in bodies])
        begin, length = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        made, size = [], 0
        runs = np.flatnonzero(plain)
        joined = ["\n" + "\n".join(bodies[i] for i in runs[k:k + RUN_PIECES]) for k in range(0, len(runs), RUN_PIECES)]
        for k, ids in enumerate(self._batch(joined)):
            cuts = np.flatnonzero(ids == self.line_break)
            mine = runs[k * RUN_PIECES:(k + 1) * RUN_PIECES]
            begin[mine], length[mine] = size + cuts + 1, np.diff(np.append(cuts, len(ids))) - 1
            made.append(ids)
            size += len(ids)
        # The break before a piece that starts a line is the one that separates it from the piece before.
        begin[plain & broken] -= 1
        length[plain & broken] += 1
        others = np.flatnonzero(~plain)
        for i, ids in zip(others, self._batch([("\n" if broken[i] else "") + bodies[i] for i in others])):
            begin[i], length[i] = size, len(ids)
            made.append(ids)
            size += len(ids)
        first = np.array([p[:1] == FIRST for p in new])
        return np.concatenate([np.empty(0, np.uint32), *made]), begin, length, ~whole & ~first

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end id, and the number of ids of each."""
        if len(self.known) > MOST_PIECES or self.special_size > MOST_SPECIAL:
            self.thin()
        # What a special token does to the text around it is the library's matter: such texts are encoded whole.
        uncuttable = [bool(self.special and self.special.search(t)) for t in texts]
        self.special_size += sum(len(t) for t, u in zip(texts, uncuttable) if u)
        cut = [[FIRST + t] if u else (FIRST + t.replace("\n", BREAK)).split(" ") for t, u in zip(texts, uncuttable)]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        numbers = self._numbers([p for pieces in cut for p in pieces])
        self._learn()
        ends = np.cumsum(sizes)
        firsts = ends - sizes
        # An empty piece or white space at a cut means the blank was not alone: such texts are cut with more care.
        uncut = self.uncut[numbers]
        edge = np.array([len(p[0]) < 2 or p[0][-1].isspace() for p in cut], bool) & (sizes > 1)
        odd = np.flatnonzero(np.logical_or.reduceat(uncut, firsts) | edge) if len(cut) else np.empty(0, np.int64)
        if len(odd):
            again = {}
            for i in odd:
                head, *rest = self.safe_cut.split(texts[i])
                again[int(i)] = [FIRST + head, *rest]
            redone = {i: self._numbers(p) for i, p in again.items()}
            self._learn()
            runs = [redone.get(i, numbers[firsts[i]:ends[i]]) for i in range(len(cut))]
            numbers, sizes = np.concatenate(runs), np.array([len(r) for r in runs], np.int64)
            ends = np.cumsum(sizes)
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        begin, length = self.begin[numbers], self.length[numbers]
        filled = np.concatenate(([0], np.cumsum(length)))
        per_text = np.diff(filled[np.concatenate(([0], ends))])
        at = np.arange(filled[-1]) + np.repeat(begin - filled[:-1], length)
        body = self.ids[at]
        out = np.full(len(body) + len(texts), END_ID, np.uint32)
        mine = np.ones(len(out), bool)
        mine[np.cumsum(per_text + 1) - 1] = False
        out[mine] = body
        return out, per_text + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    length = 1 + (values > 0xFF) + (values > 0xFFFF).astype(np.int64) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[:len(values)] = length - 1
    fours = codes.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < length[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of `pack`."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    start = np.cumsum(length) - length
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8)
    out = np.zeros(n, np.uint32)
    for k in range(4):
        has = slice(None) if k == 0 else np.flatnonzero(length > k)
        out[has] |= raw[start[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoded(docs: DataFrame, tokenizer: str, special: bool = False) -> DataFrame:
    """Documents as ids in ascending order: bucket, place, doc_id, n, ids (compressed 16- or 32-bit words)."""
    import zstandard

    buckets = parts(docs.sparkSession)
    shares = [i / buckets for i in range(1, buckets)]
    bounds = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, 10 * buckets)).first()[0] or []
    edges = F.array(*[F.lit(b) for b in sorted(set(bounds))]).cast("array<long>")
    bucket = F.coalesce(F.size(F.filter(edges, lambda b: b < F.col("doc_id"))), F.lit(0))

    def encode(batch):
        if (tokenizer, special) not in _ENCODERS:
            _ENCODERS[tokenizer, special] = PieceEncoder(tokenizer, special)
        ids, lengths = _ENCODERS[tokenizer, special].encode([t or "" for t in batch.column("text").to_pylist()])
        ends = np.cumsum(lengths)
        small = zstandard.ZstdCompressor(level=1)
        blobs = []
        for a, b in zip(ends - lengths, ends):
            words = ids[a:b].astype("<u4" if ids[a:b].max() > 0xFFFF else "<u2")
            blobs.append(small.compress(words.tobytes()))
        yield pa.RecordBatch.from_pydict({"bucket": batch.column("bucket"), "doc_id": batch.column("doc_id"), "n": lengths, "ids": blobs})

    rows = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), bucket.alias("bucket"))
    made = map_texts(rows, encode, "bucket int, doc_id long, n long, ids binary")
    ordered = made.repartitionById(buckets, F.col("bucket")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "n", "ids")
    return stored(ordered.withColumn("place", F.monotonically_increasing_id()), "token_ids", compression="uncompressed")


def _words(blob: bytes, n: int) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def frequencies(ids: DataFrame) -> list[int]:
    """Ids in use, the most frequent first. At most the tokenizer's vocabulary reaches the driver."""

    def count(batches):
        total, held, size = np.zeros(1, np.int64), [], 0

        def add() -> np.ndarray:
            seen = np.bincount(np.concatenate(held)) if held else np.zeros(1, np.int64)
            wide = np.zeros(max(len(seen), len(total)), np.int64)
            wide[:len(total)] = total
            wide[:len(seen)] += seen
            return wide

        for batch in batches:
            for blob, n in zip(batch.column("ids").to_pylist(), batch.column("n").to_pylist()):
                held.append(_words(blob, n))
                size += n
                if size > BLOCK_TOKENS:
                    total, held, size = add(), [], 0
        total = add()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": used.astype(np.int64), "uses": total[used]})

    counted = ids.select("ids", "n").mapInArrow(count, "id long, uses long").groupBy("id").agg(F.sum("uses").alias("uses")).collect()
    return [r["id"] for r in sorted(counted, key=lambda r: (-r["uses"], r["id"]))]


def write(docs: DataFrame, folder: str, tokenizer: str, special: bool = False) -> None:
    """Encode documents and write the files of the format below `folder`."""
    spark = docs.sparkSession
    ids = encoded(docs, tokenizer, special)
    order = frequencies(ids)
    spark.createDataFrame(list(enumerate(order)), "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(order, default=0) + 1, np.uint32)
    rank_of[order] = np.arange(len(order))
    table = spark.sparkContext.broadcast(rank_of)

    def block(rows: list[tuple]) -> pa.RecordBatch:
        control, data = pack(np.concatenate([table.value[_words(blob, n)] for *_, n, blob in rows]))
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array([rows[0][0]], pa.int32()), "place": [rows[0][1]], "n_tokens": [sum(r[3] for r in rows)],
            "doc_ids": pa.array([[r[2] for r in rows]], pa.list_(pa.int64())), "lengths": [[r[3] for r in rows]],
            "control": [control], "data": [data]})

    def blocks(batches):
        held, tokens = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "place", "doc_id", "n", "ids"))):
                if held and (tokens + row[3] > BLOCK_TOKENS or row[0] != held[0][0]):
                    yield block(held)
                    held, tokens = [], 0
                held.append(row)
                tokens += row[3]
        if held:
            yield block(held)

    (ids.select("bucket", "place", "doc_id", "n", "ids")
     .mapInArrow(blocks, "bucket int, place long, n_tokens long, doc_ids array<long>, lengths array<long>, control binary, data binary")
     .write.option("compression", "uncompressed").parquet(f"{folder}/blocks"))


def read(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """Documents from the files: doc_id, start (ids of all documents before), n_tokens, and the ids or their crc32."""
    order = [r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    ids = spark.sparkContext.broadcast(np.array(order, "<u4"))
    blocks = spark.read.parquet(f"{folder}/blocks")
    sizes = blocks.select("bucket", "place", "n_tokens")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    of_bucket = sizes.groupBy("bucket").agg(F.sum("n_tokens").alias("n")).select(  # one row per bucket
        "bucket", F.coalesce(F.sum("n").over(before.orderBy("bucket")), F.lit(0)).alias("ahead"))
    in_bucket = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = (sizes.withColumn("inside", in_bucket).join(of_bucket, "bucket")
              .select("place", (F.col("ahead") + F.col("inside")).alias("block_start")))

    def decode(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                place, n, doc_ids, lengths, control, data = (batch.column(c)[k].as_py() for c in (
                    "place", "n_tokens", "doc_ids", "lengths", "control", "data"))
                values = ids.value[unpack(control, data, n)]
                ends = np.cumsum(lengths)
                begins = ends - lengths
                each = [values[a:b] for a, b in zip(begins, ends)]
                content = [zlib.crc32(v.tobytes()) for v in each] if digest else [v.tolist() for v in each]
                yield pa.RecordBatch.from_pydict({
                    "place": [place] * len(each), "doc_id": pa.array(doc_ids, pa.int64()), "inside": begins.astype(np.int64),
                    "n_tokens": lengths, "content": pa.array(content, pa.int64() if digest else pa.list_(pa.int64()))})

    kind, name = ("long", "ids_crc32") if digest else ("array<long>", "ids")
    docs = blocks.select("place", "n_tokens", "doc_ids", "lengths", "control", "data").mapInArrow(
        decode, f"place long, doc_id long, inside long, n_tokens long, content {kind}")
    return docs.join(starts, "place").select("doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", F.col("content").alias(name))


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write documents to a fresh folder and read their digests back."""
    folder = work_folder(docs.sparkSession, "tokens")
    write(docs, folder, tokenizer, special=True)
    return read(docs.sparkSession, folder, digest=True)
