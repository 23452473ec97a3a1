"""Exact n-gram Jaccard join with a token-group matrix.

Every text is the set of its distinct 5-word shingles; two texts link when 100 * intersection >= 75 * union. Texts with
the same set are one class from the start. The join then works on classes:

1. Of each set the smallest shingles by hash form a prefix. Similar sets have several prefix shingles in common, so a
   class with too few shingles that any other class has in its prefix can link with nothing and leaves. Of the rest the
   whole sets are looked at in the same way: three quarters of a set have to be in others.
2. Those left are grouped by their smallest shared shingle; a group's rows are dealt into chunks of bounded size.
   Near copies meet in few groups, however many they are.
3. Opening a group compares whole sets, exactly, inside a task. First the members of each chunk are connected, then
   one class of each component with few others that have a small shingle in common.
4. The token-group matrix holds for each group, a chunk's members of one component, the union of their rarest shared
   shingles, fewer of a set as the smaller one of a link than as the larger one. A class asks a group of a larger
   component only if it shares one of them: first one class of each component, then whatever is still not connected. No
   link between two components can be missed, and no list of all pairs is ever made.

Words are split at ASCII white space after A-Z are lower-cased; a text of fewer words is one shingle; one without words
has an empty set and links with nothing. Null texts are empty. A null doc_id may link; it is never the smallest id while
another is there. Repeated rows are members of the same class. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import WordCodes, map_texts, parts, raw_texts, rolled, stored
from tablewright.llm.components import components

WIDTH = 5
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 75
#: The prefix is longer than a link demands by this share of the set, so that similar sets share several shingles.
EXTRA = 0.10
#: Shingles in a chunk of a group, unless one text alone has more.
CHUNK_SHINGLES = 400_000
#: Small shingles by which one class of each component looks for others, and tasks that share a much sought one.
BRIDGE_SHINGLES, BRIDGE_SALTS = 8, 16

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text: bytes, codes: WordCodes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = text.translate(_FOLD).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WIDTH:
        import xxhash

        return np.array([xxhash.xxh3_64_intdigest(b"\0".join(words), seed=len(words))], np.uint64)
    return np.unique(rolled(codes.of(words), WIDTH))


def set_id(members: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(members.tobytes())).astype(np.int64))


def least_overlap(n):
    """Shingles that a set of n has in common with any set it links with."""
    return -(-n * PERCENT // 100)


def prefix_length(n: int) -> int:
    return n - least_overlap(n) + max(1, int(EXTRA * n))


def needed(n: Column) -> Column:
    """Prefix shingles that a set of n shares at least with any set it links with, however small that is."""
    return F.greatest(F.lit(1), F.floor(F.lit(EXTRA) * F.ceil(n * PERCENT / 100)))


def demanded(n: Column) -> Column:
    """least_overlap of a column."""
    return F.ceil(n * PERCENT / 100)


def demanded_of_smaller(n: Column) -> Column:
    """Shingles that a set of n has in common with any set it links with that is not smaller."""
    return F.ceil(n * (2 * PERCENT) / (100 + PERCENT))


def _spread(docs: DataFrame, cut: Callable[[int], int]) -> DataFrame:
    """One row per document (doc_id, n, sid) and one per shingle (sid, token) that several sets have among their smallest `cut(n)`.

    A shingle's row says how many sets have it so (freq).
    """
    buckets = parts(docs.sparkSession)

    def emit(batch):
        codes = _codes()
        ids, sizes, tokens, owners = [], [], [], []
        for raw in raw_texts(batch):
            members = shingles(raw, codes)
            n = len(members)
            sid = set_id(members) if n else None
            ids.append(sid)
            sizes.append(n)
            if n:
                tokens.append(members[:cut(n)])
                owners.append(np.full(len(tokens[-1]), sid, np.int64))
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(np.arange(len(ids)) % buckets, pa.int32()), "doc_id": batch.column("doc_id").cast(pa.int64()),
            "n": pa.array(sizes, pa.int64()), "sid": pa.array(ids, pa.int64()),
            "tokens": pa.nulls(len(ids), pa.binary()), "owners": pa.nulls(len(ids), pa.binary())})
        if not tokens:
            return
        token, owner = np.concatenate(tokens), np.concatenate(owners)
        bucket = (token % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        some = np.flatnonzero(np.diff(cuts))
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(some, pa.int32()), "doc_id": pa.nulls(len(some), pa.int64()), "n": pa.nulls(len(some), pa.int64()),
            "sid": pa.nulls(len(some), pa.int64()),
            "tokens": [token[order[cuts[b]:cuts[b + 1]]].tobytes() for b in some],
            "owners": [owner[order[cuts[b]:cuts[b + 1]]].tobytes() for b in some]})

    def share(batches):
        held: dict[int, list] = {}
        for batch in batches:
            plain = batch.filter(pc.is_null(batch.column("tokens")))
            if plain.num_rows:
                yield pa.RecordBatch.from_pydict({**{c: plain.column(c) for c in ("doc_id", "n", "sid")},
                                                  "token": pa.nulls(plain.num_rows, pa.int64()), "freq": pa.nulls(plain.num_rows, pa.int64())})
            for b, t, o in zip(*(batch.column(c).to_pylist() for c in ("bucket", "tokens", "owners"))):
                if t is not None:
                    held.setdefault(b, []).append((np.frombuffer(t, np.int64), np.frombuffer(o, np.int64)))
        for pieces in held.values():
            token, owner = (np.concatenate(x) for x in zip(*pieces))
            order = np.lexsort((owner, token))
            token, owner = token[order], owner[order]
            fresh = np.append(True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1]))
            token, owner = token[fresh], owner[fresh]
            counts = np.diff(np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1], [True]))))
            freq = np.repeat(counts, counts)
            token, owner, freq = token[freq > 1], owner[freq > 1], freq[freq > 1]
            for k in range(0, len(token), 1 << 16):
                part = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_pydict({"doc_id": pa.nulls(len(token[part]), pa.int64()), "n": pa.nulls(len(token[part]), pa.int64()),
                                                  "sid": owner[part], "token": token[part], "freq": freq[part]})

    emitted = map_texts(docs.select("doc_id", "text"), emit, "bucket int, doc_id long, n long, sid long, tokens binary, owners binary")
    return stored(emitted.repartitionById(buckets, F.col("bucket")).mapInArrow(share, "doc_id long, n long, sid long, token long, freq long"), "near_spread")


_CODES: list[WordCodes] = []


def _codes() -> WordCodes:
    if not _CODES:
        _CODES.append(WordCodes())
    return _CODES[0]


def _links(overlap, n, others):
    return 100 * overlap >= PERCENT * (n + others - overlap)


class _Sets:
    """Sets of one opened group with their exact overlaps."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        everything = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(everything, kind="stable")
        self.sorted, self.owner = everything[order], owner[order]

    def linked(self, query: np.ndarray) -> np.ndarray:
        """Whether each set links with the query."""
        first = np.searchsorted(self.sorted, query, "left")
        count = np.searchsorted(self.sorted, query, "right") - first
        filled = np.cumsum(count)
        at = np.arange(filled[-1]) + np.repeat(first - (filled - count), count)
        overlap = np.bincount(self.owner[at], minlength=len(self.sets))
        return _links(overlap, len(query), self.sizes)


def _connect(sids: list[int], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that connect the members of a group as its full comparison would."""
    index = _Sets(sets)
    waiting = np.ones(len(sids), bool)
    for start in range(len(sids)):
        if not waiting[start]:
            continue
        waiting[start] = False
        edge = [start]
        while edge and waiting.any():
            now = edge.pop()
            for other in np.flatnonzero(index.linked(sets[now]) & waiting):
                waiting[other] = False
                edge.append(int(other))
                yield sids[now], sids[int(other)]


class _Members:
    """The members of a chunk, asked by classes of other components."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]) -> None:
        self.sids = [m[0] for m in members]
        self.component = np.array([m[1] for m in members])
        self.index = _Sets([m[2] for m in members])

    def across(self, sid: int, own: int, found: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links of a class with members of other components, one for each component."""
        hits = np.flatnonzero(self.index.linked(found) & (self.component != own))
        for at in hits[np.unique(self.component[hits], return_index=True)[1]]:
            yield sid, self.sids[at]


def _open(rows: DataFrame) -> DataFrame:
    """Links found by opening groups. rows: chunk, query (false: member), sid, component, text.

    A chunk's members, which are bounded, come first and are held; the classes that ask pass by one at a time.
    """

    def run(batches):
        links: list[tuple[int, int]] = []
        members: dict[int, tuple] = {}
        current, group = None, None

        def alone():
            """Links inside a chunk that nothing asked."""
            return _connect([m[0] for m in members.values()], [m[2] for m in members.values()]) if members and group is None else ()

        def emitted():
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("chunk", "query", "sid", "component"))
            for chunk, query, sid, component, text in zip(*columns, raw_texts(batch)):
                if chunk != current:
                    links.extend(alone())
                    current, members, group = chunk, {}, None
                if not query:
                    if sid not in members:
                        members[sid] = (sid, component, shingles(text, _codes()))
                elif members:
                    group = group or _Members(list(members.values()))
                    links.extend(group.across(sid, component, shingles(text, _codes())))
                if len(links) >= 1 << 14:
                    yield emitted()
                    links = []
        links.extend(alone())
        yield emitted()

    return rows.repartition("chunk").sortWithinPartitions("chunk", "query").mapInArrow(run, "a long, b long")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, sid (class of equal sets, null for empty ones), component (a class id of its component)."""
    spread = _spread(docs, prefix_length)
    members = spread.where("token IS NULL").select("doc_id", "n", "sid")
    sets = members.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    counted = spread.where("token IS NOT NULL").groupBy("sid").agg(F.count("*").alias("shared"))
    maybe = stored(counted.join(sets, "sid").where(F.col("shared") >= needed(F.col("n"))).select("sid", "n", "rep"), "near_maybe")

    def own(batch):
        keep = [i for i, (sid, raw) in enumerate(zip(batch.column("sid").to_pylist(), raw_texts(batch)))
                if len(s := shingles(raw, _codes())) and set_id(s) == sid]
        yield batch.take(pa.array(keep, pa.int64()))

    def named(batch):
        sets_of = [shingles(raw, _codes()) for raw in raw_texts(batch)]
        yield pa.RecordBatch.from_pydict({"sid": pa.array([set_id(s) if len(s) else None for s in sets_of], pa.int64()), "text": batch.column("text").cast(pa.string())})

    known = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("rep"), "text")
    # Both sides grow with the corpus, so neither is broadcast, also where a corpus is small.
    found = map_texts(maybe.hint("merge").join(known, "rep").select("sid", "text"), own, "sid long, text string")
    # Rows without an id are found by their set; one text of each will do.
    nameless = map_texts(docs.where("doc_id IS NULL").select("text"), named, "sid long, text string")
    apart = nameless.join(maybe.where("rep IS NULL").select("sid"), "sid").groupBy("sid").agg(F.first("text").alias("text"))
    texts = stored(found.unionByName(apart), "near_texts")

    whole = _spread(texts.select(F.col("sid").alias("doc_id"), "text"), int)
    held = whole.where("token IS NOT NULL").groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("freq", "token"))).alias("tokens"))
    alive = stored(held.join(maybe, "sid").where(F.size("tokens") >= demanded(F.col("n"))).select("sid", "n", F.col("tokens.token").alias("tokens")), "near_alive")

    lead = F.array_min("tokens").alias("lead")
    sizes = alive.groupBy(lead).agg(F.sum("n").alias("all"))
    part = F.pmod(F.xxhash64("sid"), F.ceil(F.col("all") / CHUNK_SHINGLES))
    placed = stored(alive.select("sid", "n", lead).join(sizes, "lead").select("sid", F.xxhash64("lead", part).alias("chunk")), "near_placed")

    def opened(asked: DataFrame, label: str) -> DataFrame:
        return stored(_open(asked.join(texts, "sid").select("chunk", "query", "sid", "component", "text")), label)

    def across(ask: DataFrame, labels: DataFrame, label: str) -> DataFrame:
        """Open chunks for the classes that ask: ask has sid, component, chunk."""
        groups = labels.join(ask.select("chunk").distinct(), "chunk").select("chunk", F.lit(False).alias("query"), "sid", "component")
        return opened(ask.select("chunk", F.lit(True).alias("query"), "sid", "component").unionByName(groups), label)

    crowded = placed.groupBy("chunk").agg(F.count("*").alias("k")).where("k > 1").select("chunk")
    links = opened(placed.join(crowded, "chunk").select("chunk", F.lit(False).alias("query"), "sid", F.col("sid").alias("component")), "near_inside")
    local = _labelled(placed, links, "near_local")
    links = links.unionByName(opened(_bridges(local, alive), "near_bridges"))
    bridged = _labelled(placed, links, "near_bridged")

    qualified = stored(_qualified(alive, bridged), "near_qualified")
    asked = qualified.join(bridged.select("sid", "component"), "sid").select("sid", "component", "chunk")
    one = asked.groupBy("component", "chunk").agg(F.min("sid").alias("sid"))
    links = links.unionByName(across(one, bridged, "near_one"))
    joined = _labelled(placed, links, "near_joined")
    found = joined.select("sid", "component")
    mixed_in = joined.groupBy("chunk").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rest = stored(asked.drop("component").join(found, "sid").join(mixed_in, "chunk")
                  .where("component <> low OR component <> high").select("sid", "chunk", "component"), "near_rest")
    final = _labelled(placed, links.unionByName(across(rest, joined, "near_rest_links")), "near_final")
    return (members.join(final.select("sid", "component"), "sid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), "sid", F.coalesce("component", "sid").alias("component")))


def _bridges(local: DataFrame, alive: DataFrame) -> DataFrame:
    """Pairs to open first: of each local component one class, with the least class that has a small shingle in common.

    They connect most near copies that lie in different chunks, at a few pairs per component. What they miss is found
    later; what they connect needs no further comparison.
    """
    chosen = local.groupBy("component").agg(F.min("sid").alias("sid")).join(alive, "sid")
    low = stored(chosen.select("sid", "component", F.explode(F.slice(F.array_sort("tokens"), 1, BRIDGE_SHINGLES)).alias("token")), "near_low")
    hubs = low.groupBy("token").agg(F.min(F.struct("sid", "component")).alias("hub"), F.count("*").alias("k")).where("k > 1").select("token", "hub")
    pairs = low.join(hubs, "token").where("sid <> hub.sid").select("sid", "component", "hub").distinct()
    salted = pairs.select("*", F.xxhash64("hub.sid", F.pmod(F.xxhash64("sid"), F.lit(BRIDGE_SALTS))).alias("chunk"))
    asks = salted.select("chunk", F.lit(True).alias("query"), "sid", "component")
    members = salted.select("chunk", F.lit(False).alias("query"), F.col("hub.sid").alias("sid"), F.col("hub.component").alias("component")).distinct()
    return asks.unionByName(members)


def _qualified(alive: DataFrame, labels: DataFrame) -> DataFrame:
    """The token-group matrix: sid, chunk (a chunk with members of another component that sid may link with).

    A chunk's members of one component are a group; a class never asks its own chunk, which was opened as a whole. Of two
    sets that link the smaller one has more in common with the other than its own size demands at least (see
    `demanded_of_smaller`), so the first token that both hold, rarest first, is among the first few of the smaller one and
    among somewhat more of the larger one; how tokens are ordered does not matter as long as all classes sort alike. Each
    class is in both parts, and tokens meet only across them. A passage of which texts hold as much as a link demands of
    the larger one, but not of the smaller one, brings none of them together, however many they are; texts that hold
    more of it link and are few groups by now. Tokens of one component only, or of no smaller part, leave before anything
    is joined. The smaller component asks.
    """
    held, n = F.size("tokens"), F.col("n")
    forward = stored(alive.select("sid", (held - demanded_of_smaller(n)).alias("few"),
                                  F.posexplode(F.slice("tokens", F.lit(1), (held - demanded(n) + 1).cast("int"))).alias("at", "token"))
                     .select("sid", "token", (F.col("at") <= F.col("few")).alias("smaller"))
                     .join(labels.select("sid", "component", "chunk"), "sid"), "near_forward")
    crossing = (forward.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("smaller").alias("smaller"))
                .where("low <> high AND smaller").select("token"))
    sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
    marked = stored(forward.join(crossing, "token", "left_semi").join(sizes, "component")
                    .select("sid", "token", "chunk", "smaller", F.struct("size", "component").alias("home")), "near_marked")
    cells = marked.groupBy("token", F.col("home").alias("other"), F.col("chunk").alias("there")).agg(F.max("smaller").alias("smaller"))

    def met(asking: DataFrame, groups: DataFrame) -> DataFrame:
        return asking.drop("smaller").join(groups.drop("smaller"), "token").where("home < other AND chunk <> there").select("sid", F.col("there").alias("chunk"))

    return met(marked.where("smaller"), cells).unionByName(met(marked.where("NOT smaller"), cells.where("smaller"))).distinct()


def _labelled(placed: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """sid, chunk, component of all classes that may link."""
    known = components(links).select(F.col("node").alias("sid"), "component")
    return stored(placed.select("sid", "chunk").join(known, "sid", "left")
                  .select("sid", "chunk", F.coalesce("component", "sid").alias("component")), label)


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links."""
    found = stored(classes(docs), "near_classes")
    least = found.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (found.join(least, "component", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each component, with all its columns; texts without words all stay."""
    kept = joined(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")
