"""Toxicity with noisy-channel deobfuscation.

A disguised word (leetspeak, letters spaced or punctuated apart, repeated letters) is a lattice: each character stands
for the letters it may disguise, or for nothing, and a mark also for the edge between two words. Viterbi decoding picks
the reading that a character trigram model likes best; each of its words is scored. The model is counted over all texts and mixed with the spellings that labels mark as toxic. The restored
words and those that were plain are then scored: log-odds of words and word beginnings, learned from a bounded sample of labelled documents,
summed over a document's distinct words and calibrated by logistic regression.

Labels are learned only from rows whose crc32 of the doc_id is not held out. Null and empty texts have no words and
score as such; a text or token of any length takes time in proportion to it. Repeated rows and near copies count once in training. Without labels of both kinds every score is the
share of toxic labels (0 without any).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import WordCodes, map_texts, stored, text_batches
from tablewright.llm.near import shingles

#: Most labelled rows that training looks at (those whose doc_id hashes lowest).
TRAIN_ROWS = 12_000
#: Characters after which the decoder writes out what all its readings have in common.
DECIDE_EVERY = 1 << 14
#: Beginnings of words that are features, besides whole words.
BEGINNINGS = range(3, 9)
#: A feature is this many times as frequent in toxic texts, and in at least this share and number of them.
LEAST_LIFT, LEAST_SHARE, LEAST_TEXTS = 10.0, 0.004, 4
THRESHOLD = 0.3
MOST_TOKENS = 400_000

#: Letters that a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y", "§": "s", "*": "aeiou", "#": "h", "%": "x"}
SEPARATORS = set(" .,_-*+~'|/\\:;=\"`^·•")
EDGES = "".join(sorted(SEPARATORS)) + "!?()[]{}<>«»“”„’‘…"

#: Undisguised words inside a token; shorter runs of letters are remains of disguised ones.
PLAIN = re.compile(r"[^\W\d_]{%d,}" % BEGINNINGS.start)

#: Alphabet of the character model: a word's edge, a-z, and the letters of Latin-1.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SIZE = len(LETTERS) + 1
NUMBER = {letter: i + 1 for i, letter in enumerate(LETTERS)}
_OF_CODE = np.zeros(256, np.int64)
_OF_CODE[[ord(c) for c in LETTERS]] = np.arange(1, SIZE)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of all letter trigrams of all texts; the table has SIZE cubed cells, whatever the texts."""

    def count(batches):
        total = np.zeros(SIZE ** 3, np.int64)
        for batch in text_batches(batches):
            # A blank between two texts is a word's edge, as at the ends of a text.
            whole = " ".join(t or "" for t in batch.column("text").to_pylist()).lower()
            codes = np.frombuffer(f"  {whole} ".encode("utf-32-le"), np.uint32)
            letters = _OF_CODE[np.where(codes < 256, codes, 0)]
            total += np.bincount((letters[:-2] * SIZE + letters[1:-1]) * SIZE + letters[2:], minlength=SIZE ** 3)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": used, "uses": total[used]})

    rows = docs.select("text").mapInArrow(count, "cell long, uses long").groupBy("cell").agg(F.sum("uses").alias("uses")).collect()
    table = np.zeros(SIZE ** 3)
    table[[r["cell"] for r in rows]] = [r["uses"] for r in rows]
    return table.reshape(SIZE, SIZE, SIZE)


def character_model(corpus: np.ndarray, spellings: dict[str, float]) -> np.ndarray:
    """Log-probability of a letter after two others: half corpus, half the given spellings; a $ is a word's end."""
    marked = np.zeros_like(corpus)
    for word, weight in spellings.items():
        a = b = 0
        for letter in word:
            c = NUMBER.get(letter, 0)
            marked[a, b, c] += weight
            a, b = b, c

    def share(counts: np.ndarray) -> np.ndarray:
        return (counts + 0.01) / (counts.sum(-1, keepdims=True) + 0.01 * SIZE)

    return np.log(0.5 * share(corpus) + 0.5 * share(marked))


@lru_cache(100_000)
def _options(ch: str, repeated: bool) -> tuple[tuple[str, float], ...]:
    """What a character may be read as, and at which cost."""
    options: list[tuple[str, float]] = []
    if ch in NUMBER:
        options.append((ch, 0.0))
        if repeated:
            options.append(("", -1.0))
    for letter in LEET.get(ch, ""):
        options.append((letter, -1.0 if len(LEET[ch]) < 3 else -3.0))
    if ch in SEPARATORS:
        options.append(("", -0.5))
    elif ch not in NUMBER:
        options.append(("", -6.0))
        if repeated:
            options.append(("", -1.0))
    if not ch.isalnum():
        options.append((" ", -0.5))
    return tuple(options)


def _spelled(path: list | None) -> str:
    """The letters of a chain of [chain before, letter]."""
    letters = []
    while path is not None:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


def _shared(paths: list[list | None]) -> list | None:
    """The longest chain that all chains begin with."""
    path, *others = paths
    chain = []
    while path is not None:
        chain.append(path)
        path = path[0]
    place = {id(link): k for k, link in enumerate(chain)}
    at = 0
    for path in others:
        while path is not None and id(path) not in place:
            path = path[0]
        if path is None:
            return None
        at = max(at, place[id(path)])
    return chain[at] if chain else None


def restore(token: str, model: np.ndarray | list[list[float]]) -> str:
    """The likeliest reading of a token, words with blanks between: Viterbi over its lattice.

    Readings are chains of letters that share their beginnings, so time is in proportion to the token's length. What all
    open readings have in common is taken off their chains on the way. `model` may come as rows, one per two letters.
    """
    rows = model if isinstance(model, list) else model.reshape(-1, SIZE).tolist()
    best: dict[tuple[int, int], tuple[float, list | None]] = {(0, 0): (0.0, None)}
    decided, before = [], ""
    for at, ch in enumerate(token, 1):
        options = _options(ch, ch == before)
        following: dict[tuple[int, int], tuple[float, list | None]] = {}
        for (a, b), (score, path) in best.items():
            row = rows[a * SIZE + b]
            for letter, cost in options:
                if not letter:
                    state, value = (a, b), score + cost
                else:
                    c = NUMBER.get(letter, 0)  # 0 is the edge between two words
                    state, value = (b, c) if c else (0, 0), score + cost + row[c]
                if state not in following or value > following[state][0]:
                    following[state] = (value, [path, letter] if letter else path)
        best, before = following, ch
        if at % DECIDE_EVERY == 0 and (shared := _shared([path for _, path in best.values()])) is not None:
            decided.append(_spelled(shared))
            shared[:] = None, ""
    top = max(score for score, _ in best.values())
    return "".join(decided) + max(_spelled(path) for score, path in best.values() if score == top)


def _repeats(word: str) -> bool:
    return any(a == b and a in NUMBER for a, b in zip(word, word[1:]))


class Scorer:
    """Weights of tokens, remembered; sums over the distinct toxic tokens of a text."""

    class Known(dict):
        def __missing__(self, token: str) -> int:
            number = self[token] = len(self)
            return number

    def __init__(self, weights: dict[str, float], model: np.ndarray) -> None:
        self.features, self.model = weights, model.reshape(-1, SIZE).tolist()
        self.forget()

    def forget(self) -> None:
        self.known, self.listed, self.weight, self.single = self.Known(), [], np.empty(0), np.empty(0, bool)

    def word_weight(self, word: str) -> float:
        get = self.features.get
        return max([get(word + "$", 0.0), *(get(word[:k], 0.0) for k in BEGINNINGS if k <= len(word))])

    def restored_weight(self, token: str) -> float:
        """Sum over the distinct words of the restored token; a lone letter beside others is no word."""
        words = restore(token, self.model).split()
        return sum(self.word_weight(w) for w in set(words) if len(w) > 1 or len(words) == 1)

    def token_weight(self, token: str) -> float:
        core = token.strip(EDGES)
        if core.isalpha():
            plain = self.word_weight(core)
            return max(plain, self.restored_weight(core)) if _repeats(core) else plain
        # Marks at the edge may stand for letters: "!diot", "$cum".
        readings = {core, token} if len(token) > len(core) and any(c in LEET for c in token) else {core}
        readings = {r for r in readings if any(c in NUMBER for c in r) or sum(c in LEET for c in r) >= 3}
        plain = sum(self.word_weight(w) for w in set(PLAIN.findall(core)))
        return max([plain, *map(self.restored_weight, readings)])

    def sums(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > MOST_TOKENS:
            self.forget()
        split = [t.lower().split() for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        numbers = np.fromiter((self.known[t] for tokens in split for t in tokens), np.int64, int(sizes.sum()))
        if len(self.known) > len(self.weight):
            new = list(self.known)[len(self.weight):]
            self.weight = np.append(self.weight, [self.token_weight(t) for t in new])
            self.single = np.append(self.single, [len(t) == 1 for t in new])
        owner = np.repeat(np.arange(len(split)), sizes)
        toxic = np.flatnonzero(self.weight[numbers] > 0)
        pairs = np.unique(owner[toxic] * len(self.weight) + numbers[toxic])
        out = np.bincount(pairs // max(1, len(self.weight)), self.weight[pairs % max(1, len(self.weight))], len(split)) if len(pairs) else np.zeros(len(split))
        # Runs of three or more single characters are words spaced apart.
        alone = self.single[numbers]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], alone.view(np.int8), [0]))))
        begins = np.cumsum(sizes) - sizes
        for a, b in zip(edge[::2], edge[1::2]):
            for k in np.unique(owner[a:b]) if b - a >= 3 else ():
                run = split[k][max(0, a - begins[k]):b - begins[k]]
                if len(run) >= 3:
                    out[k] += max(self.token_weight("".join(run)), self.token_weight(" ".join(run)))
        return out


def _training_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """toxic, text of the labelled sample; of near copies with the same smallest shingle one."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("labelled"), "labelled", "toxic").limit(TRAIN_ROWS))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("labelled")).select("toxic", "text")

    def mark(batch):
        codes = WordCodes()
        signs = [int(s[0].astype(np.int64)) if len(s := shingles((t or "").encode(), codes)) else 0 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict({"sign": signs, "toxic": batch.column("toxic"), "text": batch.column("text")})

    marked = map_texts(rows, mark, "sign long, toxic int, text string")
    return stored(marked.groupBy("sign").agg(F.max_by("text", F.struct("toxic", "text")).alias("text"), F.max("toxic").alias("toxic")).drop("sign"), "toxic_train")


def words_of(text: str) -> set[str]:
    return {w for t in text.lower().split() if (w := t.strip(EDGES)).isalpha()}


def features_of(text: str) -> set[str]:
    words = words_of(text)
    return {w + "$" for w in words} | {w[:k] for w in words for k in BEGINNINGS if k <= len(w)}


def learned_weights(train: DataFrame) -> dict[str, float]:
    """Log-odds of the features that toxic texts have far more often."""
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sum(n for label, n in sizes.items() if label != 1)
    if not toxic or not clean:
        return {}

    def count(batch):
        seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            seen[label == 1].update(features_of(text or ""))
        every = list(seen[True].keys() | seen[False].keys())
        yield pa.RecordBatch.from_pydict({"feature": pa.array(every, pa.string()), "t": [seen[True][f] for f in every], "c": [seen[False][f] for f in every]})

    lift = (F.col("t") + 0.5) / (toxic + 1) * (clean + 1) / (F.col("c") + 0.5)
    found = (map_texts(train, count, "feature string, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
             .where(F.col("t") >= max(LEAST_TEXTS, math.ceil(LEAST_SHARE * toxic))).withColumn("lift", lift).where(F.col("lift") >= LEAST_LIFT)
             .collect())  # the labelled sample bounds them
    return {r["feature"]: math.log(r["lift"]) for r in found}


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a logistic regression on one variable (Newton steps, slightly damped)."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return (math.log(max(share, 1e-6) / max(1 - share, 1e-6)), 0.0)
    rows = np.stack([np.ones_like(x), x], 1)
    w = np.array([math.log(y.mean() / (1 - y.mean())), 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (p - y) + np.array([0.0, 0.01]) * w
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag([1e-6, 0.01])
        step = np.linalg.solve(bend, slope)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    train = _training_texts(docs, labels)
    weights = learned_weights(train)
    model = character_model(trigram_counts(docs), weights)
    parts = docs.sparkSession.sparkContext.broadcast((weights, model))
    made: list[Scorer] = []

    def scorer() -> Scorer:
        if not made:
            made.append(Scorer(*parts.value))
        return made[0]

    def sums(batch):
        yield pa.RecordBatch.from_pydict({"x": scorer().sums([t or "" for t in batch.column("text").to_pylist()]), "y": batch.column("toxic")})

    fit = map_texts(train, sums, "x double, y int").collect()  # at most TRAIN_ROWS pairs
    offset, slope = _calibrated(np.array([r["x"] for r in fit]), np.array([float(r["y"] == 1) for r in fit]))

    def judge(batch):
        x = scorer().sums([t or "" for t in batch.column("text").to_pylist()])
        score = 1 / (1 + np.exp(-np.clip(offset + slope * x, -700, 700)))
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": score,
                                          "predicted": pa.array((score >= THRESHOLD).astype(np.int32))})

    asked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_texts(asked, judge, "doc_id long, held_out boolean, score double, predicted int")
