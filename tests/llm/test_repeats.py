import hashlib
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import repeats


def brute(rows, length):
    """Per row: bytes, removed, runs, digest of the rest."""
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[k:k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, raw):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((str(doc_id), len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def got(frame):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect())


def test_documents(spark, documents, texts):
    assert got(repeats.without_repeats(documents)) == brute(list(texts.items()), 200)


@pytest.mark.parametrize("segment", [64, 4 << 20])
def test_small_alphabets_overlaps_and_segments(spark, docs, monkeypatch, segment):
    monkeypatch.setattr(repeats, "SEGMENT_BYTES", segment)
    random = np.random.default_rng(5)
    rows = [(k, "".join(random.choice(list("ab"), int(random.integers(0, 300))))) for k in range(60)]
    rows += [(100, "a" * 90), (101, "xyz" * 40), (102, rows[3][1][10:60] + "Q" + rows[3][1][20:70])]
    assert got(repeats.without_repeats(docs(rows), 20, 6)) == brute(rows, 20)


def test_edges(spark, docs):
    line = "é" * 150
    rows = [(1, None), (2, ""), (3, line), (None, "z" + line), (5, "short"), (6, "same " * 60), (6, "same " * 60), (7, line[:99])]
    assert got(repeats.without_repeats(docs(rows))) == brute(rows, 200)
    assert repeats.without_repeats(docs([])).count() == 0
