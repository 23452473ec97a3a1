from collections import Counter, defaultdict

import numpy as np

from tablewright.llm import near
from tablewright.llm.common import WordCodes
from tablewright.llm.components import components


def brute_components(texts):
    """Smallest id reachable, by comparing each text with all before it."""
    codes, posting, parent = WordCodes(), defaultdict(list), {i: i for i in texts}
    sets = {i: frozenset(near.shingles((t or "").encode(), codes).tolist()) for i, t in texts.items()}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in sorted(texts):
        common = Counter()
        for s in sets[i]:
            common.update(posting[s])
            posting[s].append(i)
        for j, k in common.items():
            if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_components_of_documents(spark, documents, texts):
    got = found(near.joined(documents))
    assert {i: c for i, (_, c) in got.items()} == brute_components(texts)


def test_near_copies_in_many_groups(spark, docs):
    """Chains of small edits: neighbours link, distant ones only through others."""
    random = np.random.default_rng(3)
    rows, number = [], 0
    for family in range(12):
        words = [f"w{family}_{x}" for x in random.integers(0, 500, 60)]
        for _ in range(25):
            words[int(random.integers(0, 60))] = f"e{number}"
            rows.append((number, " ".join(words)))
            number += 1
    passage = " ".join(f"p{k}" for k in range(40))
    for k in range(80):  # texts that share a passage and nothing else
        rows.append((number + k, passage + " " + " ".join(f"x{k}_{j}" for j in range(35))))
    got = found(near.joined(docs(rows)))
    assert {i: c for i, (_, c) in got.items()} == brute_components(dict(rows))


def test_small_chunks_and_no_extra_lose_no_link(spark, docs, documents, texts, monkeypatch):
    monkeypatch.setattr(near, "CHUNK_SHINGLES", 150)
    got = found(near.joined(documents))
    assert {i: c for i, (_, c) in got.items()} == brute_components(texts)


def matrix(spark, sets):
    """(class, chunk) pairs of the token-group matrix where each set is a component and a chunk of its own."""
    freq = Counter(t for s in sets.values() for t in s)
    rows = [(i, len(s), sorted((t for t in s if freq[t] > 1), key=lambda t: (freq[t], t))) for i, s in sets.items()]
    alive = spark.createDataFrame([r for r in rows if len(r[2]) >= near.least_overlap(r[1])], "sid long, n long, tokens array<long>")
    labels = spark.createDataFrame([(i, i, i) for i in sets], "sid long, chunk long, component long")
    return {(r.sid, r.chunk) for r in near._qualified(alive, labels).collect()}


def test_matrix_leaves_a_shared_passage_alone(spark):
    """80 of 100 shingles in common are not enough for a link, and no two of the classes are brought together."""
    assert matrix(spark, {k: set(range(80)) | {1000 * (k + 1) + j for j in range(20)} for k in range(60)}) == set()


def test_matrix_has_every_link(spark):
    """Sets cut from the same few, down to three quarters of one another's size: each link is asked from one side."""
    random = np.random.default_rng(5)
    sets = {0: set(range(40)), 1: set(range(30)), 2: set(range(29)), 3: {500, 501, 502}, 4: {500, 501, 502, 503}, 5: {900}, 6: {900, 901}}
    for k in range(7, 160):
        whole = np.arange(2000 + 100 * (k % 5), 2000 + 100 * (k % 5) + int(random.integers(4, 60) if k % 2 else random.integers(30, 44)))
        own = 10_000 + 100 * k + np.arange(int(random.integers(0, 1 + len(whole) // 6)))
        sets[k] = set(random.permutation(whole)[:len(whole) - int(random.integers(0, 1 + len(whole) // 8))].tolist()) | set(own.tolist())
    linked = {(a, b) for a in sets for b in sets if a < b and near._links(len(sets[a] & sets[b]), len(sets[a]), len(sets[b]))}
    asked = matrix(spark, sets)
    assert {(0, 1), (3, 4)} <= linked and not {(0, 2), (5, 6)} & linked and len(linked) > 300
    assert not [pair for pair in linked if pair not in asked and pair[::-1] not in asked]


def test_edges(spark, docs):
    rows = [(9, "One two three"), (4, "one TWO three"), (1, ""), (2, None), (3, " \n"), (None, "one two three"), (7, "one two"), (7, "one two"),
            (8, "a b c d e"), (6, "a b c d e f")]
    frame = docs(rows)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in near.joined(frame).collect())
    assert got == sorted([("9", 1, 4), ("4", 1, 4), ("1", 0, 1), ("2", 0, 2), ("3", 0, 3), ("None", 1, 4), ("7", 1, 7), ("7", 1, 7), ("8", 1, 8), ("6", 2, 6)])
    assert near.joined(docs([])).count() == 0
    kept = near.one_of_each(frame.selectExpr("*", "1 as n", "2 as sid", "3 as component_id"))
    assert kept.columns == ["doc_id", "text", "n", "sid", "component_id"] and {r.doc_id for r in kept.collect()} == {4, 1, 2, 3, 7, 8, 6}


def test_link_needs_exactly_three_quarters():
    assert near._links(np.array([3, 3]), 3, np.array([4, 5])).tolist() == [True, False]


def test_component_labels(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 100), (7, 7), (60, 50), (60, 50)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 50: 50, 60: 50}
    assert components(links.where("false")).count() == 0
