import random

import numpy as np
import pytest

from msgflow.llm import superminhash as S
from msgflow.llm import words as W
from tests.llm import brute


def groups(df, similarity, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in S.near_duplicates(df, similarity, **options).collect()}


def copies(seed, n=60, length=120):
    """Chains of edits, so components hold members that are not linked themselves."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    base = [r.choice(vocabulary) for _ in range(length)]
    for k in range(n):
        text = list(base if r.random() < 0.5 or not out else out[-1].split())
        for _ in range(r.choice((0, 1, 1, 2, 4, 8))):
            text[r.randrange(length)] = r.choice(vocabulary)
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("similarity", [80, 85])
def test_equals_all_pairs(make, similarity):
    texts = copies(1) + copies(2, 30, 40) + copies(3, 20, 7)
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE two"), (905, "two one")]
    assert groups(make(rows), similarity) == brute.near_groups(rows, similarity)


def test_large_clusters_are_cut_into_tiles(make, monkeypatch):
    monkeypatch.setattr(S, "TILE_DOCUMENTS", 7)
    monkeypatch.setattr(S, "TILE_SHINGLES", 900)
    texts = copies(4, 70, 100) + [t + " tail" * k for k, t in enumerate(copies(5, 20, 100))]
    rows = list(enumerate(texts))
    assert groups(make(rows), 85) == brute.near_groups(rows, 85)


def test_documents_of_the_tables(small, small_rows):
    assert groups(small, 85) == brute.near_groups(small_rows, 85)


def test_very_long_text(make):
    long = " ".join(f"x{k}" for k in range(60_000))
    rows = [(1, long), (2, long + " end"), (3, long.upper())]
    assert groups(make(rows), 85) == {1: (59_996, 1), 2: (59_997, 1), 3: (59_996, 1)}


def test_missing_and_repeated_ids(make):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f"), (7, None)]
    out = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in S.near_duplicates(make(rows)).collect())
    assert out == [(-1, -1, True), (-1, -1, True), (3, 3, True), (5, 3, False), (5, 3, False), (7, 7, True)]


def test_kept_documents(make):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h"), (3, "g h"), (4, None), (None, "a b c d e f")]
    df = make(rows, kept="x", rep="y", tiles="z", n="n", component="c")
    out = S.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id or -1 for r in out.collect()) == [-1, 1, 3, 4]


def test_empty(make):
    assert S.near_duplicates(make([])).count() == 0
    assert S.drop_near_duplicates(make([])).count() == 0


def test_signatures_estimate_similarity_and_ranks_are_dealt_once():
    random_ = np.random.default_rng(0)
    errors = []
    for share in (0.3, 0.6, 0.9):
        for _ in range(20):
            both = random_.integers(1, 1 << 63, 400, dtype=np.uint64)
            n = int(400 * share)
            a, b = np.concatenate([both[:n], both[n : n + (400 - n) // 2]]), np.concatenate([both[:n], both[n + (400 - n) // 2 :]])
            signed = S.signatures(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, 150)
            errors.append((signed[0] == signed[1]).mean() - n / 400)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05
    # One element alone gives each rank to one place.
    assert sorted(np.floor(S.signatures(np.array([9], np.uint64), np.array([0]), 1, 32)[0])) == list(range(32))


def test_signature_does_not_depend_on_the_batch():
    values = W.mix64(np.arange(1000, dtype=np.uint64))
    alone = [S.signatures(values[:5], np.zeros(5, int), 1, 60), S.signatures(values[5:], np.zeros(995, int), 1, 60)]
    both = S.signatures(values, np.repeat([0, 1], [5, 995]), 2, 60)
    assert np.array_equal(both, np.concatenate(alone))
