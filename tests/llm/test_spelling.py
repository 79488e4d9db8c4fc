import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from msgflow.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def neighbours(words):
    """All near pairs of a vocabulary: by the words without one letter, then checked."""
    by_rest = defaultdict(set)
    for w in words:
        for rest in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            by_rest[rest].add(w)
    out = defaultdict(set)
    for some in by_rest.values():
        for a in some:
            out[a] |= {b for b in some if b != a and is_near(a, b)}
    return out


def plain(rows, least_letters=6, least_times=5, ratio=5):
    count = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= least_letters and c >= least_times}
    near = neighbours(n)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= ratio * n[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root(w)) for w in n)


def found(df, **more):
    columns = ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(tuple(r) for r in spelling.spelling_groups(df, **more).select(columns).collect())


def corpus(seed=1):
    """Frequent words, rarer ones an error away from them, and still rarer ones an error further."""
    r = random.Random(seed)

    def edited(w):
        at = r.randrange(len(w))
        return w[:at] + r.choice(["", "a", "é", "zz"]) + w[at + r.randrange(2) :]

    words = ["".join(r.choice(["an", "er", "té", "io", "s", "x"]) for _ in range(r.randrange(4, 8))) for _ in range(60)]
    pool = []
    for w in words:
        one = edited(w)
        pool += [w] * 200 + [one] * 35 + [edited(one)] * 6 + [edited(w)] * 5
    r.shuffle(pool)
    rows = []
    for i in range(0, len(pool), 50):
        own = [w.upper() if r.random() < 0.2 else w for w in pool[i : i + 50]]
        rows.append((i * 7, r.choice([" ", ", ", "1", "中", "-"]).join(own)))
    return rows


def test_equals_plain_version(make):
    rows = corpus()
    want = plain(rows)
    assert sum(w[3] is not None for w in want) > 20 and any(w[5] != w[0] and w[5] != w[3] for w in want)
    assert found(make(rows, word="a", n="b", form="c").repartition(4)) == want


def test_documents_of_the_tables(small, small_rows):
    assert found(small) == plain(small_rows)


@pytest.mark.parametrize(("tile", "pack"), [(3, 1), (16, 40), (1 << 14, 1), (1 << 14, 1 << 14)])
def test_tiles_and_packs_change_nothing(spark, tile, pack):
    r = random.Random(tile)
    words = sorted({"".join(r.choice("abcé") for _ in range(r.randrange(6, 9))) for _ in range(700)})
    n = {w: r.randrange(5, 9) for w in words}
    near = neighbours(words)
    want = sorted((w, len(x), *min((-n[b], b) for b in x)) for w, x in near.items() if x)
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)
    got = sorted((x.word, x.n_near, -x.form_n, x.form) for x in spelling.near_words(df, tile, pack).collect())
    assert got == want


def as_arrays(words):
    lengths = np.array([len(w) for w in words], np.int64)
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64), lengths


@pytest.mark.parametrize("seed", range(5))
def test_index_against_all_pairs(seed):
    r = random.Random(seed)
    words = sorted({"".join(r.choice("abé") for _ in range(r.randrange(1, 8))) for _ in range(300)})
    index = spelling.PositionIndex(*as_arrays(words))
    got = {(words[a], words[b]) for q, w in index.near(*as_arrays(words), np.zeros(len(words), np.int64)) for a, b in zip(q, w)}
    assert got == {(a, b) for a in words for b in words if a != b and is_near(a, b)}


def test_words_that_share_first_letters_can_be_left_out():
    words = ["abcdef", "abcdex", "xbcdef", "abxdef"]
    index = spelling.PositionIndex(*as_arrays(words))
    got = {(words[a], words[b]) for q, w in index.near(*as_arrays(words), np.full(4, 3)) for a, b in zip(q, w)}
    assert got == {(a, b) for a, b in [("abcdef", "xbcdef"), ("xbcdef", "abcdef"), ("abcdef", "abxdef"), ("abxdef", "abcdef")]}


def test_groups_cross_batches():
    rows = pa.RecordBatch.from_pydict(
        {"word": list("abcdefgh"), "weight": [1] * 8, "side": [0] * 8, "size": [6] * 8,
         "key": list("aabbbbbc"), "row": [0] * 8, "column": [0] * 8}
    )
    for step in range(1, 9):
        batches = [rows.slice(k, step) for k in range(0, 8, step)]
        for pack in (1, 3, 100):
            parts = [p.to_pydict()["key"] for p in spelling._whole_groups(iter(batches), pack)]
            assert "".join(c for p in parts for c in p) == "aabbbbbc"
            assert not any(a[-1] == b[0] for a, b in zip(parts, parts[1:]))


def test_nulls_repeats_ties_and_long_words(make):
    long = "ab" * 20_000
    rows = [(None, "Straße straße"), (1, None), (2, ""), (3, long), (4, long + "x")] + [(9, "straße strasse straßen")] * 6
    rows += [(20 + k, f"{long} {long}x grueben gruebex") for k in range(6)]
    assert found(make(rows)) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "few words here")]])
def test_no_words(make, rows):
    assert found(make(rows)) == []


def test_one_letter_words_are_refused(make):
    with pytest.raises(ValueError):
        spelling.spelling_groups(make([]), least_letters=1)
