import hashlib
import random

import pytest

from msgflow.llm import phrases
from tests.llm import brute


def found(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in phrases.repeats(df).collect()}


def corpus():
    r = random.Random(3)
    pool = [f"w{k}" for k in range(300)]
    passages = [[r.choice(pool) for _ in range(n)] for n in (19, 20, 21, 35, 60, 120)]
    rows = []
    for i in range(80):
        text = [r.choice(pool) for _ in range(r.randrange(60))]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(text) + 1)
            part = list(r.choice(passages))
            if r.random() < 0.3:
                part[r.randrange(len(part))] = "edited"
            text[at:at] = part
        rows.append((i * 3 % 97 * 10 + i % 10, r.choice(" \n\t").join(text)))
    rows += [(5000, "a " * 500), (5001, "b c " * 40 + "a " * 30), (5002, None), (5003, ""), (5004, "  \t "), (5005, "a " * 19)]
    rows += [(6000 + k, rows[k][1]) for k in range(10)]
    return sorted(dict(rows).items())


def test_equals_plain_version(make):
    rows = corpus()
    assert found(make(rows).repartition(5)) == brute.without_repeats(rows)


def test_documents_of_the_tables(small, small_rows):
    assert found(small) == brute.without_repeats(small_rows)


def test_very_long_text(make):
    rows = [(1, " ".join(f"x{k}" for k in range(200_000))), (2, " ".join(f"x{k}" for k in range(150_000, 250_000)))]
    assert found(make(rows)) == brute.without_repeats(rows)


def test_words_are_split_at_ascii_white_space_only(make):
    one = " ".join(f"é {k} x" for k in range(25))
    rows = [(1, one), (2, one.replace(" ", "\x0b\x0c\r\n"))]
    assert found(make(rows)) == brute.without_repeats(rows)


def test_text_with_passages_cut_out(make):
    rows = corpus()
    df = make(rows, removed="a", n_words="b", place="c")
    out = phrases.drop_repeats(df)
    assert out.columns == df.columns
    want = brute.without_repeats(rows)
    for r in out.collect():
        n, gone, digest = want[r.doc_id]
        kept = " ".join(brute.words(r.text))
        assert hashlib.sha256(kept.encode()).hexdigest() == digest
        if not gone:
            assert r.text == dict(rows)[r.doc_id]


def test_missing_and_repeated_ids(make):
    text = " ".join(f"t{k}" for k in range(30))
    out = phrases.repeats(make([(None, text), (4, text), (4, text), (9, text), (9, "x " + text)])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in out) == [(-1, 30), (4, 0), (4, 0), (9, 30), (9, 30)]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "few words")]])
def test_nothing_to_remove(make, rows):
    out = phrases.repeats(make(rows)).collect()
    assert [(r.doc_id, r.n_removed) for r in out] == [(i, 0) for i, _ in rows]
