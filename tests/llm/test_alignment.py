import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from msgflow.llm import alignment

PATHS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def both():
    raw = []
    for path in PATHS:
        with open(path, "rb") as f:
            raw.append(f.read())
    return alignment.Tokenizers(*raw)


def spans(ids, table):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(table[i])))
        at += len(table[i])
    return out


def plain(both, rows):
    """The report from its definition: every A token against every B token of its document."""
    held, count = [], Counter()
    library = Tokenizer.from_file(PATHS[0])
    library.encode_special_tokens = True
    for i, text in rows:
        a = library.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        joined = [b"".join(t[x] for x in ids) for t, ids in ((both.bytes_a, a), (both.bytes_b, b))]
        if not text or any(x != (" " + text).encode() for x in joined):
            a = b = []
        at_a, at_b = spans(a, both.bytes_a), spans(b, both.bytes_b)
        links = [(x, y) for x, (l, h) in zip(a, at_a) for y, (m, k) in zip(b, at_b) if l < k and m < h]
        shared = sorted({h for _, h in at_a} & {h for _, h in at_b})
        groups, low = [], 0
        for high in shared:
            inside = [[str(x) for x, (l, h) in zip(ids, at) if low <= l and h <= high] for ids, at in ((a, at_a), (b, at_b))]
            groups.append("|".join(",".join(part) for part in inside))
            low = high
        count.update(set(links))
        held.append((i, a, b, groups, links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [
        (
            i, len(a), len(b), len(groups), len(links),
            sum(count[l] == best[l[0]] for l in links),
            sum(count[l] for l in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for i, a, b, groups, links in held
    ]


def found(df):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r) for r in alignment.alignment_report(df, *PATHS).select(columns).collect()]


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def texts():
    r = random.Random(5)
    pool = ["word", "tion", "Grüße", "中文", "\U0001f600", "\n", "\t", "  ", "1234", "<s>", "<|endoftext|>", "<0x41>", "''", "é"]
    rows = [(k, r.choice(["", " "]).join(r.choice(pool) for _ in range(r.randrange(1, 40)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, " "), (103, "▁x"), (104, "ﬁ x"), (None, "no id"), (3, rows[3][1]), (3, rows[3][1])]
    return rows


def test_equals_plain_version(make, both):
    rows = texts()
    assert by_id(found(make(rows, a="x", block="y", place="z").repartition(3))) == by_id(plain(both, rows))


def test_counts_over_several_blocks(make, both, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 200)
    rows = texts()
    assert by_id(found(make(rows).coalesce(2))) == by_id(plain(both, rows))


def test_documents_of_the_tables(small, small_rows, both):
    short = [(i, t) for i, t in small_rows if len(t or "") < 1500]
    got = {r[0]: r for r in found(small)}
    assert len(got) == len(small_rows)
    for row in plain(both, short):
        assert got[row[0]][:5] == row[:5] and got[row[0]][7] == row[7]


@pytest.mark.parametrize("longest", [1, 2, 7, 2048])
def test_lanes_change_nothing(both, longest):
    rows = [t or "" for _, t in texts()]
    tokens = both.encode(rows)
    whole, cut = alignment.lockstep(tokens, 1 << 30), alignment.lockstep(tokens, longest)
    for name in ("cut_a", "cut_b"):
        assert np.array_equal(getattr(whole, name), getattr(cut, name))
    pairs = [sorted(zip(m.link_a.tolist(), m.link_b.tolist())) for m in (whole, cut)]
    assert pairs[0] == pairs[1]


def test_steps_do_not_grow_with_the_longest_text(both):
    tokens = both.encode(["some plain words in a row " * 20_000, "short"])
    begin, _, stop = alignment.lanes(tokens)
    assert (stop - begin).max() < 3 * alignment.LANE and (stop - begin).sum() == len(tokens.ids_a)


def test_links_and_cuts_as_lists(make, both):
    rows = [(1, "internationalisation of texts"), (2, None), (3, "x")]
    for r in alignment.align(make(rows), *PATHS).collect():
        text = dict(rows)[r.doc_id]
        at_a, at_b = spans(r.a, both.bytes_a), spans(r.b, both.bytes_b)
        want = [(x, y) for x, (l, h) in enumerate(at_a) for y, (m, k) in enumerate(at_b) if l < k and m < h]
        assert [tuple(x) for x in r.links] == want
        for a, b in r.cuts:
            assert at_a[a - 1][1] == at_b[b - 1][1]
        assert bool(r.a) == bool(text)


def test_no_rows(make):
    assert found(make([])) == []
