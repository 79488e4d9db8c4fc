import pytest

from msgflow.llm import decontaminate as D


@pytest.fixture(scope="module")
def items(spark):
    passage = " ".join(f"item{k}" for k in range(40))
    rows = [(1, passage), (2, "Ten short words, in all: they are EXACTLY ten!"), (3, "too short"), (4, None), (5, ""), (9, passage), (None, "q " * 40)]
    return spark.createDataFrame(rows, "item_id long, text string")


def hits(df, items, **options):
    return {(r.doc_id, r.item_id): r for r in D.leaks(df, items, **options).collect()}


FILL = " ".join(f"fill{k}" for k in range(30))


def item(*changes, low=0, high=40):
    return " ".join("other" if k in changes else f"item{k}" for k in range(low, high))


def test_verbatim_changed_case_and_marks(make, items):
    rows = [
        (1, f"{FILL} {item()} {FILL}"),
        (2, item().upper().replace(" ", ", ")),
        (3, f"{FILL} ten SHORT words in all -- they are exactly ten {FILL}"),
        (4, FILL), (5, None), (6, ""), (7, "too short"),
    ]
    got = hits(make(rows), items)
    assert set(got) == {(1, 1), (2, 1), (3, 2)}
    r = got[1, 1]
    assert (r.doc_start, r.doc_end, r.item_start, r.item_end, r.overlap) == (30, 70, 0, 40, 1.0)


@pytest.mark.parametrize("step", [3, 5, 9])
def test_substitutions(make, items, step):
    """Every fifth or ninth word exchanged is found; every third is below the similarity."""
    changed = range(step - 1, 40, step)
    got = hits(make([(1, f"{FILL} {item(*changed)} {FILL}")]), items)
    assert bool(got) == (step != 3)


def test_part_of_an_item(make, items):
    got = hits(make([(1, f"{FILL} {item(low=12, high=27)} {FILL}"), (2, f"{FILL} {item(low=12, high=20)} {FILL}")]), items)
    assert set(got) == {(1, 1)}


def test_plain_version_agrees(make, items):
    """All alignments of all documents and items, with the hit rule replaced by every place."""
    import random

    r = random.Random(5)
    rows = []
    for i in range(40):
        words = item(*[k for k in range(40) if r.random() < 0.12]).split()
        cut = r.randrange(30)
        rows.append((i, f"{FILL} {' '.join(words[cut:])} {FILL}"))
    got = {i for i, _ in hits(make(rows), items)}
    base = item().split()
    for i, text in rows:
        own = text.split()
        best, plain = 0, False
        for ahead in range(-40, len(own)):
            for low in range(max(0, -ahead), min(40, len(own) - ahead) - 12):
                best = max(best, sum(own[ahead + k] == base[k] for k in range(low, low + 13)) / 13)
            for low in range(max(0, -ahead), min(40, len(own) - ahead) - 12):
                plain |= own[ahead + low : ahead + low + 13] == base[low : low + 13]
        if plain:
            assert i in got
        if best < 0.8:
            assert i not in got


def similar(own, base, region=13):
    """The best share of equal tokens over all alignments and windows of one item."""
    n, best = min(region, len(base)), 0
    for ahead in range(-len(base), len(own)):
        for low in range(max(0, -ahead), min(len(base), len(own) - ahead) - n + 1):
            best = max(best, sum(own[ahead + k] == base[k] for k in range(low, low + n)) / n)
    return best


def test_every_pattern_of_exchanged_words(spark, make):
    """Whole items of 8 to 13 words and excerpts with every choice of up to three exchanged words: found equals similar."""
    from itertools import combinations

    bases = {n: [f"w{n}x{k}" for k in range(n)] for n in range(8, 14)} | {40: [f"item{k}" for k in range(40)]}
    table = spark.createDataFrame([(n, " ".join(words)) for n, words in bases.items()], "item_id long, text string")
    texts = []
    for n, words in bases.items():
        for low, size in ((9, 13), (20, 15)) if n == 40 else ((0, n),):
            for count in range(4):
                for gone in combinations(range(size), count):
                    texts.append((n, ["pre"] + ["other" if k in gone else words[low + k] for k in range(size)] + ["post"]))
    got = hits(make([(i, " ".join(own)) for i, (_, own) in enumerate(texts)]), table)
    best = {(i, n): similar(own, bases[n]) for i, (n, own) in enumerate(texts)}
    assert {k: r.overlap for k, r in got.items()} == {k: x for k, x in best.items() if x >= 0.8}


def test_dropped_documents(make, items):
    df = make([(1, item()), (1, "clean"), (2, FILL), (None, item()), (3, None), (4, FILL)], seed="a", tokens="b", item_id="c", place="d")
    out = D.drop_leaks(df, items)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3, 4]


def test_rounds(make, items, monkeypatch):
    rows = [(1, f"{FILL} {item()} {FILL}"), (2, "ten short words in all they are exactly ten")]
    whole = {k: tuple(r) for k, r in hits(make(rows), items).items()}
    monkeypatch.setattr(D, "SEED_ROWS", 5)
    assert {k: tuple(r) for k, r in hits(make(rows), items).items()} == whole


def test_pieces(make, items, monkeypatch):
    """Passages across the ends of pieces, at both ends of a document, and documents shorter than a piece."""
    rows = [(k, f"{item(low=40 - k)} {FILL} {item(5, 11, 17, 23)} {FILL} {item(high=k)}") for k in range(1, 41)]
    rows += [(50, item(high=13)), (51, item(3, 7, high=13)), (52, item(3, 7, 9, high=13)), (53, item(high=12)), (54, "item0"), (55, "")]
    whole = {k: tuple(r) for k, r in hits(make(rows), items).items()}
    assert {50, 51} < {i for i, _ in whole} and not {52, 53, 54, 55} & {i for i, _ in whole}
    for piece in (1, 7, 13):
        monkeypatch.setattr(D, "PIECE", piece)
        assert {k: tuple(r) for k, r in hits(make(rows), items).items()} == whole


def test_long_document_of_one_passage(make, items):
    """48,000 hits in one document of 20,000 tokens: a hit holds the tokens around it, not those of its document."""
    got = hits(make([(1, f"{item()} " * 500), (2, FILL)]), items)
    r = got[1, 1]
    assert set(got) == {(1, 1)}
    # Masks of 6, 9 and 12 tokens fit 35, 32 and 29 places of 40.
    assert (r.n_hits, r.overlap, r.doc_start, r.doc_end, r.item_start, r.item_end) == (500 * 96, 1.0, 0, 20_000, 0, 40)


def test_dropped_long_document(make, items):
    out = D.drop_leaks(make([(1, f"{item()} " * 500), (2, FILL)]), items)
    assert [r.doc_id for r in out.collect()] == [2]


def test_empty(spark, make, items):
    assert D.leaks(make([]), items).count() == 0
    assert D.leaks(make([(1, FILL)]), items.limit(0)).count() == 0
    assert D.drop_leaks(make([(1, FILL)]), items.limit(0)).count() == 1


def test_planted_in_the_tables(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in D.leaks(documents, benchmark).collect()}
    plain = {
        (d.doc_id, b.item_id)
        for d in documents.collect()
        for b in benchmark.collect()
        if b.text in d.text
    }
    assert plain and plain <= got
