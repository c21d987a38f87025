"""Alignment, ranked search and line dedup against plain versions, on ordinary and on odd rows."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from compare import connect, differences
from llm import brute
from llm.test_operators import corpus, empty, frame, prose
from tokenizers import Tokenizer

import public_tokenizers
from matchloom.llm import ORACLES, QUERIES, align, lines, search
from matchloom.llm.tokens import byte_characters

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ORACLES)
def test_query_against_its_sql(spark, name):
    with connect(SF) as connection:
        assert differences(spark, connection, SF, name, QUERIES[name], ORACLES[name]) == []


# --- line dedup -----------------------------------------------------------------

LICENSE = "Permission is granted to copy this text."


def shared_lines():
    """A line in most documents, lines at every border of the rule, and lines that only look alike."""
    rng = random.Random(3)
    docs = [(i, "\n".join([prose(i, 12), LICENSE, prose(i + 500, 9)])) for i in range(100, 160)]
    docs += [
        (1, None), (2, ""), (3, "\n"), (4, "\n\n  \n"),
        (5, f"  {LICENSE.upper()}\t\r\n{LICENSE}\n{LICENSE}"),  # three lines of one key, in one document
        (6, "in two documents only, so it stays"), (7, "in two documents only, so it stays\nx"),
        (10, "nineteen characters"), (11, "nineteen characters"), (12, "nineteen characters"),
        (13, "exactly 20 character"), (14, "exactly 20 character\n"), (15, "EXACTLY 20 CHARACTER"),
        (20, "ééééééééééééééééééé"), (21, "ééééééééééééééééééé"), (22, "ééééééééééééééééééé"),  # 19, 38 bytes
        (23, "éééééééééééééééééééé"), (24, "éééééééééééééééééééé"), (25, "éééééééééééééééééééé"),
        (26, "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ"),  # only A-Z are lowered
        (30, "a line of text, with\x00a zero byte"), (31, "a line of text, with\x00a zero byte"), (32, "a line of text, with\x00a zero byte"),
        (33, "no-break space is kept "), (34, "no-break space is kept"), (35, "no-break space is kept"),
        (40, "\n".join(rng.choice(["one of two lines in it", "the other of two lines"]) for _ in range(3000))),
        (41, "one of two lines in it"), (42, "one of two lines in it\nthe other of two lines"), (-5, "the other of two lines"),
    ]
    return docs


def test_lines_as_brute_force(spark):
    docs = shared_lines()
    got = {r.doc_id: (r.n_lines, r.n_dropped, bytes(r.kept).decode()) for r in lines.drop_lines(frame(spark, docs)).collect()}
    assert got == brute.kept_lines(docs)
    digests = {r.doc_id: r.kept_sha256 for r in lines.drop_lines(frame(spark, docs), digest=True).collect()}
    assert digests == {i: hashlib.sha256(x[2].encode()).hexdigest() for i, x in got.items()}


@pytest.mark.parametrize("least, documents", [(0, 2), (1, 1), (20, 5), (20, 60), (20, 61)])
def test_lines_with_other_parameters(spark, least, documents):
    docs = [(i, t) for i, t in shared_lines() if least or t]  # with 0, an empty line counts like any other
    got = {r.doc_id: r.n_dropped for r in lines.keep_bitmaps(frame(spark, docs), least, documents)
           .withColumnRenamed("name", "doc_id").collect()}
    assert got == {i: x[1] for i, x in brute.kept_lines(docs, least, documents).items()}


def test_lines_over_many_ranges(spark):
    """A hash that fills several ranges is decided as a whole."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        docs = [(i, f"{LICENSE}\nline {i % 7} of a few that recur" + "\n" + prose(i, 5)) for i in range(400)]
        got = {r.doc_id: (r.n_lines, r.n_dropped, bytes(r.kept).decode()) for r in lines.drop_lines(frame(spark, docs)).collect()}
        assert got == brute.kept_lines(docs)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("seed", range(30))
def test_streamed_ranges_cut_anywhere(seed):
    """Decided rows, and undecided rows counted over all ranges, are together what a count of everything says."""
    rng = random.Random(seed)
    rows = [(rng.randrange(6), rng.randrange(2), rng.randrange(12), 0, [rng.randrange(9)]) for _ in range(rng.randrange(1, 120))]
    rows = sorted(rows, key=lambda r: (r[0], r[1], -r[2]))
    holders = defaultdict(set)
    for hi, lo, name, *_ in rows:
        holders[hi, lo].add(name)
    expected = Counter((r[2], *r[4]) for r in rows if len(holders[r[:2]]) >= 3 and max(holders[r[:2]]) != r[2])
    cuts = sorted(rng.choices(range(len(rows) + 1), k=rng.randrange(5)))
    schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("name", pa.int64()), ("digest", pa.int64()), ("places", pa.list_(pa.int32()))])
    out = []
    for begin, end in zip([0, *cuts], [*cuts, len(rows)]):
        part, batches = rows[begin:end], []
        while part:
            size = rng.randrange(1, 9)
            batches.append(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part[:size]), schema)], schema=schema))
            part = part[size:]
        out += [tuple(r.values()) for b in lines._stream(3)(iter(batches)) for r in b.to_pylist()]
    undecided = defaultdict(set)
    for hi, lo, name, *_ in out:
        if hi is not None:
            undecided[hi, lo].add(name)
    gone = Counter(
        (r[2], *r[4]) for r in out if r[0] is None or (len(undecided[r[:2]]) >= 3 and max(undecided[r[:2]]) != r[2])
    )
    assert gone == expected


def test_lines_of_repeated_rows_and_rows_without_id(spark):
    """Rows with one id are one document, whatever their texts; those without an id are one, below all others."""
    other = "Another line that documents share."
    docs = frame(spark, [(1, LICENSE), (1, LICENSE), (1, f"x\n{LICENSE}"), (None, LICENSE), (None, f"{LICENSE}\ny"), (2, "z"),
                         (7, f"{other}\nq"), (8, other), (None, other)])
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, bytes(r.kept)) for r in lines.drop_lines(docs).collect())
    licensed = LICENSE.encode()
    assert got == Counter([
        (1, 1, 0, licensed), (1, 1, 0, licensed), (1, 2, 0, b"x\n" + licensed), (None, 1, 0, licensed), (None, 2, 0, licensed + b"\ny"),
        (2, 1, 0, b"z"), (7, 2, 1, b"q"), (8, 1, 0, other.encode()), (None, 1, 1, b""),
    ])


# --- ranked search ----------------------------------------------------------------

def searched(spark, docs, items, **options):
    items = spark.createDataFrame(items, "item_id long, text string, n long, bag string, score string, rank int, class int")
    found = search.search(frame(spark, docs), items, **options).collect()
    assert len({(r.item_id, r["rank"]) for r in found}) == len(found)
    return {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in found}


def asked(pairs):
    return [(i, t, 1, "x", "y", 2, 3) for i, t in pairs]


ITEMS = [
    (1, "the of and to"), (2, prose(1, 30)), (3, None), (4, ""), (5, "?!"), (6, "ONE one One"), (7, "nowheretobefound"),
    (8, "漢字 ünïcødé"), (9, prose(5, 500)), (10, "of"), (11, "aaaa"),
]


@pytest.mark.parametrize("block_terms", [100_000, 40])
def test_search_as_brute_force(spark, block_terms):
    docs = corpus() + [(i, "of the") for i in range(300, 340)] + [(i, prose(i, 20)) for i in range(400, 480)]
    assert searched(spark, docs, asked(ITEMS), block_terms=block_terms) == brute.ranking(docs, ITEMS)


def test_search_breaks_ties_by_document_across_classes(spark):
    """Different bags with one score: their documents interleave by id."""
    docs = [(i, "alpha common" if i % 2 else "beta common") for i in range(1, 41)] + [(i, "filler words here") for i in range(50, 90)]
    items = [(1, "alpha beta"), (2, "common")]
    got = searched(spark, docs, asked(items))
    assert got == brute.ranking(docs, items)
    assert [got[1, n][0] for n in range(1, 11)] == list(range(1, 11))


def test_search_of_few_and_of_repeated_rows(spark):
    docs = [(1, "alpha"), (2, None), (3, "beta")]
    assert searched(spark, docs, asked([(1, "alpha"), (1, "alpha")])) == brute.ranking(docs, [(1, "alpha")])
    twice = search.search(frame(spark, [(4, "alpha"), (4, "alpha"), (None, "alpha"), (5, "beta gamma")]),
                          spark.createDataFrame([(1, "alpha")], "item_id long, text string"))
    assert [r.doc_id for r in twice.orderBy("rank").collect()] == [4, 4, None]


def test_search_without_documents_or_items(spark):
    assert searched(spark, corpus(), asked([(3, None)])) == {}
    assert searched(spark, [(1, None), (2, "?")], asked(ITEMS)) == {}
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert search.search(empty(spark), nothing).collect() == []
    assert search.search(empty(spark), nothing.union(spark.createDataFrame([(1, "a")], nothing.schema))).collect() == []


# --- alignment ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte = {c: x for x, c in byte_characters().items()}

    def spell_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return (lambda t: a.encode(t, add_special_tokens=False).ids, lambda i: bytes(byte[c] for c in a.id_to_token(i)),
            lambda t: b.encode(t), spell_b)


ODD = [
    (50, " "), (51, "a ▁ b"), (52, "x <|endoftext|> <s> </s> <unk> <0x0A> y"), (53, "ﬁ ½ Ⅷ"), (54, "a\x00b"), (55, "\n\n\t x  y   z "),
    (56, "é 가"), (57, "漢" * 3000), (58, " leading"), (59, "​﻿"), (60, "1234567890 " * 50),
]


@pytest.mark.parametrize("hot_pairs", [1 << 20, 100, 1])
def test_alignment_as_brute_force(spark, plain, hot_pairs):
    docs = corpus() + ODD
    expected = brute.alignment([t for _, t in docs], *plain)
    counts = Counter(pair for *_, links in expected for pair in links)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    wanted = {
        i: (n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(groups.encode()).hexdigest() if links else "")
        for (i, _), (n_a, n_b, groups, links) in zip(docs, expected)
    }
    got = {r.doc_id: tuple(r)[1:] for r in align.align(frame(spark, docs), A, B, hot_pairs=hot_pairs).collect()}
    assert got == wanted
    assert wanted[51][0] == 0 and wanted[52][0] > 0


def test_alignment_outputs(spark, plain):
    rows = align.aligned(frame(spark, [(1, "The thing is, therefore, done.")]), A, B).collect()
    (n_a, n_b, groups, links), = brute.alignment(["The thing is, therefore, done."], *plain)
    assert (rows[0].n_a, rows[0].n_b, rows[0].groups, rows[0].n_groups) == (n_a, n_b, groups, len(links))
    pairs = Counter({(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(rows[0].pairs, rows[0].times)})
    assert pairs == Counter(links)
    assert rows[0].cuts[-1] == len(" The thing is, therefore, done.")


def test_alignment_of_repeated_rows_and_no_rows(spark):
    assert align.align(empty(spark), A, B).collect() == []
    rows = align.align(frame(spark, [(1, "the cat"), (1, "the cat"), (None, "the cat"), (1, None)]), A, B).collect()
    assert Counter((r.doc_id, r.n_a > 0, r.count_sum) for r in rows) == Counter(
        [(1, True, 6), (1, True, 6), (None, True, 6), (1, False, 0)]
    )


def test_lockstep_cuts_where_ends_meet():
    rng = np.random.default_rng(5)
    texts = [rng.integers(1, 60) for _ in range(50)]

    def tokens(sizes):
        found = align.Tokens.__new__(align.Tokens)
        found.first = np.concatenate([[0], np.cumsum([len(x) for x in sizes])])
        found.ids = np.zeros(found.first[-1], dtype=np.int64)
        found.ends = np.concatenate([np.cumsum(x) for x in sizes])
        return found

    def random_sizes(total):
        cuts = np.unique(np.append(rng.integers(1, total + 1, rng.integers(0, total)), total))
        return np.diff(np.concatenate([[0], cuts]))

    a, b = (tokens([random_sizes(n) for n in texts]) for _ in range(2))
    cut_a, cut_b = align.lockstep(a, b)
    for k in range(len(texts)):
        x, y = slice(a.first[k], a.first[k + 1]), slice(b.first[k], b.first[k + 1])
        both = np.intersect1d(a.ends[x], b.ends[y])
        assert a.ends[x][cut_a[x]].tolist() == b.ends[y][cut_b[y]].tolist() == both.tolist()
