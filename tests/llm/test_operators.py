"""Each corpus operator against a plain version, on ordinary and on odd rows."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm import brute
from pyspark.sql import functions as F

import public_tokenizers
from matchloom.llm import arrow_ids, bpe, embeddings, fingerprints, packing, quality, simhash, suffix, toxicity, warc
from matchloom.llm import QUERIES
from matchloom.llm.common import components
from matchloom.llm.tokens import TextEncoder

DOCS = "doc_id long, text string, id string, hash string, bucket int, score double, k0 int, data int, n_chars long"
WORDS = "the of and to in that is was for with on as by at from their ing tion ly er".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def corpus():
    base = prose(1, 300)
    words = base.split()
    near = " ".join([*words[:150], "changed", *words[151:]])
    passage = prose(2, 120)
    return [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \n "), (7, "One"), (8, "one"),
        (9, prose(3, 80) + " " + passage), (10, passage + " " + prose(4, 90)), (11, passage),
        (12, "Ünïcødé ßtraße 漢字 🎉 " * 40), (13, "of " * 4000), (14, prose(5, 6000)), (15, "a" * 3000), (20, base.upper()),
        (21, "one <|endoftext|> two <|startoftext|>"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus())


def frame(spark, rows):
    """A documents table with more columns, whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "x", "y", 1, 0.5, 7, 8, len(t or "")) for i, t in rows], DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def by(df, *columns):
    return {r[0]: tuple(r)[1:] if len(columns) > 2 else r[1] for r in df.select(*columns).collect()}


# --- connected components, vectors ---------------------------------------------

def test_components_of_paths_stars_and_repeated_links(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(100, 101), (7, 7), (60, 50), (50, 55)]
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = brute.groups({x for pair in links for x in pair}, links)
    assert got == {i: r for i, r in expected.items() if i != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + rng.normal(size=16) * (0.15 if i % 3 else 0.02)).tolist()) for i in range(150)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, [2 * x for x in rows[1][1]]), (203, None), (204, [0.0] * 16), (205, [])]
    rows += [(206, [float("nan")] * 16), (207, [float("inf")] + [0.0] * 15), (208, [None] + [1.0] * 15), (209, [1.0, 2.0]), (210, [2.0, 4.0])]
    return rows


@pytest.mark.parametrize("block", [512, 8])
def test_vectors_link_by_cosine(spark, block):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, slot int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df, block=block).collect()}
    assert got == brute.vectors(rows)


def test_estimates_hold_their_bounds_and_no_vectors_give_no_rows(spark):
    coder = embeddings.Coder(64, 10, 13)
    x = np.random.default_rng(1).normal(size=(400, 64))
    x[200:] = x[:200] + 0.3 * x[200:]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = np.arange(200), np.arange(200, 400)
    value, bound = coder.estimate(coder.encode(x), i, j)
    error = value - (x[i] * x[j]).sum(axis=1)
    assert abs(error.mean()) < 0.02 and (np.abs(error) <= bound).all()
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_packed_codes_come_back_and_short_codes_keep_pairs():
    coder = embeddings.Coder(48, 9, 13)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95 ** 2) * side  # all at the threshold
    codes = coder.encode(x)
    back = coder.unpack(coder.pack(codes))
    assert codes.keys() == back.keys() and all((codes[k] == back[k]).all() for k in codes)
    differ = np.bitwise_count(coder.short(codes) ^ coder.short(coder.encode(y))).sum(axis=1)
    limit = embeddings.most_different(48, 9, 13, 0.95)
    assert differ.max() <= limit < np.bitwise_count(coder.short(codes)[:1500] ^ coder.short(codes)[1500:]).sum(axis=1).mean() - 20


@pytest.mark.parametrize("dim", [3, 64])
def test_vectors_at_the_threshold_and_without_id(spark, dim):
    """Pairs from 0.94 to 0.96, a group of near copies, and rows that nothing links to."""
    rng = np.random.default_rng(dim)
    rows = []
    for i, cosine in enumerate(np.linspace(0.94, 0.96, 60)):
        a, b = np.linalg.qr(rng.normal(size=(dim, 2)))[0].T
        rows += [(2 * i, (a * 3).tolist()), (2 * i + 1, (cosine * a + np.sqrt(1 - cosine ** 2) * b).tolist())]
    centre = rng.normal(size=dim)
    rows += [(1000 + i, (centre + rng.normal(size=dim) * 0.02).tolist()) for i in range(80)]
    df = spark.createDataFrame([(i, v) for i, v in rows] + [(None, rows[0][1])], "vec_id long, embedding array<double>")
    found = embeddings.near_duplicates(df, block=16).collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in found if r.vec_id is not None}
    assert got == brute.vectors(rows)
    assert [(r.n_links, r.kept) for r in found if r.vec_id is None] == [(0, True)]


# --- fingerprints ------------------------------------------------------------------

def test_fingerprints_of_edited_and_next_texts(docs, spark):
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    texts = dict(corpus())
    for i, (size, text, _) in brute.edited(corpus()).items():
        assert got[i].n_chars == size
        assert got[i].edited_sha256 == hashlib.sha256(text.encode()).hexdigest()
        if text == (texts[i] or ""):
            assert got[i].near_edited == 1
    assert got[1].fingerprint == got[2].fingerprint and got[4].fingerprint == got[5].fingerprint
    assert got[2].near_next == 1 and got[14].near_next < 0.1 and 0.3 < got[14].near_edited < 0.7
    assert fingerprints.fingerprints(empty(spark)).count() == 0
    assert fingerprints.fingerprints(frame(spark, [(1, "only one"), (1, "only one"), (None, "x")])).count() == 1


def test_samples_collide_as_often_as_generalised_jaccard(spark):
    rng = random.Random(0)
    counts = [{f"w{i}": rng.choice([1, 1, 2, 9, 40]) for i in range(60)} for _ in range(2)]
    counts[1] |= {k: v for k, v in counts[0].items() if k < "w40"}
    texts = [" ".join(w for w, n in c.items() for _ in range(n)) for c in counts]
    got = {r.doc_id: r for r in fingerprints.fingerprints(frame(spark, [(2, texts[0]), (1, texts[1])]), width=1).collect()}
    keys = counts[0].keys() | counts[1].keys()
    exact = sum(min(c.get(k, 0) for c in counts) for k in keys) / sum(max(c.get(k, 0) for c in counts) for k in keys)
    assert abs(got[2].near_next - exact) < 0.2


# --- repeats -------------------------------------------------------------------------

@pytest.mark.parametrize("hot", [4096, 1])
def test_repeated_bytes_go(docs, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans), bytes(r.kept))
           for r in suffix.remove_repeats(docs, 100).collect()}
    assert got == brute.repeats(corpus(), 100)


def test_two_stage_sorting_finds_every_repeat():
    rng = random.Random(3)
    for _ in range(60):
        width, letters = rng.choice([8, 10, 24]), rng.choice([b"ab", b"a", bytes(range(256))])
        base = bytes(rng.choice(letters) for _ in range(90))
        regions = [base[s:s + rng.randint(width, 60)] + bytes(rng.choice(letters) for _ in range(rng.randint(0, 9)))
                   for s in (rng.randint(0, 30) for _ in range(rng.randint(1, 5)))]
        found = suffix.repeated_starts(regions, np.array([len(r) - width + 1 for r in regions]), width)
        every = [r[p:p + width] for r in regions for p in range(len(r) - width + 1)]
        assert [[every.count(r[p:p + width]) > 1 for p in range(len(r) - width + 1)] for r in regions] == [f.tolist() for f in found]


def test_repeats_of_repeated_rows_and_of_no_rows(spark):
    text = prose(9, 60)
    got = suffix.remove_repeats(frame(spark, [(1, text), (1, text), (None, "short"), (1, "other")]), 50, keep=["n_chars"], as_text=True)
    assert sorted((r.doc_id or 0, r.kept, r.n_chars) for r in got.collect()) == [
        (0, "short", 5), (1, "", len(text)), (1, "", len(text)), (1, "other", 5)]
    assert suffix.remove_repeats(empty(spark)).count() == 0
    half = suffix.remove_repeats(frame(spark, [(1, "é" * 300), (2, "xé" + "é" * 300)]), 50, as_text=True).collect()
    assert {r.kept for r in half} <= {"", "x"}


# --- SimHash ----------------------------------------------------------------------------

@pytest.mark.parametrize("block", [512, 3])
def test_simhash_components(docs, block):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, block=block).collect()}
    assert got == brute.simhashes(corpus())


def test_all_pairs_of_near_hashes_are_linked(spark):
    rng = random.Random(5)
    hashes = {rng.getrandbits(64) for _ in range(150)}
    hashes |= {h ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for h in list(hashes)[:100]}
    rows = [(i, h - (1 << 64) if h >> 63 else h) for i, h in enumerate(sorted(hashes))]
    got = {r.id: r.root for r in components(simhash.linked(spark.createDataFrame(rows, "id long, hash long"), block=16)).collect()}
    whole = {i: h % (1 << 64) for i, h in rows}
    links = [(a, b) for a in whole for b in whole if a < b and (whole[a] ^ whole[b]).bit_count() <= 2]
    assert got == {i: r for i, r in brute.groups(whole, links).items() if i != r}


def test_wide_links_need_alike_shingles(spark):
    words = prose(1, 400).split()
    near = " ".join([*words[:100], "x", *words[101:250], "y", *words[251:]])
    rows = [(1, " ".join(words)), (2, near), (3, prose(2, 400)), (None, prose(7, 50))]
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(frame(spark, rows), most=16, alike=2, similar=0.78).collect()]
    assert sorted(got, key=str) == [(1, 1), (2, 1), (3, 3), (None, None)]
    assert simhash.near_duplicates(empty(spark)).count() == 0


def edited(words, share, block, seed):
    """A copy whose five-word shingles have about the Jaccard similarity ``share`` with those of ``words``."""
    rng, n = random.Random(seed), len(words) - 4
    changed = round(n * (1 - share) / (1 + share))
    new = list(words)
    if block:
        at = rng.randrange(5, len(words) - changed - 5)
        places = range(at, at + changed - 4)
    else:
        places = rng.sample(range(5, len(words) - 5, 5), round(changed / 5))
    for p in places:
        new[p] = f"new{seed}x{p}"
    return new


def test_pairs_of_alike_texts_meet_in_a_posting(spark):
    rows, pairs = [], []
    for k in range(120):
        words = prose(1000 + k, 300).split()
        pair = " ".join(words), " ".join(edited(words, (0.86, 0.9)[k % 2], k % 4 < 2, k))
        rows += [(2 * k, pair[0]), (2 * k + 1, pair[1])]
        pairs.append(brute.jaccard(*pair))
    assert 0.83 < min(pairs) and max(pairs) < 0.93
    found = simhash.near_duplicates(frame(spark, rows), most=16, alike=2, similar=0.6)
    assert by(found, "doc_id", "component_id") == {i: i - i % 2 for i, _ in rows}


@pytest.mark.parametrize("block", [512, 3])
def test_whole_shingle_sets_decide(spark, block):
    """Pairs and a group around the threshold, held against exact similarities."""
    rows = []
    for k in range(60):
        words = prose(2000 + k, 120).split()
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(edited(words, 0.75 + 0.1 * k / 60, k % 2 == 0, k)))]
    words = prose(3000, 120).split()
    rows += [(200 + k, " ".join(edited(words, 0.87, False, k))) for k in range(12)]
    links = [(a, b) for a, s in rows for b, t in rows if a < b and brute.jaccard(s, t) >= 0.8]
    alone = [k for k in range(60) if (2 * k, 2 * k + 1) not in links]
    assert 15 < len(alone) < 45
    found = simhash.near_duplicates(frame(spark, rows), most=16, alike=2, similar=0.8, block=block)
    assert by(found, "doc_id", "component_id") == brute.groups([i for i, _ in rows], links)


# --- classifiers -----------------------------------------------------------------------

def labelled(spark, n=300):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        rows.append((i, prose(i, 60) if not bad else prose(i, 60).replace(" ", "### ")))
        labels.append((i, int(not bad), int(i % 3 == 0)))
    toxic = [(i, t + (" you stupid idiots" if i % 3 == 0 else "")) for i, t in rows]
    return frame(spark, rows), frame(spark, toxic), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_scores_tell_held_out_junk_apart(spark):
    docs, _, labels = labelled(spark)
    machine = quality.fit(docs, labels.filter("doc_id < 200"))
    got = by(quality.score(docs, machine, keep=["doc_id", "k0"]), "doc_id", "score")
    assert all((got[i] > 0.5) == (i % 4 != 0) for i in range(200, 300))
    odd = quality.score(frame(spark, [(1, None), (1, ""), (None, "x")]), machine).collect()
    assert len(odd) == 3 and all(0 <= r.score <= 1 for r in odd)
    assert quality.score(empty(spark), quality.fit(empty(spark), labels.limit(0))).count() == 0


def test_interactions_are_summed_in_linear_time():
    machine = quality.Machine(0.1, np.random.default_rng(1).normal(size=quality.WORDS + quality.STATS),
                              np.random.default_rng(2).normal(size=(quality.WORDS + quality.STATS, quality.RANK)) * 0.05)
    index, value = quality.features("some words and some more words!", 31)
    x = machine.standard(value)
    pairs = sum(machine.factor[index[a]] @ machine.factor[index[b]] * x[a] * x[b] for a in range(len(x)) for b in range(a))
    direct = 1 / (1 + np.exp(-(machine.bias + machine.weight[index] @ x + pairs)))
    assert abs(machine.score(index, value) - direct) < 1e-9


def test_toxicity_scores_and_swapped_identities(spark):
    _, docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels.filter("doc_id < 200"))
    got = by(toxicity.score(docs, model, keep=["doc_id", "score", "k0"]).toDF("doc_id", "before", "k0", "score"), "doc_id", "score")
    assert all((got[i] > 0.5) == (i % 3 == 0) for i in range(200, 300))
    odd = toxicity.score(frame(spark, [(1, None), (1, ""), (None, "x")]), model).collect()
    assert len(odd) == 3 and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score(empty(spark), toxicity.fit(empty(spark), labels.limit(0))).count() == 0


def test_the_penalty_makes_swaps_change_less():
    rng = random.Random(0)
    texts = [f"{prose(i, 8)} {'women' if i % 2 else 'men'} {'awful' if rng.random() < (0.9 if i % 2 else 0.3) else 'fine'}" for i in range(300)]
    y = np.array([float("awful" in t or (i % 2 and rng.random() < 0.4)) for i, t in enumerate(texts)])
    rows = [toxicity.word_features(toxicity.words_of(t)) for t in texts]
    changes = Counter(c for t in texts for c in toxicity.swaps(t))
    free, held = (toxicity.Toxicity.fit(rows, changes, y, np.ones(len(y)), penalty=p) for p in (0.0, 50.0))
    gap = lambda m: abs(m.score("women were fine") - m.score("men were fine"))
    assert gap(held) < 0.2 * gap(free) and held.score("that was awful") > held.score("that was fine") + 0.3


def test_swaps_are_made_one_term_at_a_time_in_each_sentence():
    hashed = lambda *words: set(toxicity.word_features(set(words)).tolist())
    both = toxicity.swaps("Women and men came.")
    assert len(both) == 2 and all(gone and not come for gone, come in both)  # the other member is there already
    assert {frozenset(gone) for gone, _ in both} == {frozenset(hashed("women")), frozenset(hashed("men"))}
    apart = toxicity.swaps("The women came. The men left!\nNobody stayed")
    assert {(frozenset(g), frozenset(c)) for g, c in apart} == {
        (frozenset(hashed("women")), frozenset(hashed("men"))), (frozenset(hashed("men")), frozenset(hashed("women")))}
    assert len(toxicity.swaps("old women")) == 2
    assert toxicity.swaps("") == toxicity.swaps("nobody at all") == set()
    assert toxicity.swaps("deaf " * 50_000) == toxicity.swaps("deaf")


def test_a_text_that_names_both_members_adds_penalty():
    """Texts with both members of a pair alone, of which one goes with the label."""
    texts = [f"women met men. {'women' if i % 2 else 'they'} {'awful' if i % 2 else 'fine'}" for i in range(200)]
    y = np.array([float(i % 2) for i in range(200)])
    rows = [toxicity.word_features(toxicity.words_of(t)) for t in texts]
    model = toxicity.Toxicity.fit(rows, Counter(c for t in texts for c in toxicity.swaps(t)), y, np.ones(200), penalty=50.0)
    assert abs(model.score("women") - model.score("men")) < 0.02


@pytest.mark.parametrize("name, folds, fold, least, label", [
    ("op5_quality", 5, 0, 0.3, "quality"), ("op6_toxicity", 3, 1, 0.7, "toxic"),
])
def test_classifier_queries_hold_out_their_fold(spark, name, folds, fold, least, label):
    """Fold, threshold and held-out separation on the whole table of documents."""
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES[name](spark, sf).collect()}
    docs = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    assert got.keys() == docs
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= least)
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(got[i].score, y) for i, y in known.items() if i in got and got[i].held_out]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert len(good) > 5 and len(bad) > 5
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.88


def test_held_out_labels_and_other_columns_of_labels_change_nothing(spark):
    docs, _, labels = labelled(spark)
    shared = labels.withColumn("text", F.lit("x")).withColumn("score", F.lit(1.0)).withColumn("n_chars", F.lit(3))
    base = by(quality.score(docs, quality.fit(docs, labels.filter("doc_id < 200"))), "doc_id", "score")
    assert by(quality.score(docs, quality.fit(docs, shared.filter("doc_id < 200"))), "doc_id", "score") == base
    flipped = labels.withColumn("quality", F.when(F.col("doc_id") < 200, F.col("quality")).otherwise(1 - F.col("quality")))
    assert by(quality.score(docs, quality.fit(docs, flipped.filter("doc_id < 200"))), "doc_id", "score") == base
    assert toxicity.fit(docs, shared.filter("doc_id < 200")).score("you") == toxicity.fit(docs, labels.filter("doc_id < 200")).score("you")


# --- packing, tokens --------------------------------------------------------------------

def test_packing_is_gapless_whole_and_tight(docs, spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = packing.pack_documents(docs, path, capacity=256).collect()
    for i, text in corpus():
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert [r.length for r in mine] == [len(ids) % 256][:len(ids) % 256] + [256] * (len(ids) // 256)
        assert all(brute.crc_of_ids(ids[r.start:r.start + r.length]) == r.ids_crc32 for r in mine)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 256
    assert len(sequences) <= -(-sum(r.length for r in got) // 256) + 2
    assert packing.pack_documents(empty(spark), path).count() == 0


def test_plans_use_every_piece_once_and_exact_complements():
    rng = random.Random(1)
    for _ in range(30):
        counts = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(rng.randint(1, 30))}
        used = {}
        for lengths, times in packing.plan(counts, 64):
            assert sum(lengths) <= 64 and times > 0
            for n in lengths:
                used[n] = used.get(n, 0) + times
        assert used == counts
    assert packing.plan({40: 3, 24: 3}, 64) == [((40, 24), 3)]
    assert packing.plan({40: 2, 14: 2, 10: 2}, 64) == [((40, 14, 10), 2)]
    assert packing.plan({34: 1, 15: 1, 9: 1, 6: 1}, 64) == [((34, 15, 9, 6), 1)]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("name, keep", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_encoding_equals_the_library(name, keep, plain):
    """Strings of special tokens are those tokens, as in the library, or with ``plain`` ordinary text."""
    encoder = TextEncoder(public_tokenizers.path(name), keep, plain)
    odd = ["", " ", "a  b", " \n x", "a \n b", "　 x y", "<|endoftext|> a <|startoftext|>", "x <|endoftext|> y", "<|EndOfText|>", "a<|endoftext|>é漢", "İstanbul ΑΣ Σ", "é ́x q",
           "12 345's we'll 'S", "a\xa0 b", "x \x1c y", "\x85 a", "a ", "漢字 かな 🎉🎉"] + [t for _, t in corpus() if t]
    library = encoder.pieces.encode.tokenizer
    for text, raw in zip(odd, encoder.ids(odd)):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_own_bpe_equals_tiktoken_and_decodes(docs, spark):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in bpe.encode_documents(docs, path, public_tokenizers.PATTERN).collect()}
    assert got == {i: (library.encode_ordinary(t or ""), (t or "").encode()) for i, t in corpus()}
    own = bpe.Bpe(bpe.read_ranks(path), public_tokenizers.PATTERN)
    for text in ("a" * 9000, "ab" * 3000 + "é" * 2000, "x́" * 10, " " * 5000):
        assert own.encode([text])[0].tolist() == library.encode_ordinary(text)
    assert bpe.encode_documents(empty(spark), path, public_tokenizers.PATTERN).count() == 0


def test_ids_written_and_read_back_in_order(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    folder = str(tmp_path / "ids")
    manifest = arrow_ids.write_ids(docs, folder, path, length=64)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in arrow_ids.read_ids(manifest, folder).collect()}
    start, expected = 0, {}
    for i, text in sorted(corpus()):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        expected[i] = (start, len(ids), brute.crc_of_ids(ids))
        start += len(ids)
    assert got == expected
    row = manifest.orderBy("first").head()
    reader = arrow_ids.SequenceReader(folder, row.name)
    batch = reader.file.get_batch(reader.file.num_record_batches - 1)
    masks = batch.column("mask").to_pylist()
    assert all(len(m) == 64 for m in masks) and sum(map(sum, masks)) == row.n_ids % (64 * arrow_ids.BATCH)
    assert arrow_ids.round_trip(empty(spark), path).count() == 0


# --- archives ----------------------------------------------------------------------------

@pytest.mark.parametrize("least", [0, 100])
def test_archives_keep_one_payload_of_a_kind(spark, least):
    page = f"<html>{prose(1, 200)}</html>"
    rows = [(1, page), (2, page), (3, None), (4, ""), (5, "é\r\n\r\n"), (6, page + "x"), (7, page), (8, "z" * 300_000), (9, "tiny"), (10, "tiny")]
    pages = spark.createDataFrame([(i, f"http://x/\r\n{i}" if i % 2 else None, h, "d") for i, h in rows],
                                  "page_id long, url string, html string, sha1 string").repartition(3)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages, least).collect()}
    assert got == brute.warc(rows, least)
    assert warc.round_trip(pages.limit(0)).count() == 0
    assert warc.round_trip(spark.createDataFrame([(None, None, None)], "page_id long, url string, html string")).count() == 1


def test_an_archive_starts_with_its_dictionary_and_has_a_frame_per_record():
    import io

    import zstandard

    records = [warc.record(i, f"http://x/{i}", base64.b32encode(hashlib.sha1(b"y" * i).digest()).decode(), b"y" * i, None, "1970-01-01T00:00:00Z")
               for i in range(300)]
    dictionary = warc.build_dictionary(records, 2048)
    out = io.BytesIO()
    warc.write_file(out, dictionary, iter(records))
    raw = out.getvalue()
    assert raw[:4] == bytes.fromhex("5d2a4d18") and raw[8:8 + len(dictionary)] == dictionary
    first = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompressobj()
    assert first.decompress(raw[8 + len(dictionary):]) == records[0]
    assert [len(b) for _, b in warc.read_file(io.BytesIO(raw))] == [len(warc._block(i)) + i for i in range(300)]
