"""The operators against plain versions, on small tables with nulls, ties, empty and long texts and repeated rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from climbout.llm import decontaminate, exact_dedup, jaccard_join, lm_score, packing, quality_knn, suffix_dedup, token_store, toxicity, url_filter
from climbout.llm import text as tx
from climbout.llm import tokenize as tk

SCHEMA = "doc_id long, text string, lang string, node long, digest string, n long"


def prose(rng, n, vocabulary=400):
    return " ".join(rng.choice(WORDS[:vocabulary]) for _ in range(n))


_rng = random.Random(1)
WORDS = ["".join(_rng.choice("abcdefghij") for _ in range(_rng.randint(2, 7))) + _rng.choice(["", "", ".", ","]) for _ in range(900)]


def corpus(seed=3, n=60):
    """Texts with exact copies, near copies, shared passages, long and empty ones, and repeated rows."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(n)]
    passage = prose(rng, 60)
    texts = list(base)
    for t in base[:20]:
        w = t.split()
        if len(w) > 30:
            w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [t.replace(" ", "\n") for t in base[20:26]] + [base[30] + " "] * 7
    texts += [prose(rng, 20) + " " + passage + " " + prose(rng, 15) for _ in range(8)]
    texts += ["", None, " \t\n", "one", "Two words", "é" * 300, "ab" * 400, prose(rng, 3000), "x"]
    return [(i, t, "en", 5, "clash", 1) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(frame, key="doc_id"):
    return {r[key]: r for r in frame.collect()}


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


# --- exact deduplication -------------------------------------------------------------------------


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 2))])
def test_exact_groups_even_when_digests_collide(docs, rows, digest):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    want = {i: (min(g)[1], len(g), i == min(g)[1]) for g in groups.values() for _, i in g}
    got = by_id(exact_dedup.exact_duplicates(docs, digest))
    assert {i: (r.keep_id, r.group_size, r.kept) for i, r in got.items()} == want


def test_exact_survivors_keep_columns_and_one_of_repeated_rows(spark, docs, rows, empty):
    twice = docs.union(docs.where("doc_id < 9"))
    left = exact_dedup.survivors(twice)
    assert left.columns == docs.columns
    assert Counter(re.sub(r"\s", "", r.text or "") for r in left.collect()).most_common(1)[0][1] == 1
    assert exact_dedup.exact_duplicates(empty).count() == exact_dedup.survivors(empty).count() == 0
    nameless = spark.createDataFrame([(None, "a b"), (4, "ab"), (None, "c")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(nameless).where("points > 1").collect()) == [(False, None, 2), (True, None, 2)]


# --- token store and packing ---------------------------------------------------------------------

WEIRD = ["Hello, world. it's <|endoftext|>. a.b,c <|startoftext|>x", "", "É.é,É. ..,, ,a 's. don't.we're", None, " \t\n ", "é.x ́a. İstanbul. ΣΑΣ. ß.", "a b.c　d 12.5,3 x.5 5.x 日本語。テキスト. ", "<|endoftext|>.<|ENDOFTEXT|>,x"]


def encoded(texts):
    return [e.ids for e in tk.encoder(tk.default_tokenizer()).tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_tokens_survive_the_round_trip(spark, rows):
    table = [(i, t) for i, t, *_ in rows] + [(1000 + i, t) for i, t in enumerate(WEIRD)] + [(None, "nameless")]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    manifest = token_store.write_tokens(docs, frame_bytes=3000)
    assert manifest.count() > 3
    got = by_id(token_store.read_tokens(manifest))
    start = 0
    for (i, _), ids in sorted(zip(table, encoded([t for _, t in table]), strict=True), key=lambda x: (x[0][0] is not None, x[0][0] or 0)):
        assert (got[i].start, np.frombuffer(got[i].ids, "<u4").tolist()) == (start, [*ids, 1])
        start += len(ids) + 1
    some = by_id(token_store.read_tokens(manifest, [3, 1002]))
    assert set(some) == {3, 1002} and some[1002] == got[1002]


def test_a_damaged_frame_is_noticed(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    path = token_store.write_tokens(docs, f"file://{tmp_path}").first().path
    raw = bytearray(open(path[7:], "rb").read())
    raw[-13] ^= 1  # the checksum of the only frame
    open(path[7:], "wb").write(raw)
    with pytest.raises(ValueError):
        token_store.ShardReader(path).frame(0)


def test_no_documents_give_no_shards(empty):
    assert token_store.read_tokens(token_store.write_tokens(empty)).count() == 0
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("limits", [(4096, 1024), (64, 3)])
def test_pieces_cover_each_id_once_within_the_limits(docs, rows, limits):
    pieces = packing.pack(docs, tokens=limits[0], segments=limits[1]).collect()
    want = {r[0]: [*ids, 2] for r, ids in zip(rows, encoded([r[1] for r in rows]), strict=True)}
    got, bins = {}, {}
    for p in sorted(pieces, key=lambda p: p.start):
        assert p.start == len(got.setdefault(p.doc_id, [])) and p.doc_tokens == len(want[p.doc_id])
        got[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert got == want
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limits[0] and len(parts) <= limits[1]


def test_loss_tokens_are_limited_too():
    sizes = np.array([[30, 1, 30], [30, 1, 0], [30, 1, 30], [30, 1, 0]])
    for bin_ in packing.place(sizes, np.array([60, 8, 30]), cut=False):
        assert sum(sizes[i][2] for i, _, _ in bin_) <= 30
    assert len(packing.place(sizes, np.array([60, 8, 30]), cut=False)) == 2


# --- decontamination -----------------------------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain_matches(rows, items, window):
    windows = {}
    for k, t in items:
        w = words_of(t)
        size = min(window, len(w))
        for a in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + size]), set()).add(k)
    out = {}
    for i, t, *_ in rows:
        w, hit, found = words_of(t), set(), set()
        for size in {len(x) for x in windows}:
            for a in range(len(w) - size + 1):
                if (k := windows.get(tuple(w[a : a + size]))) is not None:
                    hit |= set(range(a, a + size))
                    found |= k
        out[i] = (len(w), len(hit), sorted(map(str, found)))
    return out


@pytest.mark.parametrize("block", [2_000_000, 40])
def test_matches_of_all_windows(spark, docs, rows, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    texts = {r[0]: r[1] for r in rows}
    items = [(0, texts[3]), (1, "two WORDS"), (2, None), (3, "..."), (4, " ".join(texts[90].split()[25:60])), (5, texts[3]), (6, "aa " * 15), (7, "one")]
    rows = [*rows, (900, "aa " * 12 + "bb " + "aa " * 30, "en", 0, "", 0)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontaminate.matches(docs.union(spark.createDataFrame(rows[-1:], SCHEMA)), bench, 10))
    assert {i: (r.n_words, r.n_hit, r["items"]) for i, r in got.items()} == plain_matches(rows, items, 10)


def test_removed_spans_and_clean_documents(spark, docs, empty):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda")], "item_id long, text string")
    dirty = spark.createDataFrame([(1, "é start ALPHA beta, gamma delta epsilon zeta eta theta iota kappa lambda; " + "w " * 30, "en", 0, "", 0), (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", 0, "", 0), (3, None, "en", 0, "", 0)], SCHEMA)
    left = by_id(decontaminate.remove_spans(dirty, bench))
    assert set(left) == {1, 3} and left[1].text == "é start ; " + "w " * 30 and left[3].text is None
    assert sorted(map(tuple, decontaminate.remove_spans(docs, bench.limit(0)).collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    assert decontaminate.matches(empty, bench).count() == 0


# --- URLs ----------------------------------------------------------------------------------------


def test_url_rules_and_terms(spark):
    cases = [
        ("https://A.Example.ORG/es/1?x", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/1#f", "example.org", "/en/1", "example.org/en/1", "block"),
        ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        ("http://x.com/de/2", "x.com", "/de/2", "com/de/", "block"),
        ("http://x.com", "x.com", "", None, "allow"),
        ("http://spam-farm.net/a", "spam-farm.net", "/a", None, "block"),
        ("http://xspam-farms.net/a", "xspam-farms.net", "/a", None, "block"),
        ("http://bet.net/poker", "bet.net", "/poker", None, "block"),
        ("http://bet.net/a", "bet.net", "/a", None, "allow"),
        ("nothing", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://a.net?q=http://b.org/", "a.net", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "host") for i, c in enumerate(cases)], "page_id long, url string, rule string")
    got = by_id(url_filter.judge_urls(pages), "page_id")
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), cases[i]
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
    hits = url_filter.matcher(("casino",), {"win": 1.0})
    assert hits("casinos") == ([], []) and hits("my-casino.x") == (["casino"], []) and hits("winwin") == ([], ["win"])


# --- near copies ---------------------------------------------------------------------------------


def plain_components(rows):
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def chains(seed):
    """Long chains of slowly changing texts, and texts made of common passages."""
    rng = random.Random(seed)
    out, passage = [], [prose(rng, 40) for _ in range(3)]
    for size in (12, 40, 90, 300):
        w = prose(rng, size).split()
        for _ in range(14):
            w = list(w)
            at = rng.randrange(len(w))
            w[at : at + 1] = ["new%d" % rng.randrange(99)] * rng.choice([0, 1, 2])
            out.append(" ".join(w))
    out += [" ".join(rng.sample(passage, 3)) + " " + prose(rng, rng.randint(0, 12)) for _ in range(40)]
    return [(i, t, "en", 0, "", 0) for i, t in enumerate(out)]


@pytest.mark.parametrize("hot,common", [(96, 4), (2, 1)])
def test_components_of_similar_documents(spark, docs, rows, monkeypatch, hot, common):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr(jaccard_join, "COMMON", common)
    got = by_id(jaccard_join.similar_components(docs))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == plain_components(rows)
    table = chains(hot)
    got = by_id(jaccard_join.similar_components(spark.createDataFrame(table, SCHEMA).repartition(4)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == plain_components(table)


def test_sketches_of_linked_sets_always_meet():
    rng = np.random.default_rng(5)
    for n in [*range(1, 60), 200, 777]:
        for _ in range(4):
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            drop, add = (0, len(a) // 4) if rng.random() < 0.5 else (len(a) // 5, 0)
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)]))
            common = np.sort(rng.choice(a, len(a) // 2, replace=False))
            for heavy in (np.zeros(0, np.uint64), common, a):
                both = [jaccard_join.sketch(x, np.array([0, len(x)]), heavy)[1] for x in (a, b)]
                assert not len(b) or np.isin(*both).any()


def test_hot_words_keep_members_that_other_tasks_hold(spark, monkeypatch):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    name = lambda t: int(jaccard_join.node_of(*tx.shingles(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), 5))[0])
    b = text(44)
    near = b + " end"  # 40 of 41 shingles
    far = [text(n) for n in (55, 56)]
    least = text(60)
    while name(least) > min(map(name, [b, near, *far])):
        least = text(60)
    # word 8 has least, near and far in one task and b in the other; word 4 only least and b
    words = {56: [4, 8], 41: [8], 51: [8], 52: [8], 40: [4, 8]}

    def sketch(hashes, first, common):
        each = [(k, w) for k, n in enumerate(np.diff(first).tolist()) for w in words[n]]
        return np.array([k for k, _ in each]), np.array([w for _, w in each], np.uint64)

    monkeypatch.setattr(jaccard_join, "sketch", sketch)
    monkeypatch.setattr(jaccard_join, "HOT", 2)
    tasks = [[(1, least), (2, near), (3, far[0]), (4, far[1])], [(5, b)]]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(tasks, 2).flatMap(lambda x: x), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_components(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 2}


def test_one_of_each_component_stays(docs, rows, empty):
    want = plain_components(rows)
    left = jaccard_join.keep_one(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {c for _, c in want.values()}
    assert jaccard_join.similar_components(empty).count() == 0


def test_shared_and_missing_doc_ids_lose_only_near_copies(spark):
    rng = random.Random(8)
    one, two, three = (prose(rng, 60) for _ in range(3))
    table = [(1, one), (5, one + " more"), (5, two), (None, two + " more"), (None, three), (None, three + " more"), (7, None), (None, "")]
    left = jaccard_join.keep_one(spark.createDataFrame(table, "doc_id long, text string").repartition(3)).collect()
    kept = [(r.doc_id, r.text) for r in left]
    assert len(kept) == 5 and set(kept) >= {(1, one), (5, two), (7, None), (None, "")}
    assert len({(None, three), (None, three + " more")} & set(kept)) == 1


# --- repeated strings ----------------------------------------------------------------------------


def plain_repeats(rows, length):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                gone[k : k + length] = True
            seen.add(b[k : k + length])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("length,step,hot", [(100, (64, 8, 1), 256), (20, (12, 4, 1), 1)])
def test_repeats_are_removed_exactly(docs, rows, monkeypatch, length, step, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "FLUSH", 300)
    got = by_id(suffix_dedup.remove_repeats(docs, length, step))
    assert {i: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for i, r in got.items()} == plain_repeats(rows, length)


def test_repeats_of_odd_tables(spark, empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
    text = "".join(map(chr, range(48, 120))) * 2
    odd = spark.createDataFrame([(7, text), (7, text), (None, text), (9, text)], "doc_id long, text string")
    got = sorted(((r.doc_id or 99), r.n_removed) for r in suffix_dedup.remove_repeats(odd).collect())
    assert got == [(7, 0), (7, 0), (9, 144), (99, 144)]


# --- scores --------------------------------------------------------------------------------------


def test_quality_votes_equal_a_plain_search(spark, docs, rows, empty):
    labels = spark.createDataFrame([(r[0], int(len(r[1] or "") > 200), 0) for r in rows if r[0] % 2] + [(5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = by_id(quality_knn.quality_scores(docs, labels))
    assert set(got) == {r[0] for r in rows} and all(0 <= r.score <= 1 for r in got.values())
    idf, projection, known, y = quality_knn.fit(docs, labels)
    for i, t, *_ in rows:
        data = np.frombuffer((t or "").encode(), np.uint8)
        v = quality_knn.unit(quality_knn.weigh(quality_knn.term_counts(data, np.array([0, len(data)])), idf) @ projection)
        near = np.argsort(-(known @ v[0]))[: quality_knn.K]
        w = np.clip(known[near] @ v[0], 1e-3, 1).astype(float) ** quality_knn.POWER
        assert got[i].score == pytest.approx((w * y[near]).sum() / w.sum(), abs=0.08)
    assert {r.score for r in quality_knn.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_knn.quality_scores(empty, labels).count() == 0
    assert quality_knn.keep_good(docs, labels, docs).columns == docs.columns


def test_clause_grammar():
    grammar = toxicity.Grammar(np.zeros(0, np.uint64))

    def kinds(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return grammar.kinds(data, np.array([0, len(data)]))[0].astype(int).tolist()

    assert kinds("what an idiot") == [1, 0, 0, 0, 0, 0]
    assert kinds("You are an IDIOT, friend") == [0, 1, 0, 0, 0, 0]
    assert kinds("they burn. i will hurt you") == [0, 0, 0, 2, 0, 0]
    assert kinds("he is not an idiot") == [0, 0, 0, 0, 1, 0]
    assert kinds("the paper said you moron") == kinds("the paper said: you moron") == [0, 0, 0, 0, 0, 1]
    assert kinds("not one of those plain days, an idiot came") == [1, 0, 0, 0, 0, 0]
    assert kinds("") == kinds("clean words only") == [0] * 6


def test_toxicity_learns_terms_of_the_corpus(spark, empty):
    rng = random.Random(2)
    table = [(i, prose(rng, 40) + (" zorkel%s " % rng.choice("abcd") if i % 4 == 0 else " ") + prose(rng, 20)) for i in range(400)]
    docs = spark.createDataFrame([*table, (1000, None), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in table], "doc_id long, quality int, toxic int")
    got = by_id(toxicity.toxicity_scores(docs, labels))
    held = [i for i, _ in table if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((got[i].score >= 0.5) == (i % 4 == 0) for i in held) and got[1000].score == got[1001].score < 0.5
    assert toxicity.toxicity_scores(empty, labels).count() == 0
    assert by_id(toxicity.toxicity_scores(docs, labels.limit(0)))[1001].score < 0.5


def test_pseudo_likelihood_learns_order(spark, empty):
    rng = random.Random(4)
    natural = [(i, " ".join(f"a{k % 7} b{k % 7}" for k in range(j, j + 40))) for i, j in enumerate(rng.randrange(7) for _ in range(300))]
    shuffled = [(1000 + i, " ".join(rng.sample(t.split(), len(t.split())))) for i, t in natural[:20]]
    docs = spark.createDataFrame([*natural, *shuffled, (5000, None), (5001, " "), (5002, "single")], "doc_id long, text string")
    got = by_id(lm_score.pseudo_likelihood(docs.repartition(2)))
    mean = lambda ids: np.mean([got[i].mean_log_prob for i in ids])
    assert mean(range(300)) > mean(range(1000, 1020)) + 0.3
    assert got[5000].n_words == got[5001].n_words == 0 and got[5000].log_prob == 0 and got[5000].mean_log_prob is None
    assert got[5002].n_words == 1 and got[5002].log_prob < 0
    assert lm_score.pseudo_likelihood(empty).count() == 0


def test_rare_words_do_not_get_the_counts_of_their_bucket(spark):
    raw = " ".join(f"w{k}" for k in range(3000)).encode()
    hashes = tx.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), tx.BLANKS)[0] >> np.uint64(48)
    seen = {}
    often, rare = next((seen[h], k) for k, h in enumerate(hashes.tolist()) if seen.setdefault(h, k) != k)
    rows = [(i, f"plain w{often} line") for i in range(400)] + [(1000, f"plain w{rare} line")]
    got = by_id(lm_score.pseudo_likelihood(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    # the same bucket and context: only the counts differ, 400 and 1
    assert len(got) == 401 and got[0].log_prob - got[1000].log_prob == pytest.approx(np.log(400), abs=1e-6)


def test_network_probabilities_sum_to_one():
    of, within, prior = lm_score.classes(np.arange(lm_score.BUCKETS)[::-1].copy())
    total = np.bincount(of, np.exp(within.astype(float)), lm_score.CLASSES)
    assert np.allclose(total[: lm_score.EDGE], 1, atol=1e-3)
    net = lm_score.Network.fresh(prior)
    context = [np.array([1, 5], np.uint8)] * 4
    each = [np.exp(net.log_probs(np.full(2, c, np.uint8), context)) for c in range(lm_score.CLASSES)]
    assert np.allclose(np.sum(each, 0), 1, atol=1e-4)


def test_slices_cover_all_rows():
    import pyarrow as pa

    column = pa.array(["abc", None, "", "d" * 50, "é"])
    parts = [(row, data.tobytes(), off.tolist()) for row, data, off in tx.slices(column, 4)]
    assert b"".join(p[1] for p in parts).decode() == "abc" + "d" * 50 + "é" and sum(len(p[2]) - 1 for p in parts) == 5


# --- plumbing ------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_and_cold_keys_are_joined_alike(spark, monkeypatch, how):
    from climbout.llm import shared

    left = spark.createDataFrame([(0 if i % 3 else i % 50, i) for i in range(300)], "k long, v long")
    right = left.where("k <> 7").groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("least"))
    want = sorted(map(tuple, left.join(right, ["k"], how).select("k", "v", "least").collect()), key=str)
    monkeypatch.setattr(shared, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(shared, "HOT_SHARE", 0.3)
    assert sorted(map(tuple, shared.attach(left, right, ["k"], how).select("k", "v", "least").collect()), key=str) == want


def test_components_follow_long_chains(spark):
    from climbout.llm import shared

    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (101, 100), (200, 200)], "a long, b long")
    assert {(r.node, r.component) for r in shared.components(edges).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


# --- hostile and large inputs --------------------------------------------------------------------


def thue_morse(a, b, n=1024):
    out = [0]
    while len(out) < n:
        out += [1 - x for x in out]
    return "".join(b if x else a for x in out)


LEFT, RIGHT = thue_morse("a", "b"), thue_morse("b", "a")


def test_structured_words_have_hashes_of_their_own(spark):
    raw = np.frombuffer((LEFT + RIGHT).encode(), np.uint8)
    one, two = tx.Prefix(raw).spans(np.array([0, 1024]), np.array([1024, 2048]))
    assert one != two
    docs = spark.createDataFrame([(1, LEFT), (2, RIGHT)], "doc_id long, text string").repartition(1)
    tokens = by_id(token_store.read_tokens(token_store.write_tokens(docs, end_id=None)))
    assert [np.frombuffer(tokens[i].ids, "<u4").tolist() for i in (1, 2)] == encoded([LEFT, RIGHT])
    assert by_id(decontaminate.matches(docs, spark.createDataFrame([(1, LEFT)], "item_id long, text string")))[2].n_hit == 0
    assert {r.component_id for r in jaccard_join.similar_components(docs).collect()} == {1, 2}


def test_prefix_hashes_equal_a_plain_polynomial():
    prime, raw = 2**61 - 1, np.random.default_rng(3).integers(0, 256, 70_000, dtype=np.uint8)
    prefix = tx.Prefix(raw)
    for a, b in ((0, 1), (9, 9), (32_700, 32_900), (65_000, 70_000)):
        plain = sum((int(c) + 1) * pow(tx._BASE61, k, prime) for k, c in enumerate(raw[a:b])) % prime
        want = tx.mix(np.array([(plain + (b - a) * int(tx._MULT)) % 2**64], np.uint64))[0]
        assert prefix.spans(np.array([a]), np.array([b]))[0] == want


def test_added_tokens_keep_their_case(spark):
    texts = ["<|endoftext|> word", "<|ENDOFTEXT|> Word", "<|EndOfText|> WORD"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    got = by_id(token_store.read_tokens(token_store.write_tokens(docs, end_id=None)))
    assert [np.frombuffer(got[i].ids, "<u4").tolist() for i in range(3)] == encoded(texts)


def test_texts_of_megabytes_are_read_whole(spark):
    rng = random.Random(9)
    long = prose(rng, 450_000, 900)
    assert len(long) > 2_000_000
    tail = " ".join(long.split()[-12:])
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, long[-300:]), (4, None)], "doc_id long, text string")
    assert by_id(exact_dedup.exact_duplicates(docs))[2].group_size == 1
    assert {i: r.component_id for i, r in by_id(jaccard_join.similar_components(docs)).items()} == {1: 1, 2: 1, 3: 3, 4: 4}
    bench = spark.createDataFrame([(7, tail), (None, tail)], "item_id long, text string")
    hits = by_id(decontaminate.matches(docs, bench))
    assert hits[1].n_hit >= 12 and hits[1]["items"] == ["7"] and hits[4].n_hit == 0
    cut = by_id(suffix_dedup.remove_repeats(docs))
    assert cut[3].n_removed == cut[3].n_bytes == 300 and cut[2].n_bytes - cut[2].n_removed < 110
    ids = np.frombuffer(by_id(token_store.read_tokens(token_store.write_tokens(docs)))[2].ids, "<u4").tolist()
    assert ids == [*encoded([long + " end"])[0], 1]
    pieces = sorted((p.start, p.length) for p in packing.pack(docs).where("doc_id = 2").collect())
    assert pieces[-1][0] + pieces[-1][1] == len(ids)


def test_nameless_and_repeated_ids_keep_their_place(spark):
    table = [(None, "b b"), (None, "a"), (-(1 << 63), "least"), (4, "x"), (4, "y"), (4, "x")]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    got = token_store.read_tokens(token_store.write_tokens(docs)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -(1 << 63), 4, 4, 4]
    assert [r.start for r in got] == list(np.cumsum([0, *[r.n_tokens for r in got]])[:-1])
    assert packing.pack(docs).agg(F.sum("length")).first()[0] == sum(r.n_tokens for r in got)


def test_loss_shares_of_conversations_limit_sequences(spark):
    turns = [(i, "assistant" if i % 2 else "user", "some words of turn %d " % i * 6) for i in range(120)]
    frame = spark.createDataFrame(turns, "doc_id long, role string, text string").withColumn("share", F.when(F.col("role") == "assistant", 1.0).otherwise(0.0)).repartition(1)
    pieces = packing.pack(frame, tokens=256, segments=8, loss=100, loss_share="share").collect()
    bins = {}
    for p in pieces:
        assert p.loss_tokens == (p.length if p.doc_id % 2 else 0)
        n = bins.setdefault(p.sequence_id, [0, 0, 0])
        for k, x in enumerate((p.length, 1, p.loss_tokens)):
            n[k] += x
    assert all(a <= 256 and b <= 8 and c <= 100 for a, b, c in bins.values()) and max(c for *_, c in bins.values()) > 90


def test_automata_of_many_passes(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 15)
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", 2)
    items = [(k, r[1]) for k, r in enumerate(rows[:8])]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(1)
    assert decontaminate.blocks(bench, 10).count() > 4
    got = by_id(decontaminate.matches(docs, bench, 10))
    assert {i: (r.n_words, r.n_hit, r["items"]) for i, r in got.items()} == plain_matches(rows, items, 10)


def test_composed_transducers_equal_a_plain_reading():
    rng = random.Random(6)

    def plain(clause, reported):
        once = [0 if i and c in (1, 2) and clause[i - 1] == c else c for i, c in enumerate(clause)]
        for i, c in enumerate(once):
            if c in (1, 2):
                negated = toxicity.NEGATION in once[max(0, i - toxicity.REACH) : i]
                yield 4 if negated else 5 if reported or toxicity.REPORT in once[:i] else 2 * (c == 2) + (toxicity.TARGET in once)

    for _ in range(3000):
        clause = [rng.choice([0, 0, 0, 1, 2, 3, 4, 5]) for _ in range(rng.randint(1, 9))]
        for reported in (False, True):
            kinds, weight = toxicity.read_clause(clause, reported)
            assert kinds == list(plain(clause, reported))
    assert toxicity.read_clause([1, 3], False)[1] == toxicity.BARE_INSULT + toxicity.AIM
    assert toxicity.read_clause([4, 1], False)[1] == toxicity.BARE_INSULT + toxicity.NEGATION_WEIGHT


def test_ties_of_neighbours_go_to_the_first_ids():
    rng = np.random.default_rng(2)
    known = quality_knn.unit(rng.normal(size=(60, 4)).astype(np.float32)).repeat(3, 0)
    y = rng.integers(0, 2, len(known)).astype(np.float32)
    found = quality_knn.vote(known[::7], known, y)
    similar = known[::7] @ known.T
    for row, got in zip(similar, found, strict=True):
        near = sorted(range(len(row)), key=lambda k: (-row[k], k))[: quality_knn.K]
        w = np.clip(row[near], 1e-3, 1).astype(float) ** quality_knn.POWER
        assert got == pytest.approx((w * y[near]).sum() / w.sum(), abs=1e-9)


def test_scores_are_sums_over_words(spark):
    rng = random.Random(7)
    table = [(i, prose(rng, rng.randint(0, 40), 60)) for i in range(40)]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    of, size, weights = lm_score.fit(docs)
    net, counts = lm_score.Network(weights), Counter(w for _, t in table for w in lowered(t).split())
    got = by_id(lm_score.pseudo_likelihood(docs))
    for i, t in table:
        words = lowered(t).split()
        raw = t.encode()
        code = of[(tx.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), tx.BLANKS)[0] >> np.uint64(48)).astype(int)] if words else []
        total = 0.0
        for k, w in enumerate(words):
            near = [np.array([code[k + p] if 0 <= k + p < len(words) else lm_score.EDGE], np.uint8) for p in lm_score.PLACES]
            total += float(net.log_probs(np.array([code[k]], np.uint8), near)[0]) + np.log(counts[w]) - size[code[k]]
        assert got[i].n_words == len(words) and got[i].log_prob == pytest.approx(total, abs=1e-3)


def test_lookups_of_a_few_digests(spark, docs):
    index = exact_dedup.compact(exact_dedup.flush(docs))
    some = [bytes(r.digest) for r in index.orderBy("digest").limit(3).collect()]
    found = exact_dedup.lookup(index, [*some, b"none"])
    assert sorted(bytes(r.digest) for r in found.collect()) == some
    assert "In(digest" in found._jdf.queryExecution().executedPlan().toString()


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from climbout.llm import shared

    conf = SimpleNamespace(get=lambda *_: None)
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077"))
    with pytest.raises(ValueError):
        shared.shared_folder(session, "x")


def test_packing_refuses_limits_of_nothing(docs):
    for limits in ({"loss": 0}, {"tokens": 0}, {"segments": 0}):
        with pytest.raises(ValueError, match="at least one"):
            packing.pack(docs, **limits)
