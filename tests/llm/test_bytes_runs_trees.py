"""Byte-level BPE, periodic runs and the Merkle manifest against plain versions, with nulls, ties, empty and long texts and repeated rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from climbout.llm import byte_bpe, merkle, periodic_runs, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, runs long, leaf string, part int, idx long, grp string"


def corpus(seed=11, n=70):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcDeéß日1'. ") for _ in range(rng.randint(1, 6))).strip() or "x" for _ in range(40)]
    texts = []
    for i in range(n):
        w = [rng.choice(words[: rng.choice([2, 5, 40])]) for _ in range(rng.randint(0, 90))]
        if i % 3 == 0 and len(w) > 6:
            p = rng.randint(1, len(w) // 2)
            w = [w[k % p] for k in range(len(w))]
        texts.append(rng.choice([" ", "\n", "  ", "\t"]).join(w))
    texts += [None, "", " \t\n", "A b", "Ab Ab Ab Ab Ab Ab Ab Ab Ab Ab Ab Ab Ab", "\U00018da7a a\U00018da7", "x" * 5000, "ab" * 3000 + " " + "tail " * 40, "I'LL we'll 12 345\r\n\x1c\x85\xa0 end  ", texts[0], texts[0]]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "B", "é", "", None]), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "No Id", None, None, None), (None, "No Id", None, None, None), (None, None, None, "a", None), (-7, "NEGATIVE id", "en", "z", 3)]
    return [r + ("x", 1, "y", 2, 3, "z") for r in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def sf_dir(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def bag(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("name", ["op11_byte_bpe", "op12_periodic_runs", "op13_merkle_manifest"])
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    assert queries.QUERIES[name](spark, empty_dir).collect() == []


# --- byte-level BPE ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    words = byte_bpe.vocabulary(byte_bpe.default_ranks(), byte_bpe.default_pattern(), byte_bpe.stand_ins())
    return words, tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=words.ranks, special_tokens={})


def test_query_gives_the_ids_of_tiktoken(spark, sf_dir, rows, tiktoken_encoding):
    want = []
    for doc_id, text, *_ in rows:
        ids = tiktoken_encoding[1].encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha((text or "").encode())))
    got = queries.op11_byte_bpe(spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert bag(tuple(r) for r in got) == bag(want)


def test_pieces_of_all_kinds_merge_as_in_tiktoken(tiktoken_encoding):
    words, plain = tiktoken_encoding
    rng = random.Random(2)
    for pool in ("abc", "aab ", "éüñ日本語", "ab'st 12.\n\t ", "ÀÁ€👍🏽 x", " \x1c\x85\xa0a1"):
        for _ in range(150):
            text = "".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 2, 3, 9, 60, 400])))
            assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == plain.encode_ordinary(text)
    for low in range(0, 0x20000, 0x100):  # every character between letters, digits and blanks
        text = "".join(f"a{chr(c)}a1{chr(c)}1 {chr(c)} " for c in range(low, low + 0x100) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == plain.encode_ordinary(text)


def test_one_piece_of_megabytes(tiktoken_encoding):
    words, plain = tiktoken_encoding
    rng = random.Random(4)
    for text in ("".join(rng.choice("abcdefgh") for _ in range(400_000)), "a" * 300_000):
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == plain.encode_ordinary(text)


def test_tree_holds_the_leftmost_least_pair(tiktoken_encoding):
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"ab": 257, b"aaa": 258, b"aab": 259}
    assert byte_bpe.PairTree(b"aaaab", ranks).ids() == [256, 259]
    assert byte_bpe.PairTree(b"aaa", ranks).ids() == [258]
    assert byte_bpe.PairTree(b"ba", ranks).ids() == [98, 97]
    rng = random.Random(8)
    pieces = [bytes(rng.choice(b"aab") for _ in range(rng.randint(1, 64))) for _ in range(300)]
    assert byte_bpe.merge_together(pieces, byte_bpe.Pairs(ranks)) == [np.array(byte_bpe.PairTree(p, ranks).ids(), "<u4").tobytes() for p in pieces]


def test_decode_refuses_unknown_ids(spark):
    bad = spark.createDataFrame([(1, bytearray((60000).to_bytes(4, "little")))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(bad).collect()


# --- periodic runs -------------------------------------------------------------------------------


def plain_runs(w, least=12, exponent=2):
    """Every stretch with a smallest period q, found by walking each period."""
    out = {}
    for q in range(1, int(len(w) / exponent) + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_op12(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *head, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.fixture(scope="module")
def query12(spark, sf_dir):
    return queries.op12_periodic_runs(spark, sf_dir).drop("n_words").collect()


def test_query_finds_the_runs_of_a_plain_walk(query12, rows):
    assert bag(tuple(r) for r in query12) == bag(plain_op12(r[0], r[1]) for r in rows)
    assert sum(r.n_runs for r in query12) > 20


def test_some_texts_are_planted(rows):
    assert any(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 and (r[1] or "").split() for r in rows)


@pytest.mark.parametrize("steps", [1, 200, 5000])
def test_ranges_of_lags_give_the_same_runs(docs, rows, steps):
    got = periodic_runs.periodic_runs(docs, range_steps=steps).collect()
    assert bag((r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in got) == bag((r[0], len((r[1] or "").encode().split()), plain_runs((r[1] or "").encode().split())) for r in rows)


@pytest.mark.parametrize(("least", "exponent"), [(12, 2), (4, 2), (1, 2), (6, 3), (8, 2.5)])
def test_first_look_misses_no_run(least, exponent):
    rng = random.Random(9)
    for k in range(250):
        n, letters = rng.choice([0, 1, 2, 11, 12, 13, 40, 90, 200]), rng.choice([1, 2, 3, 30])
        w = [rng.randrange(letters) for _ in range(n)]
        if n > 20 and k % 2:
            a = rng.randrange(n - 5)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        cut = rng.randrange(1, n // 2 + 2)
        ids = np.array(w, np.int32)
        halves = np.concatenate([periodic_runs.scan(ids, 1, cut, least, exponent), periodic_runs.scan(ids, cut, n, least, exponent)])
        assert [tuple(r) for r in periodic_runs.smallest(halves).tolist()] == plain_runs(w, least, exponent)


# --- Merkle manifest -----------------------------------------------------------------------------


def plain_tree(leaves, fanout):
    """(root, proofs): every level in a list; a proof is the siblings' text and the way to fold."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    proofs = []
    for at in range(len(leaves)):
        proof = []
        for level in levels[:-1]:
            run = level[at - at % fanout : at - at % fanout + fanout]
            proof.append((run[: at % fanout], run[at % fanout + 1 :]))
            at //= fanout
        proofs.append(proof)
    return levels[-1][0], proofs


def plain_op13(rows, fanout=16):
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))

    by, out = {}, []
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0], leaf(r, r[1]), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (x := sorted(by[s], key=lambda t: (t[0], t[1] or 0, t[2])), plain_tree([t[2] for t in x], fanout)) for s in order}
    root, upper = plain_tree([trees[s][1][0] for s in order], fanout)
    for s, above in zip(order, upper, strict=True):
        found, (subroot, proofs) = trees[s]
        for (_, doc_id, own, r), below in zip(found, proofs, strict=True):
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and r[1] is not None
            node = leaf(r, re.sub("[A-Z]", lambda m: m[0].lower(), r[1])) if tampered else own
            for left, right in below + above:
                node = sha("".join([*left, node, *right]))
            out.append((doc_id, own, subroot, root, sha("".join("".join(a + b) for a, b in below + above)), node, node == root))
    return out


def test_query_gives_the_plain_tree(spark, sf_dir, rows):
    got = queries.op13_merkle_manifest(spark, sf_dir).collect()
    assert bag(tuple(r) for r in got) == bag(plain_op13(rows))
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize(("fanout", "levels", "n", "sources"), [(2, 1, 9, 3), (2, 2, 77, 1), (3, 2, 40, 11), (2, 3, 1, 1), (4, 1, 65, 2)])
def test_any_fanout_and_depth_of_superblocks(spark, fanout, levels, n, sources):
    rows = [(i, f"T{i}", "en", f"s{i % sources}", i) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    leaf = merkle.digest(*(merkle.field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars", "text")))
    proofs = merkle.prove(frame.select("doc_id", "source", leaf.alias("leaf"), F.lit(None).cast("string").alias("other")), fanout, levels)
    got = proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(), merkle.fold(F.col("leaf")).alias("folded")).collect()
    assert all(r.folded == r.root for r in got)
    assert bag(tuple(r)[:5] for r in got) == bag(r[:5] for r in plain_op13(rows, fanout))
