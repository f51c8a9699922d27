"""Vector codes, lexical search and the token automaton against plain readings of their contracts."""

import hashlib
import json
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewlens.llm import ball_trees, limb_codes, queries, token_automaton
from reviewlens.testbed import check

DATA = "/root/testdata/sf0.001"
WORDS = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()


@pytest.mark.parametrize("name", ["op11_limb_codes", "op12_ball_tree_search"])
def test_queries_equal_their_sql(spark, name):
    found = queries.QUERIES[name](spark, DATA)
    columns, rows = check.oracle_rows(DATA, queries.ORACLES[name])
    assert rows
    assert check.differences(found.columns, [tuple(r) for r in found.collect()], columns, rows) == []


# Vector codes


@pytest.mark.parametrize("top", [3, 1 << 12, 1 << 27])
def test_limb_products_are_exact(top):
    rng = np.random.default_rng(2)
    one, two = rng.integers(-top, top, (40, 48)), rng.integers(-top, top, (30, 48))
    plain = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in two] for x in one]
    assert limb_codes.exact_dots(one, two).tolist() == plain
    bits = limb_codes.limb_bits(48)
    assert 48 * 4**bits <= 2**53
    pieces = limb_codes.limbs(one, bits)
    assert all(np.abs(piece).max() <= 1 << bits for piece in pieces)
    assert (sum(piece.astype(np.int64) << (bits * i) for i, piece in enumerate(pieces)) == one).all()


VECTORS = "vec_id long, embedding array<double>, label int, code string, error int, part int, slot int"


def plain_codes(rows, parts, entries, rounds, scale):
    """Rows (vec_id, label, code, error, label_error, digest) by the words of the contract."""
    kept = [(i, [math.floor(x * scale) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    answer, total = [], defaultdict(int)
    for size in {len(v) for _, v, _ in kept}:
        own = sorted((r for r in kept if len(r[1]) == size), key=lambda r: (r[0] is None, r[0], r[1]))
        cuts = [(size * p // parts, size * (p + 1) // parts) for p in range(parts)]
        books = [[v[a:b] for _, v, _ in own[:entries]] for a, b in cuts]

        def near(v, p):
            a, b = cuts[p]
            return min((sum((x - y) ** 2 for x, y in zip(v[a:b], entry)), e) for e, entry in enumerate(books[p]))

        for _ in range(rounds):
            members = [defaultdict(list) for _ in cuts]
            for _, v, _ in own:
                for p, (a, b) in enumerate(cuts):
                    members[p][near(v, p)[1]].append(v[a:b])
            for p in range(parts):
                for e, found in members[p].items():
                    books[p][e] = [sum(column) // len(found) for column in zip(*found)]
        digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
        for i, v, label in own:
            found = [near(v, p) for p in range(parts)]
            answer.append((i, label, bytes(e for _, e in found), sum(d for d, _ in found), digest))
            total[label] += answer[-1][3]
    fits = lambda n: n if n < 1 << 63 else None
    lost = {label for _, label, _, error, _ in answer if error >= 1 << 63}
    return [(i, label, code, fits(error), None if label in lost else fits(total[label]), digest) for i, label, code, error, digest in answer]


@pytest.mark.parametrize("scale, largest", [(256, 1.0), (1 << 24, 1.0), (256, 1e30)])
def test_codes_equal_the_plain_reading(spark, scale, largest):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=10) * largest).tolist(), int(rng.integers(0, 3))) for i in range(60)]
    rows += [(7, rows[7][1], 1), (7, rows[9][1], 1), (100, rows[3][1], None), (101, [0.0] * 10, None), (None, [0.5] * 10, 2)]
    rows += [(200, None, 0), (201, [float("nan")] * 10, 0), (202, [float("inf")] + [1.0] * 9, 0), (203, [None] + [1.0] * 9, 0), (204, [], 5), (205, [1.0, -2.0], 5)]
    rng.shuffle(rows)
    rows = [(None if i is None else int(i), v, None if label is None else int(label)) for i, v, label in rows]
    frame = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], VECTORS).repartition(3)
    found = limb_codes.compressed(frame, parts=4, entries=8, scale=scale).collect()
    order = lambda r: repr(r)
    assert sorted(((r.vec_id, r.label, bytes(r.code), r.error, r.label_error, r.codebooks_sha256) for r in found), key=order) == sorted(
        plain_codes(rows, 4, 8, 2, scale), key=order
    )


def test_codes_of_no_vectors(spark):
    for rows in ([], [(1, None, 0, "x", 1, 2, 3)]):
        found = limb_codes.compressed(spark.createDataFrame(rows, VECTORS))
        assert found.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"] and found.count() == 0


# Lexical search

DOCUMENTS = "doc_id long, text string, n int, terms string, score string, row int"


def plain_search(docs, items, k):
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    counts = [(i, Counter(split(text))) for i, text in docs]
    sizes = [sum(c.values()) for _, c in counts]
    documents, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    answer = []
    for item, text in items:
        found = []
        for (i, c), n in zip(counts, sizes):
            score = 0
            for t in set(split(text)) & set(c):
                w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + 90 * n * documents // total
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i))
        answer += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found)[:k], 1)]
    return answer


def odd_documents():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "é", "日本", "a1", "A1", "Σ"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(300)]
    texts += [texts[5]] * 40 + [None, "", " ,.; ", "w1" * 5000, "w1 " * 20000, "w1\x00w2-w3_w4`w5{w6\x7fw7", texts[0].upper()]
    docs = list(enumerate(texts)) + [(3, texts[3]), (3, texts[4]), (None, texts[5]), (None, texts[6])]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 9)))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "unheard"), (1, items[1][1]), (1, "w3 w4"), (None, "w5"), (53, texts[5])]
    return docs, items


def test_search_equals_the_plain_reading(spark, monkeypatch):
    docs, items = odd_documents()
    frame = spark.createDataFrame([(*d, 1, "x", "y", 2) for d in docs], DOCUMENTS).repartition(3)
    asked = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, row int, rank int")
    wanted = sorted(plain_search(docs, items, 10), key=repr)
    for leaf, item_terms in ((64, 500_000), (4, 40)):
        monkeypatch.setattr(ball_trees.Tree.__init__, "__defaults__", (leaf,))
        found = ball_trees.search(frame, asked, item_terms=item_terms).collect()
        assert sorted(map(tuple, found), key=repr) == wanted
    assert ball_trees.search(frame.limit(0), asked).count() == ball_trees.search(frame, asked.limit(0)).count() == 0
    assert ball_trees.search(frame.where("doc_id = 341"), asked).count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 30, 900)
    columns = np.concatenate([np.sort(rng.choice(np.arange(300) + 300 * (i % 9), n, replace=False)) for i, n in enumerate(lengths)])
    values = rng.integers(1, 1_000_000, len(columns))
    tree = ball_trees.Tree(columns, values, lengths, leaf=16)
    dense = np.zeros((900, 2700), np.int64)
    dense[np.repeat(np.arange(900), lengths), columns] = values
    visited = leaves = 0
    for _ in range(40):
        at = np.unique(rng.integers(0, len(tree.own), 6))
        weights = rng.integers(1, 20_000, len(at))
        scores = dense[:, tree.own[at]] @ weights
        bounds = tree.bounds(at, weights)
        for node, (first, last) in enumerate(zip(tree.first, tree.last)):
            assert scores[tree.order[first:last]].max() <= bounds[node]
        best = []
        visited += tree.search(at, weights, best, 5, lambda i: (-i, i))
        leaves += sum(c is None for c in tree.children)
        assert sorted((-s, i) for s, _, i in best) == sorted((-s, i) for i, s in enumerate(scores.tolist()) if s > 0)[:5]
    assert visited < leaves


# Token automaton


def plain_pairs(word, merges, suffix):
    """Merges in order, each from left to right."""
    parts = [*word[:-1], *(last + suffix for last in word[-1:])]
    for left, right in merges:
        at, done = 0, []
        while at < len(parts):
            both = at + 1 < len(parts) and parts[at] == left and parts[at + 1] == right
            done.append(left + right if both else parts[at])
            at += 2 if both else 1
        parts = done
    return parts


@pytest.mark.parametrize("seed", range(12))
def test_automaton_equals_merging_in_order(seed, monkeypatch):
    rng = random.Random(seed)
    letters = ["a", "b", "c"][: rng.randint(1, 3)]
    tokens = letters + [letter + "$" for letter in letters]
    merges = []
    for _ in range(rng.randint(1, 40)):
        left, right = rng.choice([t for t in tokens if "$" not in t]), rng.choice(tokens)
        if left + right not in tokens:
            tokens.append(left + right)
            merges.append((left, right))
    automaton = token_automaton.Automaton({t: i for i, t in enumerate(tokens)}, merges, "$")
    words = ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(200)]
    monkeypatch.setattr(token_automaton, "ARCS", 20)
    for word, found in zip(words, automaton.paths(words)):
        wanted = plain_pairs(word, merges, "$")
        assert [tokens[i] for i in found] == wanted
        assert [tokens[i] for i in automaton.path(automaton.spell(word))] == wanted


def test_automaton_refuses_unordered_merges():
    with pytest.raises(ValueError):
        token_automaton.Automaton({"a": 0, "b": 1, "ab": 2, "aab": 3}, [("a", "ab"), ("a", "b")])


def test_every_token_and_long_words_equal_the_library():
    known, plain = token_automaton.Vocabulary(WORDS), Tokenizer.from_str(WORDS)
    rng = random.Random(6)
    texts = list(json.loads(WORDS)["model"]["vocab"])[::7]
    texts += ["a" * n for n in (1, 2, 3, 7, 100, 30_000)] + ["日本" * 3000, "".join(rng.choices("theration", k=20_000))]
    for first in range(0, len(texts), 500):
        some = texts[first : first + 500]
        ids, counts = known.encode(some)
        for own, text, wanted in zip(np.split(ids, np.cumsum(counts)[:-1]), some, plain.encode_batch(some, add_special_tokens=False)):
            assert own.tolist() == wanted.ids, text[:50]


def test_tokens_of_odd_texts_equal_the_library(spark, monkeypatch):
    rng = random.Random(1)
    signs = " \n\t\x1c\x85\xa0 ab1!.'sétéßÀÿ日ΣσµªİÁ're<|>é̀"
    texts = [None, "", " ", "a", "a" * 3000, "word " * 9000, " ́á", "x<|startoftext|>y <|endoftext|><|endoftext|> <| endoftext|>", "<|endoftext|", "ΑΣ ΑΣ"]
    texts += ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(300)] * 2
    frame = spark.createDataFrame([(i, t, [7], "x") for i, t in enumerate(texts)] + [(None, "b", [7], "x")], "doc_id long, text string, ids array<int>, content string")
    plain = Tokenizer.from_str(WORDS)
    monkeypatch.setattr(token_automaton, "REMEMBERED", 200)
    rows = token_automaton.decode(token_automaton.encode(frame)).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        ids = plain.encode("b" if r.doc_id is None else texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids
        assert r.text == plain.decode(ids, skip_special_tokens=False)
    assert token_automaton.encode(frame.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [320, 99999, -1, 49407])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in token_automaton.decode(odd).collect()} == {1: None, 2: "", 3: "a</w> <|endoftext|>"}


def test_op13_query(spark):
    plain = Tokenizer.from_str(WORDS)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = queries.op13_token_automaton(spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = plain.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest()
