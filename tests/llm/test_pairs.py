"""Near copies, vectors, archives, wrappers and the pipeline against brute force."""

import base64
import gzip
import hashlib
import random
import re
import tempfile
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from reviewlens.llm import caps, nearest, packing, queries, simhash, warc, wrappers
from reviewlens.llm.common import components

DATA = "/root/testdata/sf0.001"


def closure(ids, links):
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {i: top(i) for i in ids}


def test_components_of_random_and_long_graphs(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(200)] + [(5, 5)]
    ids = sorted({i for pair in links for i in pair} | set(range(300)))
    nodes = spark.createDataFrame([(i,) for i in ids], "id long")
    found = components(nodes, spark.createDataFrame(links, "left long, right long"))
    assert {r.id: r.component_id for r in found.collect()} == closure(ids, links)
    assert components(nodes.limit(0), spark.createDataFrame([], "left long, right long")).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=2):
    ids = sorted(prints)
    return closure(ids, [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (prints[a] ^ prints[b]).bit_count() <= radius])


def test_fingerprints():
    for text in (None, "", " \t\x0b", "One", "one TWO", "a b c", "A  b\nc d É É", "x\xa0y z w v", "w " * 20_000):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_of_bits(radius):
    masks = [m % (1 << 64) for m in simhash.masks(radius)]
    rng = random.Random(radius)
    for _ in range(2000):
        differing = sum(1 << b for b in set(rng.choices(range(64), k=radius)))
        assert any(not m & differing for m in masks)


def test_links_join_all_near_fingerprints_even_in_large_buckets(spark):
    rng = random.Random(3)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            for _ in range(rng.randint(0, 4)):
                base ^= 1 << rng.randrange(64)
            values.add(base)
    prints = dict(enumerate(sorted(values)))
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in prints.items()]
    frame = spark.createDataFrame(rows, "id long, fingerprint long")
    found = components(frame.select("id"), simhash.links(frame, 2, block=8))
    assert {r.id: r.component_id for r in found.collect()} == plain_groups(prints)


def test_grouped_documents_with_odd_rows(spark):
    base = "the quick brown fox jumps over the lazy dog again and again until night falls"
    rows = [(5, base, 1), (3, base.upper(), 1), (9, None, 1), (8, "", 1), (7, "\t", 1), (2, "other", 1), (2, "other", 1), (None, base, 1), (1, "z " * 30_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    found = simhash.grouped(docs).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id) for r in found} == {(5, 3), (3, 3), (None, 3), (9, 7), (8, 7), (7, 7), (2, 2), (1, 1)}
    assert simhash.grouped(docs.limit(0)).count() == 0


def test_op9_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    rows = {r.doc_id: r for r in queries.op9_covering_simhash(spark, DATA).collect()}
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    groups = plain_groups(prints)
    assert {i: (r.fingerprint, r.component_id) for i, r in rows.items()} == {i: (format(prints[i], "016x"), groups[i]) for i in prints}


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(30):
        centre = rng.normal(size=64)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((len(rows), (centre + rng.normal(size=64) * 0.2).tolist(), int(g % 3)))
    centre = rng.normal(size=64)
    rows += [(len(rows) + i, (centre + rng.normal(size=64) * 0.1).tolist(), 1) for i in range(200)]
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(5)] + [(len(rows) + 10, rows[0][1], 1)]
    n = len(rows) + 20
    odd = [None, [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63, []]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 10, rows[0][1], None)]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int"


def plain_cosines(rows):
    good = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    m = np.array([r[1] for r in good], np.float32).astype(float)
    m /= np.linalg.norm(m, axis=1)[:, None]
    return good, m @ m.T


def test_cap_filters_find_the_links_of_brute_force(spark):
    rows = vectors()
    found = {r.vec_id: r for r in caps.grouped(spark.createDataFrame(rows, VECTORS), block=16).collect()}
    assert sorted(found) == sorted(r[0] for r in rows)
    good, cosines = plain_cosines(rows)
    links = [(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(np.triu(cosines >= 0.93, 1))) if good[a][2] == good[b][2] is not None]
    degree = defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert all(found[i].n_links <= degree[i] for i in found)
    assert sum(r.n_links for r in found.values()) >= 0.999 * sum(degree.values())
    groups = closure(found, links)
    assert np.mean([found[i].component_id == groups[i] for i in found]) > 0.99
    assert caps.grouped(spark.createDataFrame([], VECTORS)).count() == 0


def test_one_id_with_several_vectors_and_repeated_rows(spark):
    a, b = np.random.default_rng(1).normal(size=(2, 64))
    vectors = [(1, a, 0), (1, b, 0), (2, a + b / 100, 0), (2, a + b / 100, 0), (3, b + a / 100, 0), (4, a, 1), (None, -a, 0)]
    rows = [(i, v.tolist(), label) for i, v, label in vectors]
    found = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in caps.grouped(spark.createDataFrame(rows, VECTORS)).collect())
    assert found == [(0, 0, None), (1, 1, 1), (1, 2, 1), (2, 2, 1), (2, 2, 1), (3, 1, 1), (4, 0, 4)]


def test_op5_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    good, cosines = plain_cosines(rows)
    links = [(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(np.triu(cosines >= 0.93, 1))) if good[a][2] == good[b][2] is not None]
    groups = closure([r[0] for r in rows], links)
    assert {r.vec_id: r.component_id for r in queries.op5_cap_filters(spark, DATA).collect()} == groups


def test_small_tables_give_all_candidates(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i // 2), rng.normal(size=64).tolist(), 0) for i in range(4)] + [(9, [1.0, 2.0], 0)]
    found = nearest.search(spark.createDataFrame(rows, VECTORS), F.lit(True)).collect()
    assert sorted((r.query_id, r["rank"]) for r in found) == sorted((int(i // 2), j) for i in range(4) for j in (1, 2, 3))
    for seed in range(3):
        rng = np.random.default_rng(seed)
        rows = [(i, rng.normal(size=64).tolist(), 0) for i in range(4)]
        assert nearest.search(spark.createDataFrame(rows, VECTORS), F.lit(True)).count() == 12


def test_list_decoding_finds_exactly_the_filters_above_the_threshold():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(20, 12))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    turn, (one, two) = caps.code(12, 32)
    turned = rows @ turn
    sums = (turned[:, :6] @ one.T)[:, :, None] + (turned[:, 6:] @ two.T)[:, None, :]
    ids, counts = caps.passed(rows, 32, codes=1)
    for row, own in enumerate(np.split(ids, np.cumsum(counts)[:-1])):
        assert own.tolist() == np.flatnonzero(sums[row].ravel() > caps.threshold(12, 32)).tolist()


def test_op5_query(spark):
    rows = queries.op5_cap_filters(spark, DATA).collect()
    assert len(rows) == spark.read.parquet(f"{DATA}/embeddings.parquet").count()
    assert all(r.kept == (r.vec_id == r.component_id) and r.component_id <= r.vec_id for r in rows)


def test_probes_come_in_the_order_of_their_score():
    cells = nearest.probes(np.array([[0.9, 0.5, 3.2]]), 3)[0]
    assert cells[0].tolist() == [0, 0, 3] and cells[1].tolist() == [1, 0, 3] and cells[2].tolist() == [0, 0, 2]


def test_nearest_neighbours_of_clusters_and_odd_rows(spark):
    rows = vectors()
    found = nearest.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 3 == 0).collect()
    good, cosines = plain_cosines(rows)
    ids = [r[0] for r in good]
    by_query = defaultdict(list)
    for r in sorted(found, key=lambda r: r.rank):
        by_query[r.query_id].append(r)
    assert set(by_query) == {i for i in ids if i % 3 == 0}
    hits = total = 0
    for q, answer in by_query.items():
        row = cosines[ids.index(q)]
        best = sorted((-round(row[k], 12), i) for k, i in enumerate(ids) if i != q)[:5]
        assert [r.rank for r in answer] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in answer] == sorted((-r.score, r.vec_id) for r in answer)
        for r in answer:
            assert r.score == pytest.approx(row[ids.index(r.vec_id)], abs=1e-12)
        hits += len({i for _, i in best} & {r.vec_id for r in answer})
        total += 5
    assert hits / total > 0.9
    assert nearest.search(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


def test_op7_query_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = defaultdict(set)
    for r in queries.op7_multiprobe(spark, DATA).collect():
        found[r.query_id].add(r.vec_id)
    good, cosines = plain_cosines(rows)
    np.fill_diagonal(cosines, -2)
    recall = [len(found[good[k][0]] & {good[j][0] for j in np.argsort(-cosines[k])[:5]}) / 5 for k in range(len(good)) if good[k][0] % 50 == 0]
    assert np.mean(recall) >= 0.9


PAGES = "page_id long, url string, html string, payload string, digest int"


def test_archives_round_trip(spark):
    html = [None, "", "same", "same", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "ü日\x00\r\n", "y" * 200_000, "same"]
    rows = [(i, "http://h/ä b\n" if i else None, h, "x", 1) for i, h in enumerate(html)]
    found = {int(r.metadata.fields["pageId"]): r for r in warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()}
    assert sorted(found) == list(range(len(html)))
    for i, text in enumerate(html):
        payload = (text or "").encode()
        owner = max(k for k, h in enumerate(html) if (h or "") == (text or ""))
        assert found[i].capture.type == ("response" if owner == i else "revisit")
        assert found[i].capture.payload_digest == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert found[i].metadata.fields["payloadBytes"] == str(len(payload))
        assert found[i].capture.payload == (payload if owner == i else None)
        assert found[i].request.record_id != found[i].capture.record_id
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_repeated_pages_are_several_captures(spark):
    rows = [(1, "u", "a", "x", 1), (1, "v", "b", "x", 1), (None, "u", "c", "x", 1)]
    assert warc.transactions(warc.read(spark, written(spark, rows))).count() == 3


def test_many_repeated_payloads_are_joined(spark):
    pages = warc.payloads(spark.createDataFrame([(i, "u", f"{i % 7}", "x", 1) for i in range(50)] + [(None, "u", "3", "x", 1)], PAGES))
    for few in (0, 100):
        found = warc.with_response(pages, few).collect()
        assert len(found) == 51 and all(r.response_page == max(i for i in range(50) if i % 7 == int(r.payload)) for r in found)


def test_archives_are_cut_by_bytes(spark):
    folder = tempfile.mkdtemp(prefix="run-") + "/warc"
    warc.write(spark.createDataFrame([(i, "u", f"{i}" * 100, "x", 1) for i in range(40)], PAGES).coalesce(1), folder, archive_bytes=2_000)
    assert spark.read.format("binaryFile").load(folder).count() > 3
    assert warc.transactions(warc.read(spark, folder)).count() == 40


def written(spark, rows):
    folder = tempfile.mkdtemp(prefix="run-") + "/warc"
    warc.write(spark.createDataFrame(rows, PAGES), folder)
    return folder


def test_damaged_archives_are_reported():
    record = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [r[0] for r in warc.parse(gzip.compress(record * 2))] == ["metadata", "metadata"]
    for bad in (record[:-3], record.replace(b": 3", b": 30"), b"x" + record):
        with pytest.raises(ValueError):
            list(warc.parse(bad))


def test_op2_query(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    rows = {r.page_id: r for r in queries.op2_warc_transactions(spark, DATA).collect()}
    owner = {}
    for p in pages:
        owner[p.html or ""] = max(owner.get(p.html or "", -1), p.page_id)
    for p in pages:
        data, first = (p.html or "").encode(), owner[p.html or ""]
        expected = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), *(("response", None) if first == p.page_id else ("revisit", first)))
        assert tuple(rows[p.page_id])[1:] == expected


def page(body, head="<title>t</title><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def text_of(body, others=()):
    tree, texts = wrappers.parse(page(body))
    whole = wrappers.bare(tree)
    for other in others:
        whole = wrappers.align(whole, wrappers.bare(wrappers.parse(page(other))[0]))
    return " ".join(texts[i] for i in wrappers.main_texts(tree, wrappers.judged(whole)))


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<nav><ul><li><a>m</a></ul></nav><article><h1>A&amp;B</h1><p>one\n <b>two</b>x<br>three<p>four</article><footer>f</footer>", "A&B one twox three four"),
        ("<article><p>a</p><div class='ad box'>buy</div><aside>s</aside><form><p>q</p></form><p>b</p><div id=comments><p>c</p></div></article>", "a b"),
        ("<main><p>a &lt; b &nope; &#65;</p></main>", "a < b &nope; A"),
        ("<article><p>cut off", "cut off"),
        ("<article><style>p{}</style><!-- no --><table><tr><td>1<td>2<tr><td>3</table></article>", "1 2 3"),
        ("", ""),
        ("<article></article><p>x", "x"),
    ],
)
def test_main_text(body, text):
    assert text_of(body) == text


def test_template_text_is_left_out_where_no_article_is_marked():
    bodies = [f"<div><p>Welcome to the site</p><div><h1>{i}</h1><p>text {i}</p><p>more {i}</p></div></div>" for i in range(3)]
    assert text_of(bodies[0], bodies[1:]) == "0 text 0 more 0"
    assert text_of(bodies[0], bodies[:1]) == "Welcome to the site 0 text 0 more 0"


def test_wrappers_find_optional_and_repeated_parts():
    one, two = (wrappers.bare(wrappers.parse(b)[0]) for b in ("<div><h1>a</h1><p>x</p><p>y</p></div>", "<div><h1>a</h1><h2>n</h2><p>z</p></div>"))
    div = wrappers.align(one, two)[wrappers.INSIDE][0]
    assert [(n[wrappers.LABEL], n[wrappers.OPTIONAL], n[wrappers.REPEATED]) for n in div[wrappers.INSIDE]] == [("h1", False, False), ("h2", True, False), ("p", False, True)]
    texts = [n[wrappers.INSIDE][0][wrappers.TEXT] for n in div[wrappers.INSIDE]]
    assert texts[0] is not None and texts[2] is None


def test_wrappers_of_odd_pages(spark):
    html = [None, "", "no tags", "<" * 2000, "<div>" * 3000 + "deep", "<p title='open>x", page("<article><p>" + "w " * 100_000 + "</article>")] + [page("<article><p>same</article>")] * 3
    rows = [(i, None if i % 2 else f"http://h{i % 4}.example/", h, "x", 1) for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, wrapper int")
    found = {r.page_id: r.text for r in wrappers.main_text(pages).collect()}
    assert found[0] == found[1] == "" and found[2] == "no tags" and found[4] == "deep"
    assert found[6] == ("w " * 100_000).strip() and found[7] == found[8] == "same"
    assert wrappers.main_text(pages.limit(0)).count() == 0


def test_op1_query(spark):
    import html as references

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = queries.op1_wrapper_text(spark, DATA).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id] or "", re.S)
        plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", inner[1] if inner else ""))
        assert r.text == re.sub(r"\s+", " ", references.unescape(plain)).strip() and r.n_chars == len(r.text)


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "quality", "near_copies", "personal_data", "packing"]
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "123 456", "en", "s", 7), (10**6 + 2, "call +1 (319) 555-5132 now and then", None, "s", 30)], docs.schema)
    kept = odd.unionByName(docs.limit(1)).unionByName(docs)
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stage(spark, before, DATA).cache()
        if name != "packing":
            assert kept.columns == docs.columns
        counts.append(kept.count())
    assert counts[0] == docs.count() + 2  # without the two that have no letter
    assert counts[0] > counts[1] > counts[2] == counts[3]
    assert kept.select("doc_id").distinct().count() == counts[3]
    assert kept.groupBy("sequence_id").agg(F.sum("length").alias("n")).where(F.col("n") > packing.WINDOW).isEmpty()


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert docs.count() == 0


def test_near_copy_stage_keeps_one_document_of_each_group(spark):
    rng = random.Random(8)
    texts = []
    for n in (8, 40, 120, 400, 900):
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for _ in range(14):
            words = list(base)
            if rng.random() < 0.6:
                words[rng.randrange(n)] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[0]), (900, ""), (901, None), (902, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' lang", "'s' source", "0L n_chars")
    groups = plain_groups({i: plain_fingerprint(t) for i, t in rows if i is not None})
    assert 1 < len(set(groups.values())) < 60
    kept = corpus_pipeline.drop_near_copies(spark, docs, DATA).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(set(groups.values()))
    assert sum(r.doc_id is None for r in kept) == 1


def test_an_odd_page_does_not_keep_the_template_text_of_its_host(spark):
    html = [page(f"<div><p>Welcome to the site</p><div><h1>{i}</h1><p>text {i}</p></div></div>") for i in range(8)]
    rows = [*enumerate(html), (100, None), (101, ""), (102, "broken")]
    pages = spark.createDataFrame([(i, "http://one.example/", h) for i, h in rows], "page_id long, url string, html string")
    found = {r.page_id: r.text for r in wrappers.main_text(pages).collect()}
    assert [found[i] for i in range(8)] == [f"{i} text {i}" for i in range(8)]
    assert (found[100], found[101], found[102]) == ("", "", "broken")


def test_elements_beyond_the_depth_close_only_themselves():
    def deep(inner):
        return "<div>" * 150 + inner + "</div>" * 150

    inner = "deep<nav>menu</nav><p>one<p>two<div class=ad>buy</div> <b>bold</b> end"
    assert text_of(f"<div><article><p>first</p>{deep(inner)}<p>later</p></article><p>out</p></div>") == "first deep one two bold end later"
    assert text_of(f"<div>{deep('<article>in</article>')}<p>out</p></div>") == "in"
    assert text_of(f"<article>{'<div>' * 150}cut</article><p>out</p>") == "cut"


def prose(seed, words=30):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(words))


def host_texts(spark, bodies, parts=2):
    rows = [(i, "http://one.example/", page(body)) for i, body in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts, "page_id")
    return {r.page_id: (r.text, r.by_slots) for r in wrappers.main_text(pages).collect()}


def test_a_teaser_in_an_article_element_does_not_hide_the_article(spark):
    bodies = [f"<div class=post><h1>{i}</h1><p>{prose(i)}</p></div><article><p>teaser {i}</p></article>" for i in range(6)]
    found = host_texts(spark, bodies)
    assert found == {i: (f"{i} {prose(i)}", True) for i in range(6)}


def test_longer_text_around_articles_does_not_replace_them(spark):
    bodies = [f"<article><p>{prose(i)}</p></article><div><p>{prose(-i - 1, 40)}</p></div>" for i in range(6)]
    assert host_texts(spark, bodies) == {i: (prose(i), True) for i in range(6)}


def test_equal_text_inside_all_articles_of_a_host_is_template_text(spark):
    bodies = [f"<article><h1>t {i}</h1><p>{prose(i)}</p><div><p>All rights reserved by Example Press</p></div></article>" for i in range(6)]
    assert host_texts(spark, bodies) == {i: (f"t {i} {prose(i)}", True) for i in range(6)}
    # Few pages are no evidence; and pages with most in common are copies.
    few = host_texts(spark, bodies[:4])
    assert few[0][0].endswith("All rights reserved by Example Press")
    copies = [f"<article><p>{prose(1)}</p><div><h2>{'edited' if i == 3 else 'kept'}</h2></div></article>" for i in range(8)]
    assert host_texts(spark, copies)[0][0] == f"{prose(1)} kept"


def test_slug_ids_do_not_widen_a_wrapper():
    whole = None
    for i in range(300):
        tree = wrappers.bare(wrappers.parse(page(f"<div id=post-x{prose(i, 1)}><p>{prose(i)}</p></div><div id=side-menu-{i}><p>m</p></div>"))[0])
        whole = tree if whole is None else wrappers.align(whole, tree)

    def nodes(node):
        return 1 + sum(map(nodes, node[wrappers.INSIDE]))

    assert nodes(whole) == nodes(tree)
    bodies = [f"<div id=post-x{prose(i, 1)}><p>{prose(i)}</p></div><div id=side-menu><p>m{i}</p></div>" for i in range(3)]
    assert text_of(bodies[0], bodies[1:]) == prose(0)


def test_main_texts_do_not_hang_on_the_partitioning(spark):
    rows = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url", "html")
    one, two = ({r.page_id: (r.text, r.by_slots) for r in wrappers.main_text(rows.repartition(n, "page_id")).collect()} for n in (1, 7))
    assert one == two
