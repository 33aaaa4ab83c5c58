"""Every operator on awkward rows against brute force: nulls, empty and long texts, ties,
repeated rows, empty tables and columns whose names clash."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pytest

from cratebook.llm import caps, decontaminate, idfile, pieces, pii, quality, sharding, simhash, toxicity, urls
from cratebook.llm.components import components
from cratebook.llm.queries import PIECE_MODEL, URL_RULES, WORD_TOKENIZER, vocabulary
from tests.llm import brute

LONG = "Lorem ipsum 12 " * 3000
PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = [
    (1, "Call +1 (944) 555-6250 or mail a.b@c.d_x@e.f now; server 10.0.0.1, 999.1.1.1.5.6.7, card 4111 1111 1111 1111."),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, LONG),
    (6, f"Ünder {PASSAGE.upper()} and ten eleven, twelve."),
    (7, "one two three four five six seven eight nine"),
    (8, "  \t\n "),
    (9, "日本語 😀 short item▁x  Å"),
    (9, "日本語 😀 short item▁x  Å"),
    (10, "4111111111111111 1.2.3.4.5.6.7.8 x@y +12 00.0.0.255 IBAN: GB82 WEST 1234 5698 7654 32 ssn 123-45-6789"),
    (None, "no id here"),
]
ITEMS = [(100, PASSAGE), (200, "short item"), (300, None), (400, ""), (500, PASSAGE)]
CLASH = "id long, text string, doc_id long, found string, n_words int, hit_runs int, marks int, score int, `a.b` int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(-1, t, i, "f", 0, 0, 0, 0, 0) for i, t in TEXTS]
    return spark.createDataFrame(rows, CLASH)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0], repr(r)))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(50, 60), (60, 50), (7, 7)], "a long, b long")
    got = dict(components(links).collect())
    assert got == {**{k: 0 for k in range(41)}, 50: 50, 60: 50}
    assert components(links.where("false")).count() == 0


def test_simhash(spark, docs, empty):
    want = brute.simhash_rows([(i, t) for i, t in TEXTS if i is not None])
    got = by_id(simhash.simhash_neardup(docs))
    assert len(got) == len(TEXTS)
    assert [r for r in got if r[0] is not None] == sorted((i, *want[i]) for i, _ in TEXTS if i is not None)
    assert got[-1][0] is None and got[-1][2] is None
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted({r[2] for r in got if r[0] is not None}) and None in ids
    assert simhash.simhash_neardup(empty).count() == 0


def test_simhash_of_an_id_with_several_texts(spark):
    text = " ".join(f"w{k}" for k in range(400))
    near = next(t for t in (text.replace(f"w{k} ", f"x{k} ") for k in range(100, 400)) if 0 < (brute.simhash(t) ^ brute.simhash(text)).bit_count() <= 3)
    other = " ".join(f"v{k}" for k in range(400))
    rows = [(3, text), (7, near), (7, other), (7, other), (8, other), (9, "some words here"), (9, near), (10, near + " "), (11, text[1:]), (11, near[1:])]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, fp string")
    roots = brute.components(range(len(rows)), [(a, b) for a in range(len(rows)) for b in range(a) if (brute.simhash(rows[a][1]) ^ brute.simhash(rows[b][1])).bit_count() <= 3])
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups[roots[k]] = min(i, groups.get(roots[k], i))
    want = sorted((i, f"{brute.simhash(t):016x}", groups[roots[k]]) for k, (i, t) in enumerate(rows))
    assert (7, f"{brute.simhash(other):016x}", 7) in want and (7, f"{brute.simhash(near):016x}", 3) in want
    assert sorted(map(tuple, simhash.simhash_neardup(docs).collect())) == want
    kept = [(r.doc_id, brute.simhash(r.text)) for r in simhash.keep_one_of_each(docs).collect()]
    assert len(kept) == len(groups) and sorted(i for i, _ in kept) == sorted(groups.values())
    assert (3, brute.simhash(text)) in kept and (7, brute.simhash(other)) in kept


def test_simhash_blocks_of_a_long_text_join(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 50)
    assert simhash.fingerprint(text) == whole == brute.simhash(text)


@pytest.mark.parametrize("limit", [4, 4096])
def test_long_posting_lists_are_split_exactly(spark, limit):
    rng = np.random.default_rng(1)
    centre = int(rng.integers(1 << 62))
    prints = {k: centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for k in range(150)}
    rows = [(k, v - (1 << 64) if v >> 63 else v) for k, v in prints.items()]
    got = {r[0]: r[2] for r in simhash.near_duplicates(spark.createDataFrame(rows, "id long, fp long"), 3, limit).collect()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert got == brute.components(prints, links)


@pytest.mark.parametrize("block", [5, 1_000_000])
def test_decontamination(docs, empty, items, block):
    want = brute.contamination(TEXTS, [i for i in ITEMS if i[1]])
    got = by_id(decontaminate.report(docs, items, block_words=block))
    assert got == sorted(((i, *want[i]) for i, _ in TEXTS), key=lambda r: (r[0] is None, r[0], repr(r)))
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in TEXTS if not want[i][4]}
    assert decontaminate.report(empty, items).count() == 0
    assert not any(r.contaminated for r in decontaminate.report(docs, items.where("false")).collect())


def test_decontamination_by_items_without_id(spark, docs):
    items = spark.createDataFrame([(None, PASSAGE), (None, PASSAGE + " thirteen"), (200, "call"), (None, "MAIL a.b"), (None, None)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.report(docs, items).collect()}
    assert got[6] == (12, 1, brute.sha(""), True) and got[1] == (4, 2, brute.sha("200"), True) and got[7] == (0, 0, brute.sha(""), False)
    assert 6 not in {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()}


def test_pii(docs, empty):
    got = by_id(pii.report(docs))
    texts = sorted(TEXTS, key=lambda r: (r[0] is None, r[0]))
    assert [r[:6] for r in got] == [(i, *brute.pii_row(t)) for i, t in texts]
    extra = {r[0]: r[6] for r in got}
    assert "iban:" in extra[10] and "ssn:" in extra[10]
    assert pii.report(empty).count() == 0
    masked = {r.doc_id: r.text for r in pii.mask_documents(docs).collect()}
    assert masked[2] is None and masked[4] == LONG
    assert "[EMAIL]" in masked[1] and "555" not in masked[1] and "server [IP]," in masked[1]


def test_pii_time_is_linear_in_hostile_texts(spark):
    hostile = ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "@" * 300_000, "1 " * 150_000]
    rows = spark.createDataFrame(list(enumerate(hostile)), "doc_id long, text string")
    assert pii.report(rows).count() == len(hostile)


def test_pieces_equal_the_library(docs, empty):
    import sentencepiece

    file = vocabulary(PIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=file)
    rows = by_id(pieces.encode_decode(docs, file))
    assert [(r[0], r[1], r[2]) for r in rows] == [(i, ids, library.decode(ids)) for i, t in sorted(TEXTS, key=lambda r: (r[0] is None, r[0])) for ids in [library.encode(t or "")]]
    digests = by_id(pieces.encode_decode_digests(docs, file))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert digests == [(i, len(ids), sha(",".join(map(str, ids))), sha(text)) for i, ids, text in rows]
    assert pieces.encode_decode_digests(empty, file).count() == 0


def test_piece_memory_bound_and_long_words():
    import sentencepiece

    file = vocabulary(PIECE_MODEL)
    library, encoder = sentencepiece.SentencePieceProcessor(model_file=file), pieces.Encoder(pieces.read_pieces(file), most=3)
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("etaoin shr\né▁漢 "), 60)) for _ in range(200)] + ["".join(rng.choice(list("etaoinshr"), 5000)), "a" * 5000]
    for t in texts:
        assert np.frombuffer(next(encoder([t]))[0], "<i4").tolist() == library.encode(t)


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, u in ((0, 0), (1, 1), (5, 5), (7, 10**6), (300, 301), (1000, 100_000)):
        values = np.sort(rng.integers(0, u + 1, n))
        code = idfile.EliasFano(idfile.EliasFano.write(values, u))
        assert code.selects(np.arange(n)).tolist() == values.tolist() == [code.select(k) for k in range(n)]
        some = rng.permutation(n)[: n // 2]
        first, last = code.spans(some)
        assert [(a, b) for a, b in zip(first.tolist(), last.tolist(), strict=True)] == [code.span(int(k)) for k in some]
    raw = idfile.EliasFano.write(np.arange(0, 10_000 * 400, 400), 10_000 * 400)
    assert len(raw) < 10_000 * 2


def test_id_files(spark, docs, empty, tmp_path):
    import tokenizers

    file = vocabulary(WORD_TOKENIZER)
    library = tokenizers.Tokenizer.from_file(file)
    start, want = 0, []
    for i, t in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    got = [tuple(r) for r in idfile.encoded_checksums(docs, file).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    path = str(tmp_path / "ids")
    idfile.write_ids(docs, path, lambda: idfile.WordTokenizer(file), block_ids=10, block_docs=2)
    assert idfile.read_one(spark, path, 7) == [[*library.encode(TEXTS[6][1], add_special_tokens=False).ids, 1]]
    assert len(idfile.read_one(spark, path, 9)) == 2
    assert idfile.encoded_checksums(empty, file).count() == 0


def test_word_tokenizer_equals_the_library():
    import tokenizers

    file = vocabulary(WORD_TOKENIZER)
    library, own = tokenizers.Tokenizer.from_file(file), idfile.WordTokenizer(file, most=50)
    rng = np.random.default_rng(4)
    alphabet = [*"abcDÉéZz'1.! \n", "n't", "ß", "Ÿ", "\x1c", " ", "́", "ā", "½", "<|endoftext|>", "Å"]
    for _ in range(800):
        t = "".join(rng.choice(alphabet, rng.integers(0, 16)))
        assert np.frombuffer(next(own([t])), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_shards(docs, empty, spark):
    got = by_id(sharding.shard_rows(docs, shards=5))
    texts = sorted(TEXTS, key=lambda r: (r[0] is None, r[0]))
    assert [r[:3] for r in got] == [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts]
    assert sharding.shard_rows(empty).count() == 0
    many = spark.range(1000).selectExpr("id AS doc_id", "'x' AS text")
    rows, grown = sharding.shard_rows(many).toPandas(), sharding.shard_rows(many, shards=25).toPandas()
    for shard in rows.groupby("shard").slot:
        assert sorted(shard[1]) == list(range(len(shard[1])))
    sizes = rows.shard.value_counts()
    assert len(sizes) == 24 and sizes.max() - sizes.min() <= 1
    moved = rows.merge(grown, on="doc_id").eval("shard_x != shard_y").mean()
    assert moved < 0.3
    # the walk, row by row: an arc's rows fill the next shards clockwise that have room
    places = sharding.ring(24)
    room = {s: 1000 // 24 + (s < 1000 % 24) for s in range(24)}
    points = sorted((int(hashlib.md5(str(k).encode()).hexdigest()[:8], 16), k) for k in range(1000))
    arcs = {}
    for p, k in points:
        arcs.setdefault(next((a for a, (q, _) in enumerate(places) if q >= p), 0), []).append(k)
    counts = {}
    for a in sorted(arcs):
        left = len(arcs[a])
        for s in dict.fromkeys(s for _, s in places[a:] + places[:a]):
            n = min(left, room[s])
            room[s] -= n
            left -= n
            if n:
                counts[a, s] = n
    where = {k: a for a, ks in arcs.items() for k in ks}
    got_counts = rows.assign(arc=rows.doc_id.map(where)).groupby(["arc", "shard"]).size().to_dict()
    assert got_counts == counts


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    rows = [(k, base[k].tolist()) for k in range(60)]
    rows += [(100 + k, (base[k % 5] + 0.1 * rng.standard_normal(16)).tolist()) for k in range(60)]
    rows += [(300, rows[0][1]), (300, rows[0][1]), (None, rows[0][1]), (400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [None] * 16), (404, [1.0]), (405, []), (406, [1e200, 0.0]), (407, [2e200, 0.0])]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], "vec_id long, embedding array<double>, cls int, n_links int")
    good = [(i, np.array(v) / np.abs(v).max()) for i, v in rows if i is not None and v and i not in (401, 402, 403)]
    links = [(a, b) for x, (a, u) in enumerate(good) for y, (b, w) in enumerate(good) if x != y and len(u) == len(w) and u @ w / np.sqrt((u @ u) * (w @ w)) >= 0.9]
    ids = {i for i, _ in rows if i is not None}
    root = brute.components(ids, links)
    want = {i: (sum(a == i for a, _ in links) // (2 if i == 300 else 1), root[i], root[i] == i) for i in ids}
    for part in (8, 2048):
        got = caps.near_vectors(df, words=256, alpha=0.45, part=part).collect()
        assert len(got) == len(rows)
        assert {r[0]: tuple(r[1:]) for r in got if r[0] is not None} == want
    assert caps.near_vectors(df.where("false")).count() == 0


def test_cap_decoding_lists_every_exceeding_direction():
    v = np.random.default_rng(5).standard_normal((40, 10))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rotation, (a, b) = caps._code(10, 32, 0)
    t = v @ rotation
    sums = ((t[:, :5] @ a)[:, :, None] + (t[:, 5:] @ b)[:, None, :]) / np.sqrt(2)
    want = {(i, j * 32 + k) for i, j, k in zip(*np.nonzero(sums >= 0.5), strict=True)}
    assert set(zip(*map(np.ndarray.tolist, caps.decode(v, 0.5, 32, 0)), strict=True)) == want


def test_near_vectors_of_any_length_by_default(spark):
    rng = np.random.default_rng(8)
    rows = []
    for dim in (2, 64, 96, 128, 384):
        for _ in range(150 if dim > 2 else 3):
            u, w = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
            a, b = len(rows), len(rows) + 1
            rows += [(a, u.tolist()), (b, (3 * (0.901 * u + np.sqrt(1 - 0.901**2) * w)).tolist())]
    units = [np.array(v) / np.linalg.norm(v) for _, v in rows]
    links = {(a, b) for a in range(len(rows)) for b in range(len(rows)) if a != b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.9}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in caps.near_vectors(df).collect()}
    root = brute.components(range(len(rows)), links)
    assert got == {i: (sum(a == i for a, _ in links), root[i]) for i in range(len(rows))}


def test_cap_threshold_follows_the_dimension():
    rng = np.random.default_rng(9)
    for dim in (64, 128, 384):
        u, w = np.linalg.qr(rng.standard_normal((300, dim, 2)))[0].transpose(2, 0, 1)
        found = [set(zip(*map(np.ndarray.tolist, caps.filters_of(x, 0.9, None, caps.WORDS, caps.TABLES)), strict=True)) for x in (u, 0.9 * u + np.sqrt(0.19) * w)]
        shared = np.bincount([i for i, _ in found[0] & found[1]], minlength=300)
        assert shared.min() > 0 and 40 < shared.mean() < 70 and len(found[0]) < 300 * 300
    assert caps.far(0.9) == 46
    with pytest.raises(ValueError, match="128 dimensions"):
        caps.threshold(128, 0.9, caps.WORDS, caps.TABLES, 0.5)
    with pytest.raises(ValueError, match="no threshold"):
        caps.threshold(64, 0.1, caps.WORDS, caps.TABLES)


def test_urls(spark):
    link = lambda h: f'<a HREF="https://{h}/x">x</a>'
    rows = [
        (1, "https://www.example.com/en/a?b", ""), (2, "http://M.Example.com/en/a", None), (3, "http://x.net/es/1", link("y.org")),
        (4, "http://x.net/en/1", ""), (5, "http://x.net/fr/1", ""), (6, "http://farm.org/1", link("x.net")), (7, "http://y.org/#t", ""),
        (8, None, None), (9, "nonsense", ""), (10, "ftp://a.com", ""), (11, "http://a.com/", link("good.org")), (12, "http://good.org?x=/", ""), (12, "http://good.org?x=/", ""),
    ]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, URL_RULES).collect()}
    assert got == {
        1: ("www.example.com", "/en/a", "www.example.com/en/", "allow"), 2: ("m.example.com", "/en/a", "example.com/en/", "block"),
        3: ("x.net", "/es/1", "net/es/", "block"), 4: ("x.net", "/en/1", None, "block"), 5: ("x.net", "/fr/1", "net/fr/", "block"),
        6: ("farm.org", "/1", None, "block"), 7: ("y.org", "/", None, "allow"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"),
        10: ("a.com", "", None, "allow"), 11: ("a.com", "/", "com/", "allow"), 12: ("good.org", "", None, "allow"),
    }
    assert urls.judge(pages, URL_RULES).count() == len(rows)
    assert urls.judge(pages.where("false"), URL_RULES).count() == 0


def plain_rank(seed, edges, rounds=600):
    """Personalised PageRank; a host without edges returns its score to the seeds."""
    score, mass = dict(seed), sum(seed.values())
    hosts = {*seed, *[h for e in edges for h in e]}
    for _ in range(rounds):
        new = {h: 0.0 for h in hosts}
        for h, w in seed.items():
            new[h] += 0.15 * w
        for h, x in score.items():
            out = [b for a, b in edges if a == h]
            for b in out:
                new[b] += 0.85 * x / len(out)
            if not out:
                for s, w in seed.items():
                    new[s] += 0.85 * x * w / mass
        score = new
    return score


def test_page_rank_equals_plain_iteration(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("e", "a")]
    flows = spark.createDataFrame([("trust", *e) for e in edges], "kind string, host string, other string")
    seeds = spark.createDataFrame([("trust", "a", 0.5), ("trust", "e", 2.0)], "kind string, host string, seed double")
    got = {r.host: r.score for r in urls.propagate(seeds, flows).collect()}
    assert got == pytest.approx(plain_rank({"a": 0.5, "e": 2.0}, edges), abs=1e-6)


def site(spark, links, urls_of):
    """Pages with urls; ``links`` (host, host) are put on the first page of the first host."""
    rows = [(k, u, "".join(f'<a href="http://{b}/">' for a, b in links if urls_of.index(u) == k and f"//{a}/" in u)) for k, u in enumerate(urls_of)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_a_chain_of_hosts_is_judged_by_score_not_by_hops(spark, monkeypatch):
    chain = ["bad.net", *[f"c{k}.org" for k in range(100)]]
    links = [(b, a) for a, b in zip(chain, chain[1:], strict=False)]
    pages = site(spark, links, ["http://bad.net/es/1", *[f"http://{h}/1" for h in chain[1:]]])
    monkeypatch.setattr(urls, "LEAST", 1e-9)
    monkeypatch.setattr(urls, "WRITE_EVERY", 6)
    monkeypatch.setattr(urls.propagate, "__defaults__", (1e-10, urls.DAMPING))
    rows = urls.judge(pages, URL_RULES).collect()
    want = plain_rank({"bad.net": 1.0}, [(a, b) for b, a in links], 400)
    assert {r.host: r.distrust for r in rows} == pytest.approx(want, abs=1e-9)
    # Every host reaches the blocked one, and all of them score above the least.
    assert {r.verdict for r in rows} == {"block"} and min(want.values()) > 1e-9


def test_a_host_with_some_blocked_pages_spreads_its_share(spark):
    own = [f"http://mixed.net/{'es' if k < 9 else 'en'}/{k}" for k in range(20)]
    pages = site(spark, [("farm.org", "mixed.net")], [*own, "http://farm.org/1", "http://rare.org/1"])
    got = {r.host: (r.verdict, r.distrust) for r in urls.judge(pages, URL_RULES).collect() if r.rule is None}
    want = plain_rank({"mixed.net": 0.45}, [("mixed.net", "farm.org")])
    assert got["mixed.net"][0] == got["farm.org"][0] == "block" and got["rare.org"] == ("allow", 0.0)
    assert {h: got[h][1] for h in want} == pytest.approx(want, abs=1e-6)


def test_many_trusted_hosts_outweigh_one_link_to_a_blocked_one(spark):
    trusted = [f"t{k}.com" for k in range(50)]
    links = [*[(t, o) for t in trusted for o in ("o0.org", "o1.org")], ("o0.org", "bad.net"), ("spam.org", "bad.net")]
    hosts = [*trusted, "o0.org", "o1.org", "spam.org"]
    pages = site(spark, links, [*[f"http://{h}/" for h in hosts], "http://bad.net/fr/"])
    got = {r.host: r.verdict for r in urls.judge(pages, URL_RULES).collect()}
    assert {h: got[h] for h in ("o0.org", "o1.org", "spam.org")} == {"o0.org": "allow", "o1.org": "allow", "spam.org": "block"}


def test_toxicity_and_quality_learn_only_outside_the_held_out_rows(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 1 - toxic, toxic) toxic", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 1 - quality, quality) quality")
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.place == b.place and np.array_equal(a.weights, b.weights) and (np.diff(a.cuts) > 0).all()
    q, r = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert np.array_equal(q.vectors, r.vectors) and np.array_equal(q.network.w1, r.network.w1)


def test_toxicity_on_awkward_rows(spark, docs, empty):
    words = "lovely day for a walk in the park".split()
    texts = [(k, " ".join([*words, *(["idiot"] * (k % 7) if k % 2 else [])])) for k in range(1, 200)]
    train = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int("idiot" in t)) for k, t in texts], "doc_id long, toxic int")
    model = toxicity.fit(train, labels)
    got = {r.doc_id: r for r in toxicity.severity(train, model).collect()}
    assert all(got[k].toxic == ("idiot" in t) for k, t in texts)
    assert got[1].severity < got[3].severity < got[5].severity
    assert {r.toxic for r in toxicity.severity(docs, model).collect()} == {False}
    assert toxicity.drop_toxic(docs, model).columns == docs.columns and toxicity.drop_toxic(docs, model).count() == len(TEXTS)
    assert toxicity.severity(empty, model).count() == 0
    assert not toxicity.fit(train, labels.where("false")).place


def test_quality_on_awkward_rows(spark, docs, empty):
    texts = [(k, "A quiet river runs by the old mill and on." if k % 3 else "BUY!! NOW!! $$$ BEST!! BEST!! BEST!!") for k in range(300)]
    train = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k, _ in texts], "doc_id long, quality int")
    model = quality.fit(train, labels)
    got = quality.scores(train, model).collect()
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in got if r.held_out) and any(r.held_out for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    rows = quality.scores(docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert quality.scores(empty, model).count() == 0
    assert quality.fit(empty, labels.where("false")).base == 0.5


def test_context_sums_equal_plain_counting(spark):
    texts = ["a b c a", None, "", "c c d"]
    got = quality.context_sums(spark.createDataFrame([(t,) for t in texts], "text string"))
    place, sign = quality._index()
    index = np.zeros((quality.BUCKETS, quality.DIM), int)
    for b in range(quality.BUCKETS):
        for p, s in zip(place[b], sign[b], strict=True):
            index[b, p] += int(s)
    want = np.zeros_like(index)
    tokens = quality.Tokens()
    for t in texts:
        ids = tokens(t or "")
        for i, a in enumerate(ids):
            for j, b in enumerate(ids):
                if 0 < abs(i - j) <= quality.REACH:
                    want[a] += index[b]
    assert np.array_equal(got, want)
