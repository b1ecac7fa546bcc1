"""Odd tables: nulls, repeated rows, very long texts, clashing column names, empty tables; networks by plain loops."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagegrid.llm import language, quality, token_counts, url_filter, warc
from pagegrid.llm.cnn import Network, Shape, class_scores, document_scores, softmax, train_documents, train_windows
from pagegrid.llm.decontaminate import contained_items, drop_contaminated
from pagegrid.llm.exact_dedup import drop_copies, exact_dedup
from pagegrid.llm.near_copies import drop_near_copies, near_copies
from pagegrid.llm.packing import pack
from pagegrid.llm.repeats import repeated_passages
from pagegrid.llm.simhash import near_dedup
from pagegrid.llm.url_filter import Rule, judge

#: Names that the operators use inside.
NAMES = "id h text_sha256 keep_id group_size kept __sha th pos core context full fp node keys component component_id tokens blank key payload sha short first refers_to score lang_pred label host path rule ruled slot item matched".split()


def odd(spark, rows, schema):
    """rows, each one's other columns filled with other values."""
    names = [n for n in NAMES if n not in schema.replace(",", " ").split()]
    full = [(*r, *range(len(names))) for r in rows]
    return spark.createDataFrame(full, f"{schema}, " + ", ".join(f"`{n}` int" for n in names)).repartition(3)


def spoken(rng, n, words=500):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    long = spoken(rng, 60_000)
    shared = spoken(rng, 70)
    return [(1, "a b c"), (1, "a b c"), (2, "a  b c"), (None, "a b c"), (None, "alone here"), (3, None), (4, ""), (5, long), (5, long), (6, shared + " x"), (7, "y " + shared), (7, "y " + shared), (None, None)]


def table(spark, texts):
    return odd(spark, texts, "doc_id long, text string")


def test_exact(spark, texts):
    got = exact_dedup(table(spark, texts)).collect()
    assert len(got) == len(texts)
    by = {(r.doc_id, r.group_size): (r.keep_id, r.kept) for r in got}
    assert by[1, 4] == (1, True) and by[2, 4] == (1, False) and by[None, 4] == (1, False) and by[None, 1] == (None, True) and by[3, 3] == (3, True) and by[None, 3] == (3, False)
    kept = drop_copies(table(spark, texts))
    assert kept.columns == table(spark, texts).columns
    assert Counter(r.doc_id for r in kept.collect()) == {1: 2, None: 1, 3: 1, 5: 2, 6: 1, 7: 2}
    assert drop_copies(table(spark, texts).limit(0)).count() == 0


def test_near(spark, texts):
    got = near_dedup(table(spark, texts)).collect()
    assert Counter((r.doc_id, r.component_id) for r in got if r.fingerprint == "0" * 16) == {(3, 3): 1, (4, 3): 1, (None, 3): 1}
    assert len(got) == len(texts) and {(r.doc_id, r.component_id) for r in got} >= {(1, 1), (2, 1), (None, 1), (None, None), (5, 5)}
    got = near_copies(table(spark, texts)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (None, 1), (None, None), (3, 3), (4, 3), (None, 3), (5, 5), (6, 6), (7, 6)}
    kept = drop_near_copies(table(spark, texts))
    assert kept.columns == table(spark, texts).columns and {r.doc_id for r in kept.collect()} == {1, 3, 5, 6, None}
    assert drop_near_copies(table(spark, texts).limit(0)).count() == 0


def test_contained(spark, texts):
    items = odd(spark, [(10, "A, b"), (10, "A, b"), (11, None), (None, "alone here")], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in contained_items(table(spark, texts), items).collect())
    assert got == {(1, 10): 4, (2, 10): 2, (None, 10): 2, (None, None): 1}
    left = drop_contaminated(table(spark, texts), items)
    assert left.columns == table(spark, texts).columns and Counter(r.doc_id for r in left.collect()) == {3: 1, 4: 1, 5: 2, 6: 1, 7: 2, None: 1}
    assert drop_contaminated(table(spark, texts).limit(0), items).count() == 0


def test_passages(spark, texts):
    got = Counter(tuple(r)[:3] for r in repeated_passages(table(spark, texts)).collect())
    assert got == {(5, 0, 60_000): 1, (6, 0, 70): 1, (7, 0, 71): 1}


@pytest.mark.parametrize(("bits", "partitions"), [(8, 4), (3, 60), (1, 7)])
def test_passages_with_clashing_hashes_and_over_many_tasks(spark, bits, partitions):
    """Hashes of a few bits only: all kinds of unequal words meet, and the words decide. A hot passage goes through many tasks."""
    rng = random.Random(9)
    common = [spoken(rng, 30, 3000) for _ in range(3)]
    rows = [" ".join(x for _ in range(3) for x in (spoken(rng, rng.randrange(25), 3000), rng.choice(common))) for _ in range(60)] + ["a b", None, "x " * 40]
    found = Counter()
    w = [(t or "").split() for t in rows]
    found.update(tuple(x[i : i + 20]) for x in w for i in range(len(x) - 19))
    want = set()
    for d, x in enumerate(w):
        spans = []
        for i in range(len(x) - 19):
            if found[tuple(x[i : i + 20])] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 20
                else:
                    spans.append([i, i + 20])
        want |= {(d, a, b) for a, b in spans}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = repeated_passages(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3), min_words=20, spread=6, hash_bits=bits)
        assert {tuple(r)[:3] for r in got.collect()} == want and len(want) > 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_pieces(spark, texts):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    got = pack(table(spark, texts), path).collect()
    lengths = defaultdict(int)
    for r in got:
        lengths[r.doc_id] += r.length
    totals = {(r.doc_id, r.doc_tokens) for r in got}
    assert (3, 1) in totals and (4, 1) in totals and (None, 1) in totals and len([t for t in totals if t[0] is None]) == 3
    assert lengths[1] == 2 * next(n for i, n in totals if i == 1) and lengths[5] == 2 * next(n for i, n in totals if i == 5)
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    for (s, at, n), (t, to, _) in zip(places, places[1:]):
        assert to == (at + n if s == t else 0)


def test_counts_are_the_librarys(spark, texts, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path
    library = tokenizers.Tokenizer.from_file(path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rng = random.Random(3)
    more = [(i, "".join(rng.choice("abAB'st ve12½ªßé.,!-—\u00a0\n\t日本😀<|endoftext|>") for _ in range(rng.randrange(80)))) for i in range(100, 300)]
    rows = odd(spark, [(i, t, s, "en") for s in ("x", None) for i, t in [*texts, *more]], "doc_id long, text string, source string, lang string")
    counted = token_counts.count_tokens(rows, path("byte_bpe_50k.tiktoken"), "v")
    want = Counter((i, len(library.encode(t or "", add_special_tokens=False).ids)) for _ in "xy" for i, t in [*texts, *more])
    assert Counter((r.id, r.tokens) for r in counted.collect()) == want
    rollup = token_counts.Rollup(spark, f"file://{tmp_path}/r")
    rollup.commit("one", token_counts.inserts(counted))
    total = (len(texts) + len(more), sum(n * c for (_, n), c in want.items()) // 2)
    assert {r.source: (r.documents, r.tokens) for r in rollup.totals().collect()} == {"x": total, None: total}
    rollup.commit("none", token_counts.inserts(counted.limit(0)))
    assert rollup.totals().count() == 2 and token_counts.count_tokens(rows.limit(0), path("byte_bpe_50k.tiktoken"), "v").count() == 0


def test_two_tries_of_a_batch_count_once(spark, tmp_path):
    counted = spark.createDataFrame([(1, "s", "en", "v", 5, False)], "id long, source string, lang string, tokenizer string, tokens long, blank boolean")
    rollup = token_counts.Rollup(spark, f"file://{tmp_path}/r")
    slow = f"{rollup.folder}/data/one-slow"  # has written its sums, and has not named them yet
    token_counts.delta(token_counts.inserts(counted)).write.parquet(slow)
    assert rollup.commit("one", token_counts.inserts(counted))
    assert not rollup._publish(slow, f"{rollup.folder}/commits/one")
    token_counts.delta(token_counts.inserts(counted)).write.parquet(f"{rollup.folder}/data/two-broken")  # its commit never came
    assert [(r.documents, r.tokens) for r in rollup.totals().collect()] == [(1, 5)]
    assert rollup.commit("two", token_counts.inserts(counted)) and [(r.documents, r.tokens) for r in rollup.totals().collect()] == [(2, 10)]


def test_records(spark):
    html = "<p>" + "é" * 3_000_000
    pages = odd(spark, [(1, "http://a", "x"), (1, "http://a", "x"), (2, None, "x"), (None, "http://b", "x"), (None, "http://c", None), (3, "http://d", html), (4, "http://d", html)], "page_id long, url string, html string")
    got = Counter(tuple(r)[0:2] + tuple(r)[3:] for r in warc.round_trip(pages).collect())
    n = len(html.encode())
    assert got == {(1, 1, "response", None): 2, (2, 1, "revisit", 1): 1, (None, 1, "response", None): 1, (None, 0, "response", None): 1, (3, n, "response", None): 1, (4, n, "revisit", 3): 1}
    packages = warc.write_packages(pages, warc.scratch_path(spark, "some"))
    read = warc.read_records(warc.record_places(packages)).collect()
    assert Counter(None if r.payload is None else bytes(r.payload).decode() for r in read) == {"x": 3, "": 1, html: 1, None: 2}


def test_packages_from_elsewhere(tmp_path):
    """Several archives, one of them without an index, an index with keys before its JSON, and a compressed member."""
    import json
    import zipfile

    records = [warc.record(str(i), f"http://x/{i}", b"p" * i, None) for i in range(9)]
    path = tmp_path / "x.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/one.warc.gz", b"".join(records[:4]))
        z.writestr("archive/two.warc.gz", b"".join(records[4:]))
        z.writestr("archive/none.warc.gz", b"")
        at, lines = 0, []
        for r in records[:4]:
            lines.append("com,x)/ 2000 " + json.dumps({"filename": "one.warc.gz", "offset": str(at), "length": str(len(r))}))
            at += len(r)
        z.writestr("indexes/index.cdxj", "\n".join(lines))
        z.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
    data = path.read_bytes()
    package = warc.ZipPackage(lambda at, k: data[at : at + k], len(data))
    got = [warc.parse(data[a : a + n])[2] for a, n in warc.package_places(package)]
    assert got == [b"p" * i for i in range(9)]
    with pytest.raises(ValueError, match="too early"):
        list(warc.scanned(lambda at, k: records[8][at : at + k], 0, len(records[8]) - 5))


def brute_rank(edges, seeds, hosts):
    n = Counter(a for a, _ in edges)
    x = dict(seeds)
    for _ in range(120):
        new = {h: 0.15 * seeds.get(h, 0.0) for h in hosts}
        lost = sum(x.get(h, 0.0) for h in hosts if not n[h])
        for h, s in seeds.items():
            new[h] += 0.85 * lost * s
        for a, b in edges:
            new[b] += 0.85 * x.get(a, 0.0) / n[a]
        x = new
    return x


def test_ranks_of_ten_thousand_hosts_with_a_hub(spark):
    rng = random.Random(1)
    hosts = [f"h{i}.example" for i in range(10_000)]
    out = {h: [rng.choice(hosts) for _ in range(rng.randrange(4))] for h in hosts}
    out[hosts[0]] = hosts
    pages = [(i, f"https://{h}/p", " ".join(f'<a href="http://{x}/y">' for x in out[h])) for i, h in enumerate(hosts)]
    rules = [Rule("allow", hosts[0], "/p"), *(Rule("block", h, "/") for h in hosts[1:2000])]  # more than any list of expressions bears
    got = judge(odd(spark, pages, "page_id long, url string, html string"), rules).collect()
    edges = {(a, b) for a in hosts for b in out[a] if a != b}
    trust = brute_rank(edges, {hosts[0]: 1.0}, hosts)
    distrust = brute_rank({(b, a) for a, b in edges}, {h: 1 / 1999 for h in hosts[1:2000]}, hosts)
    assert len(got) == 10_000 and sum(r.rule is not None for r in got) == 2000
    assert sum(abs(r.trust - trust[r.host]) + abs(r.distrust - distrust[r.host]) for r in got) < 2e-4
    wrong = [r for r in got if r.rule is None and (r.verdict == "block") != (distrust[r.host] > trust[r.host]) and abs(distrust[r.host] - trust[r.host]) > 1e-6]
    assert not wrong and {r.verdict for r in got if r.rule is None} == {"allow", "block"}


def test_rules_against_brute_force(spark):
    rng = random.Random(2)
    part = lambda: ".".join(rng.choice("abc") for _ in range(rng.randrange(1, 4)))
    way = lambda: "".join(rng.choice("/xy") for _ in range(rng.randrange(4)))
    rules = [Rule(rng.choice(["allow", "block"]), part(), way()) for _ in range(60)] + [Rule("allow", "a", ""), Rule("block", "a", ""), Rule("block", "ab", "/"), Rule("allow", "", "/zz")]
    pages = [(i, f"http://{part()}{way()}{rng.choice(['', '?q', '#f'])}", None) for i in range(400)] + [(900, "http://a..b/x", None), (901, "http://xab/", None), (902, "http://", None), (903, None, None), (904, "http:///zz", None)]
    got = {r.page_id: r for r in judge(odd(spark, pages, "page_id long, url string, html string"), rules).collect()}
    for i, url, _ in pages:
        found = re.match(r"[^:]*://([^/?#]*)([^?#]*)", url or "")
        host, path = found.groups() if found else ("", "")
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: (len(r.name), r.name, r.verdict), default=None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best.name if best else None), url
        assert best is None or got[i].verdict == best.verdict
    table = url_filter.rules_table(spark, rules).unionByName(spark.createDataFrame([(None, None, None)], "verdict string, host string, path string"))
    assert Counter(judge(odd(spark, pages, "page_id long, url string, html string"), table).select("rule").collect()) == Counter((r.rule,) for r in got.values())
    assert {r.rule for r in judge(odd(spark, pages, "page_id long, url string, html string"), []).collect()} == {None}


def test_given_rules_are_those_of_the_contract(spark):
    assert [(r.verdict, r.name) for r in url_filter.RULES] == [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
    want = {
        "http://a.com/en/1": ("com/en/", "block"), "http://Example.COM/en/1": ("com/en/", "block"), "http://w.example.com/en/7x": ("example.com/en/7", "allow"),
        "http://a.net/de/8": ("net/de/", "allow"), "http://example.net/de/7": ("net/de/", "allow"), "http://w.example.net/de/81?q": ("example.net/de/8", "block"),
        "http://a.org/es/": ("org/es/", "block"), "http://net/de": (None, "allow"), "http://bexample.net.xy/de/8": (None, "allow"),
    }
    pages = [(i, url, None) for i, url in enumerate(want)]
    got = judge(odd(spark, pages, "page_id long, url string, html string")).collect()
    assert {pages[r.page_id][1]: (r.rule, r.verdict) for r in got} == want


def test_very_long_page(spark):
    pages = [(1, "http://a/p", "".join(f"<a href='//h{i}'>" for i in range(50_000))), (2, "http://h7/", None)]
    got = {r.page_id: r for r in judge(spark.createDataFrame(pages, "page_id long, url string, html string"), [Rule("block", "h7", "/")]).collect()}
    assert got[1].verdict == "block" and got[1].distrust > 0


SMALL = Shape(window=24, step=18, embedding=3, widths=(2, 4), filters=3)


def loop_pooled(net, x):
    """One window: each filter at each place, by plain loops."""
    s, out = net.shape, []
    kernel = net.p["kernel"].reshape(s.span, s.embedding, s.channels)
    for c in range(s.channels):
        width = s.widths[c // s.filters]
        best = max(sum(float(kernel[k, d, c]) * float(net.p["embedding"][x[at + k], d]) for k in range(width) for d in range(s.embedding)) for at in range(s.window - s.span + 1))
        out.append(max(0.0, best + float(net.p["bias"][c])))
    return np.array(out)


def loop_windows(text):
    data, out, at = text.encode(), [], 0
    while not out or at + SMALL.window - SMALL.step < len(data):
        out.append(list(data[at : at + SMALL.window].ljust(SMALL.window, b"\0")))
        at += SMALL.step
    return out


def test_networks_against_plain_loops():
    rng = random.Random(4)
    texts = [None, "", "é", *("".join(rng.choice("abcé ") for _ in range(rng.randrange(120))) for _ in range(12))]
    label = np.array([i % 3 for i in range(12)])
    net = train_windows([t.encode() for t in texts[3:]], label, 3, SMALL, epochs=2, batch=5)
    got = np.concatenate(list(class_scores(pa.array(texts), net)))
    for t, p in zip(texts, got):
        each = [softmax(loop_pooled(net, x) @ net.p["dense"] + net.p["out"]) for x in loop_windows(t or "")]
        assert p == pytest.approx(softmax(np.mean(np.log(np.array(each) + 1e-6), 0)), abs=1e-4)
    net = train_documents([t.encode() for t in texts[3:]], (label > 0).astype(float), SMALL, epochs=2, batch=5)
    got = np.concatenate(list(document_scores(pa.array(texts), net)))
    for t, p in zip(texts, got):
        f = np.array([loop_pooled(net, x) for x in loop_windows(t or "")])
        logit = np.concatenate([f.max(0), f.mean(0)]) @ net.p["dense"][:, 0] + net.p["out"][0]
        assert p == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-4)


def test_gradients_are_the_slopes():
    rng = np.random.default_rng(5)
    net = Network(SMALL, 2, SMALL.channels)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.integers(97, 110, (6, SMALL.window)).astype(np.uint8)
    weight = rng.normal(size=(6, SMALL.channels))
    f, at = net.pooled(x, True)
    grads = net.back(x, f, at, weight)
    for name in ("embedding", "kernel", "bias"):
        where = np.argwhere(np.abs(grads[name]) > 1e-3)
        for i in map(tuple, where[rng.permutation(len(where))[:10]]):
            slope = []
            for e in (1e-5, -1e-5):
                old = net.p[name][i]
                net.p[name][i] = old + e
                slope.append((net.pooled(x) * weight).sum())
                net.p[name][i] = old
            assert grads[name][i] == pytest.approx((slope[0] - slope[1]) / 2e-5, rel=1e-3, abs=1e-4)


def labelled(rng, n):
    return [(i, " ".join("".join(rng.choice("abcde" if i % 2 else "vwxyz") for _ in range(5)) for _ in range(rng.randrange(3, 60))), ("bb", "aa")[i % 2]) for i in range(n)]


def test_classifiers_on_odd_tables(spark, texts):
    rows = labelled(random.Random(8), 160)
    rows = [*rows, *rows[:40], (None, "abc abc", "aa"), (900, "abcde " * 40_000, "aa"), (901, None, "aa"), (902, "", None)]
    docs = odd(spark, rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    got = language.identify(docs, model)
    assert got.columns == ["doc_id", "lang_pred", "score"] and got.count() == len(rows)
    found = defaultdict(set)
    for r in got.collect():
        found[r.doc_id].add((r.lang_pred, round(r.score, 3)))
    assert all(len(x) == 1 for x in found.values()) and found[900] and next(iter(found[900]))[0] == "aa"
    held = [r for r in rows[:160] if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert np.mean([next(iter(found[i]))[0] == lang for i, _, lang in held]) > 0.95
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns and not {r.doc_id for r in kept.collect()} & {901, 902} and language.keep_known(docs.limit(0), model).count() == 0
    marks = odd(spark, [(i, int(lang == "aa")) for i, _, lang in rows[:160]] * 2 + [(None, 1), (3, None)], "doc_id long, quality int")
    scorer = quality.fit(docs, marks)
    scored = quality.score(docs, scorer)
    assert scored.columns == ["doc_id", "score"] and scored.count() == len(rows) and quality.score(docs.limit(0), scorer).count() == 0
    marks_of = {r.doc_id: r.score for r in scored.collect()}
    assert all(0 <= x <= 1 for x in marks_of.values()) and marks_of[900] > 0.5 and marks_of[901] == pytest.approx(marks_of[902], abs=1e-6)
    assert quality.fit(docs.limit(0), marks).net is None and quality.score(docs, quality.fit(docs.limit(0), marks)).count() == len(rows)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from pagegrid import runtime

    for master in ("local-cluster[2,1,1024]", "yarn", "spark://x:7077"):
        bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
        with pytest.raises(RuntimeError, match="checkpoint"):
            runtime.shared_dir(bare)
    assert runtime.qualified(spark, "/tmp/x").startswith("file:/")


def test_queries_leave_only_their_result(spark, tmp_path):
    from pagegrid import runtime
    from pagegrid.llm.queries import QUERIES

    spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    before = runtime.scratch_mark()
    got = QUERIES["op1_exact_dedup"](spark, f"file://{tmp_path}")
    assert len(runtime.scratch_mark() - before) == 1 and got.where(F.col("kept")).count() == 1


def test_pipeline_against_plain_loops(spark, tmp_path):
    """Each stage is done again by loops on what is left, but for the language's model, which is the pipeline's own."""
    import corpus_pipeline
    from pagegrid.llm.packing import WordBpe

    vocabulary = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    rng = random.Random(21)
    rows = [(i, t, lang) for i, t, lang in labelled(rng, 90)]
    base = [rng.choice("abcde") * 2 + "".join(rng.choice("abcde") for _ in range(5)) for _ in range(150)]
    for i in range(100, 130):
        w = list(base)
        for _ in range(rng.randrange(8)):
            w[rng.randrange(150)] = "".join(rng.choice("abcde") for _ in range(7))
        rows.append((i, " ".join(w), "bb"))
    rows += [(200 + i, rows[i][1].replace(" ", " \n"), "aa") for i in range(0, 20, 3)] + [(300, None, "aa"), (301, "", None), (302, "?! 12", "aa"), (303, rows[40][1] + " " + rows[7][1], "aa"), (303, rows[40][1] + " " + rows[7][1], "aa"), (None, rows[2][1], "aa"), (None, "abcab bcabc cabca", "bb")]
    items = [(0, " ".join(rows[7][1].split()[:12])), (1, None), (2, "vwxyz zzz none of these words")]
    at = f"file://{tmp_path}"
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    docs = spark.read.parquet(f"{at}/documents.parquet")

    found = language.identify(docs.select("doc_id", "text"), language.fit(docs)).collect()
    good = Counter(r.doc_id for r in found if r.lang_pred != "und" and r.score >= 0.5)
    assert not {300, 301, 302} & set(good)
    left = [r for r in rows if r[0] in good]
    order = lambda i: (i is None, i)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    least = {}
    for i, t, _ in left:
        least[norm(t)] = min(least.get(norm(t), i), i, key=order)
    left = [r for r in left if least[norm(r[1])] == r[0]]

    def grams(t, k=5):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        return {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))}

    sets = [grams(t) for _, t, _ in left]
    label = list(range(len(left)))
    linked = [(a, b) for a in label for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for _ in label:
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    first = {}
    for a, r in zip(label, left):
        first[a] = min(first.get(a, r[0]), r[0], key=order)
    left = [r for a, r in zip(label, left) if first[a] == r[0]]
    held = lambda t, item: (own := grams(item, min(5, len(item.split())))) and len(own & grams(t, min(5, len(item.split())))) >= 0.8 * len(own)
    left = [r for r in left if not any(held(r[1], item) for _, item in items if item)]
    assert len(linked) > 20 and 40 < len(left) < len(rows) - 30 and 7 not in {r[0] for r in left}

    library = WordBpe(vocabulary).library
    ids = {r[0]: [*library.encode(r[1], add_special_tokens=False).ids, 2] for r in left}
    got = corpus_pipeline.run(spark, at).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    times = Counter(r[0] for r in left)
    assert all(sum(n for _, n in pieces[i]) == times[i] * len(ids[i]) for i in ids)
    assert all(sum(n for _, n in s) <= 4096 and sorted(o for o, _ in s)[0] == 0 for s in sequences.values())
