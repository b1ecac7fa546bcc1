"""Operators for training text against brute force, with nulls, empty texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from pagegrid.llm import language, quality, token_counts, warc
from pagegrid.llm.decontaminate import contained_items, drop_contaminated
from pagegrid.llm.exact_dedup import drop_copies, exact_dedup
from pagegrid.llm.near_copies import drop_near_copies, near_copies
from pagegrid.llm.packing import WordBpe, fill, pack
from pagegrid.llm.repeats import repeated_passages
from pagegrid.llm.simhash import links, near_dedup
from pagegrid.llm.url_filter import Rule, judge

DOCS = "doc_id long, text string, h string, keep_id string, fp long, component string, id int"


def docs(spark, texts, first=0):
    return spark.createDataFrame([(None if i == -1 else i + first, t, "x", "y", 1, "z", 2) for i, t in enumerate(texts)], DOCS).repartition(3)


def spoken(rng, n, words=200):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def test_exact_dedup(spark):
    texts = ["a  b", "a b", "a\tb", None, "", " ", "  ", "a b ", "é", "x" * 100_000, "x" * 100_000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(1, "a b"), (None, "é")], "doc_id long, text string")
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for i, t in [*enumerate(texts), (1, "a b"), (None, "é")]:
        groups[norm(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = min(i for i in ids if i is not None)
        for i in ids:
            want[(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter(map(tuple, exact_dedup(rows).collect())) == want
    # a hash that always clashes: the bytes decide
    assert Counter(map(tuple, exact_dedup(rows, hash_fn=lambda t: F.lit(b"0")).collect())) == want
    kept = drop_copies(docs(spark, texts))
    assert kept.columns == docs(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 5, 7, 8, 9]
    assert exact_dedup(rows.limit(0)).count() == 0


def brute_fingerprint(text):
    b = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", b)
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def brute_components(ids, prints):
    label = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if (prints[i] ^ prints[j]).bit_count() <= 2 and label[j] < label[i]:
                    label[i], changed = label[j], True
    out = {}
    for i, x in enumerate(ids):
        out[x] = min(ids[j] for j in range(len(ids)) if label[j] == label[i])
    return out


def test_near_dedup(spark):
    rng = random.Random(3)
    base = spoken(rng, 300, 5000).split()
    texts = [None, "", " \n", "A b", "a B", "one", spoken(rng, 50), "ü" * 50_000]
    for _ in range(25):
        w = list(base)
        w[rng.randrange(300)] = "changed"
        texts.append(" ".join(w))
    ids = list(range(len(texts)))
    prints = [brute_fingerprint(t) for t in texts]
    want = brute_components(ids, prints)
    got = {r.doc_id: r for r in near_dedup(docs(spark, texts)).collect()}
    assert {i: got[i].fingerprint for i in ids} == {i: f"{p:016x}" for i, p in zip(ids, prints)}
    assert {i: got[i].component_id for i in ids} == want
    assert near_dedup(docs(spark, [])).count() == 0


@pytest.mark.parametrize(("distance", "bucket"), [(2, 48), (2, 2), (0, 4), (1, 3), (3, 5), (6, 40)])
def test_links_of_any_distance_and_bucket(spark, distance, bucket):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(5)} | {0, 1, 3, (1 << 64) - 1}
    for p in list(prints):
        for _ in range(40):
            q = p
            for _ in range(rng.randrange(1, distance + 3)):
                q ^= 1 << rng.randrange(64)
            prints.add(q)
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance}
    got = links(spark.createDataFrame([(p,) for p in signed], "fp long"), distance, bucket).distinct().collect()
    assert {tuple(r) for r in got} == want
    assert links(spark.createDataFrame([], "fp long"), distance, bucket).count() == 0


def test_a_close_pair_always_shares_two_blocks():
    from pagegrid.llm.simhash import split

    rng = random.Random(6)
    for distance in (1, 2, 5):
        masks = [0]
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for _ in range(distance):
                b ^= 1 << rng.randrange(64)
            masks = [0]
            while max(64 - m.bit_count() for m in masks) >= distance + 2:
                masks = [x for m in masks for x in split(m, distance) if not (a ^ b) & x][:1]
                assert masks


def brute_near_copies(texts, least=0.8):
    """The smallest index reachable, by the similarity of all pairs; and how many pairs are similar."""
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]
    label = list(range(len(sets)))
    for _ in label:
        for i, j in linked:
            label[i] = label[j] = min(label[i], label[j])
    return label, len(linked)


@pytest.mark.parametrize("bucket", [8, 2])
def test_near_copies_of_similarity(spark, bucket):
    rng = random.Random(7)
    texts = [None, "", " \n", "A b", "a B", "one", "ü" * 50_000]
    for size, copies in ((150, 60), (40, 20), (12, 10), (900, 8)):
        base = spoken(rng, size, 3000).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(1 + size // 25)):
                w[rng.randrange(size)] = f"other{rng.randrange(10_000)}"
            texts.append(" ".join(w))
    want, links_ = brute_near_copies(texts)
    assert links_ > 100 and len(set(want)) > 30
    got = {r.doc_id: r.component_id for r in near_copies(docs(spark, texts), bucket=bucket).collect()}
    assert got == dict(enumerate(want))


def test_near_copies_link_by_fingerprint(spark, monkeypatch):
    from pagegrid.llm import near_copies as module

    rng = random.Random(12)
    long = [f"w{rng.randrange(10_000)}" for _ in range(600)]
    texts = [" ".join(long), " ".join(long + ["end"]), " ".join(f"v{i}" for i in range(50)), "", " "]
    # Bands that never agree leave only the fingerprints to bring two texts together.
    monkeypatch.setattr(module, "band_keys", lambda h, count: rng_keys(len(count)))
    rng_keys = lambda n: np.random.default_rng().integers(1 << 63, size=(n, module.BANDS)).astype(np.uint64)
    found = near_copies(docs(spark, texts))
    got = [r.component_id for r in found.orderBy("doc_id").collect()]
    assert got == [0, 0, 2, 3, 3]


def test_near_copies_go(spark):
    rng = random.Random(7)
    base = spoken(rng, 200, 3000).split()
    far = [*base[:100], *spoken(rng, 100, 3000).split()]
    texts = [" ".join(base), " ".join([*base[:99], "x", *base[100:150], "y", *base[151:]]), " ".join(far), " ".join(base).upper()]
    table = docs(spark, texts, 10)
    kept = drop_near_copies(table)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [10, 12]
    assert drop_near_copies(table.limit(0)).count() == 0


def test_decontamination(spark):
    rng = random.Random(1)
    items = [spoken(rng, n, 400) for n in (30, 12, 60)] + ["short one", "", None, "... !!"]
    near = items[0].split()
    near[0] = near[-1] = "other"
    far = items[2].split()
    far[20] = far[30] = far[40] = "other"
    texts = [spoken(rng, 5000, 400) + " " + items[0].upper() + ". " + spoken(rng, 100, 400), " ".join(near), " ".join(far), None, "", "a Short, ONE b", items[1], items[1][:-3], "x" * 200_000]

    def shingles(t, k):
        w = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").lower())
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}, len(w)

    want = set()
    for j, item in enumerate(items):
        n = shingles(item, 1)[1]
        if n:
            own = shingles(item, min(5, n))[0]
            for i, t in enumerate(texts):
                m = len(own & shingles(t, min(5, n))[0])
                if m >= 0.8 * len(own):
                    want.add((i, j, len(own), m))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(0, 0), (1, 0), (5, 3), (6, 1)} <= {x[:2] for x in want}
    for limit in (1 << 20, 200):  # in one block of items, and in several
        got = contained_items(docs(spark, texts), bench, block_bytes=limit)
        assert {tuple(r)[:4] for r in got.collect()} == want
    clean = drop_contaminated(docs(spark, texts), bench)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(range(len(texts))) - {x[0] for x in want})
    assert contained_items(docs(spark, texts), bench.limit(0)).count() == 0 == contained_items(docs(spark, []), bench).count()


def brute_passages(texts, size):
    w = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for t in texts]
    seen = Counter(tuple(x[i : i + size]) for x in w for i in range(len(x) - size + 1))
    out = set()
    for d, x in enumerate(w):
        inside = set()
        for i in range(len(x) - size + 1):
            if seen[tuple(x[i : i + size])] > 1:
                inside.update(range(i, i + size))
        starts = [i for i in range(len(x) - size + 1) if seen[tuple(x[i : i + size])] > 1]
        spans = []
        for i in starts:
            if spans and i <= spans[-1][1]:
                spans[-1][1] = i + size
            else:
                spans.append([i, i + size])
        out |= {(d, a, b) for a, b in spans}
    return out


def test_repeated_passages(spark):
    rng = random.Random(9)
    common = spoken(rng, 90, 3000)
    texts = [None, "", "a b", common, "la " * 150]
    for n in range(14):
        part = common.split()[rng.randrange(30) : rng.randrange(50, 90)]
        if n % 3 == 0:
            part[len(part) // 2] = "changed"
        texts.append(" ".join([spoken(rng, rng.randrange(80), 3000), *part, spoken(rng, rng.randrange(80), 3000)]))
    texts.append(texts[6] + "\n" + texts[6])
    for size, spread in ((50, 16), (12, 4)):
        got = repeated_passages(docs(spark, texts), min_words=size, spread=spread).collect()
        assert {(r.doc_id, r.start_word, r.end_word) for r in got} == brute_passages(texts, size)
        for r in got:
            raw = (texts[r.doc_id] or "").encode()[r.start_byte : r.end_byte].split()
            assert len(raw) == r.end_word - r.start_word
    assert repeated_passages(docs(spark, [])).count() == 0


def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_word_ids_are_the_librarys():
    own = WordBpe(vocabulary())
    rng = random.Random(2)
    letters = "abAB'srvl 12½µªßÀé.,!-—“” \t\n|%"
    odd = ["it's Don'T x's", "<|endoftext|> a", "á b İ Σ\u00a0x\u0085y", "\x1c a \x7f", "日本 😀", "", " "]
    for t in odd + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(500)]:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == own.library.encode(t, add_special_tokens=False).ids


def test_fill_is_the_best_sum():
    rng = random.Random(4)
    for _ in range(200):
        counts = Counter(rng.randrange(1, 12) for _ in range(rng.randrange(1, 8)))
        room = rng.randrange(1, 40)
        sums = {0}
        for n in counts.elements():
            sums |= {s + n for s in sums if s + n <= room}
        taken = fill(counts, room)
        assert all(c <= counts[n] for n, c in taken.items())
        assert sum(n * c for n, c in taken.items()) == max(sums)


def test_pack(spark):
    rng = random.Random(6)
    texts = [None, "", "  ", spoken(rng, 9000)] + [spoken(rng, rng.randrange(1, 900)) for _ in range(60)]
    library = WordBpe(vocabulary()).library
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    got = pack(docs(spark, texts), vocabulary()).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, own in ids.items():
        at = 0
        for start, n in sorted(pieces[i]):
            assert start == at
            at += n
        assert at == len(own)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096 and at & (at - 1) == 0  # no padding at all
    assert pack(docs(spark, []), vocabulary()).count() == 0


def labelled(rng, n):
    out = []
    for i in range(n):
        lang = ("aa", "bb")[i % 2]
        out.append((i, " ".join("".join(rng.choice("abcde" if lang == "aa" else "vwxyz") for _ in range(5)) for _ in range(rng.randrange(3, 300))), lang))
    return out


def test_language(spark):
    rows = labelled(random.Random(8), 150)
    more = [(1000, None, "aa"), (1001, "12 !", None), (1002, "", "bb"), (1003, "abcde " * 30_000, None), (None, "abc", "aa")]
    table = spark.createDataFrame(rows + more, "doc_id long, text string, lang string").repartition(3)
    model = language.fit(table)
    got = {r.doc_id: r for r in language.identify(table, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert np.mean([got[i].lang_pred == lang for i, _, lang in held]) > 0.95
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "aa"]
    kept = {r.doc_id for r in language.keep_known(table, model).collect()}
    assert not kept & {1000, 1001, 1002} and len(kept) > 140
    none = language.fit(table.where("doc_id is null"))
    assert {r.lang_pred for r in language.identify(table, none).collect()} == {"und"}
    assert language.identify(table.limit(0), model).count() == 0


def test_all_languages_are_learnt(spark):
    rows = [(i, " ".join(chr(0x4E00 + 40 * k + (i + j) % 40) for j in range(60)), f"l{k:02}") for k in range(70) for i in range(6 * k, 6 * k + 6 + k % 2)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(table, held=99)
    assert model.languages == sorted({lang for *_, lang in rows}) and model.net.p["out"].shape == (70,)


def test_quality(spark):
    rows = labelled(random.Random(8), 200)
    table = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, None), (1001, "")], "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([(i, int(lang == "aa")) for i, _, lang in rows] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.score(table, quality.fit(table, marks)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (lang == "aa") for i, _, lang in held]) > 0.95
    assert all(0 <= x <= 1 for x in got.values()) and got[1000] == pytest.approx(got[1001], abs=1e-4)
    assert quality.fit(table, marks.limit(0)).prior == 0.5


def test_token_counts(spark, tmp_path):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.tiktoken")
    texts = ["a b c", None, "", "  ", "längere Texte " * 500, "a b c"]
    table = spark.createDataFrame([(i, t, "s" if i % 2 else None, "en") for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string")
    counted = token_counts.count_tokens(table, path, "v1")
    own = token_counts.encoding(path)
    n = [len(own.encode_ordinary(t or "")) for t in texts]
    assert [r.tokens for r in counted.orderBy("id").collect()] == n
    rollup = token_counts.Rollup(spark, f"file://{tmp_path}/r")
    assert rollup.totals().count() == 0
    assert rollup.commit("one", token_counts.inserts(counted)) and not rollup.commit("one", token_counts.inserts(counted))
    rollup.commit("two", token_counts.deletes(counted.where("id = 0")))
    rollup.commit("three", token_counts.revisions(counted.where("id = 4"), F.col("tokens") * 2))
    got = {r.source: (r.documents, r.tokens) for r in rollup.totals().collect()}
    assert got == {None: (2, n[2] + 2 * n[4]), "s": (3, n[1] + n[3] + n[5])}
    rollup.commit("four", token_counts.deletes(counted.where("source = 's'")))
    assert [r.source for r in rollup.totals().collect()] == [None]


def test_token_totals_are_those_of_the_whole_table(spark, tmp_path):
    from pagegrid.llm.queries import QUERIES

    own = token_counts.encoding(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.tiktoken"))
    texts = ["a b c", None, "", "  ", "längere Texte " * 50, "a b c"]
    table = spark.createDataFrame([(i, t, "s" if i % 2 else None, "en") for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string")
    table.write.parquet(f"file://{tmp_path}/documents.parquet")
    want = {s: (3, sum(len(own.encode_ordinary(t or "")) for t in texts[k::2])) for k, s in enumerate([None, "s"])}
    got = QUERIES["op6_token_counts"](spark, f"file://{tmp_path}").collect()
    assert {r.source: (r.documents, r.tokens) for r in got} == want


@pytest.mark.parametrize("least", [0, 4])
def test_warc_round_trip(spark, least):
    html = ["<p>a</p>", "<p>a</p>", None, "", "abc", "abc", "é" * 70_000]
    table = spark.createDataFrame([(i, f"http://x/{i}\r\n" if i else None, t) for i, t in enumerate(html)], "page_id long, url string, html string").repartition(3)
    got = {r.page_id: tuple(r)[1:] for r in warc.round_trip(table, least=least).collect()}
    for i, t in enumerate(html):
        b = (t or "").encode()
        first = min(j for j, u in enumerate(html) if (u or "") == (t or ""))
        again = first != i and len(b) >= least
        assert got[i] == (len(b), warc.digest(b), "revisit" if again else "response", first if again else None)
    assert warc.round_trip(table.limit(0)).count() == 0


def test_zip_directories(tmp_path):
    import zipfile

    for n, wide in ((3, False), (70_000, True)):  # more members than the old directory can count
        path = tmp_path / f"{n}.zip"
        with zipfile.ZipFile(path, "w") as z:
            z.comment = b"a comment with PK\5\6 inside"
            for i in range(n):
                with z.open(zipfile.ZipInfo(f"m{i}"), "w", force_zip64=wide) as f:
                    f.write(b"x%d" % i)
        data = path.read_bytes()
        package = warc.ZipPackage(lambda at, k, data=data: data[at : at + k], len(data))
        assert len(package.members) == n
        at, k = package.place(f"m{n - 1}")
        assert data[at : at + k] == b"x%d" % (n - 1)


def test_url_filter_against_brute_force(spark):
    rng = random.Random(11)
    hosts = [f"h{i}.example" for i in range(12)]
    links_ = {h: rng.sample(hosts, rng.randrange(4)) for h in hosts}
    pages = [(i, f"https://{h.upper()}/p{i}?q#f", "".join(f'<a href="http://{x}/y">' for x in links_[h])) for i, h in enumerate(hosts)]
    pages += [(100, None, None), (101, "nothing", "<a href='//h1.example'>"), (102, "x://h1.example", ""), (102, "x://h1.example", "")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    rules = [Rule("allow", "h1.example", "/p"), Rule("block", "h2.example", "/"), Rule("block", "h3.example", "/p")]
    got = judge(table, rules, tolerance=1e-4).collect()
    edges = {(a, b) for a in hosts for b in links_[a] if a != b}

    def rank(edges, seeds):
        n = {h: sum(a == h for a, _ in edges) for h in hosts}
        x = dict(seeds)
        for _ in range(300):
            lost = sum(x[h] for h in hosts if not n[h])
            x = {h: 0.15 * seeds[h] + 0.85 * (lost * seeds[h] + sum(x[a] / n[a] for a, b in edges if b == h)) for h in hosts}
        return x

    trust = rank(edges, {h: float(h == "h1.example") for h in hosts})
    distrust = rank({(b, a) for a, b in edges}, {h: 0.5 * (h in ("h2.example", "h3.example")) for h in hosts})
    for r in got:
        if r.page_id < 100:
            assert r.trust == pytest.approx(trust[r.host], abs=1e-3) and r.distrust == pytest.approx(distrust[r.host], abs=1e-3)
            if r.rule is None:
                assert r.verdict == ("block" if r.distrust > r.trust else "allow")
    by = defaultdict(list)
    for r in got:
        by[r.page_id].append((r.host, r.path, r.rule, r.verdict))
    assert by[1] == [("h1.example", "/p1", "h1.example/p", "allow")] and by[2] == [("h2.example", "/p2", "h2.example/", "block")]
    assert by[100] == by[101] == [("", "", None, "allow")] and len(by[102]) == 2
    assert judge(table.limit(0), rules).count() == 0


def test_pipeline_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(8)
    rows = [(i, t, lang, "s", len(t)) for i, t, lang in labelled(rng, 120)]
    rows += [(200, rows[0][1], "aa", "s", 1), (201, None, None, None, None), (202, "!!", "aa", "s", 2), (203, rows[5][1] + " " + rows[1][1], "bb", "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, rows[1][1])], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    at = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, f"file://{tmp_path}")
        assert out.columns == at.columns, name
        out.write.parquet(f"file://{tmp_path}/{name}")
        at = spark.read.parquet(f"file://{tmp_path}/{name}")
    left = {r.doc_id for r in at.collect()}
    assert not left & {1, 200, 201, 202, 203} and len(left) > 100
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"file://{tmp_path}").collect()} == left


def test_training_takes_whole_texts(spark, monkeypatch):
    texts = ["a" * 40_000 + "z", "b" * 20_000, "c"]
    table = spark.createDataFrame([(i, t, "xy"[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(3)], "doc_id long, quality int")
    seen = []
    for module, name in ((language, "train_windows"), (quality, "train_documents")):
        train = getattr(module, name)
        monkeypatch.setattr(module, name, lambda got, *a, train=train: (seen.append(sorted(got)), train(got, *a))[1])
    language.fit(table, held=99)
    quality.fit(table, marks, held=99)
    assert seen == [[t.encode() for t in texts]] * 2


def test_filters_start_at_every_byte():
    from pagegrid.llm.cnn import Network, Shape

    net = Network(Shape(), 1, Shape().channels)
    texts = [bytes(n) + b"abcdefgh" + bytes(504 - n) for n in (100, 101)]
    even, odd = net.pooled(np.stack([np.frombuffer(t, np.uint8) for t in texts]))
    assert even == pytest.approx(odd, abs=1e-5)


def test_blocks_read_slices_and_nulls():
    from pagegrid.llm.textwords import blocks

    column = pa.array(["zero", None, "", "é b", "x" * 50]).slice(1)
    got = [b.text(i).decode() for b in blocks(column, 10) for i in range(len(b))]
    assert got == ["", "", "é b", "x" * 50]
