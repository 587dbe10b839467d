"""Operators on texts against brute force on small tables with every odd row."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from diagarc.llm import html_main, jaccard, langid, mixing, packing, queries, repeats, secrets, sketches, token_counts, topk
from diagarc.llm.components import components

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACE = r"[^\x20\x09-\x0D]+"
ODD = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n\t", "en", "a", 3), (4, "one", "de", "b", 3), (5, "one", "de", "b", 3),
    (5, "one", "de", "b", 3), (None, "two words", "en", None, 9), (7, "x" * 50_000, "en", "a", 50_000), (8, "two  words ! 1", "fr", "c", 13),
    (9, "the quick brown fox " * 200, "en", "a", 4000), (10, "token = \"abc-def-123\" AKIA" + "A1" * 9 + " " + "0af" * 9, "en", "b", 60),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, very long and repeated rows; and further columns with names that operators use themselves."""
    rows = spark.createDataFrame(ODD, DOCS)
    for name in ("size", "rank", "k", "d", "th", "node", "key", "label", "begin", "words", "score", "hash", "length"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def in_any_order(rows):
    return sorted(map(tuple, rows), key=str)


# Main text.

PAGE = """<!DOCTYPE html><head><title>t</title><style>p{}</style></head><body class="home"><header>top</header>
<div class="with-sidebar"><nav><ul><li>menu</ul></nav><article class="post"><header><h1>Title &amp; more</h1></header><p>one
 <b>two</b>&nbsp;3<p>four<script>var a="</p>";</script><br>five<form>f</form><div class="ad">buy</div>
<section id="comments"><article class="comment">mine</article></section></article></div><footer>end</footer>"""


def test_main_text(spark):
    pages = [(1, "http://a.example/1", PAGE), (2, None, None), (None, "http://a.example/2", ""), (1, "http://a.example/1", PAGE), (4, "x", "just < text"),
             (5, "http://a.example/5", "<p>" + "long " * 50_000 + "</p><!-- cut")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("host", F.lit(1)).withColumn("row", F.lit(1))
    got = in_any_order((r.page_id, r.text, r.n_chars) for r in html_main.main_text(df).collect())
    text = "Title & more\none two 3\nfour\nfive"
    long = ("long " * 50_000).strip()
    assert got == in_any_order([(1, text, len(text)), (1, text, len(text)), (2, "", 0), (None, "", 0), (4, "just < text", 11), (5, long, len(long))])


def test_template_goes(spark):
    box = "<div class='x'><p>Same box on all pages</p></div>"
    pages = [(i, f"http://h.example/{i}", f"<body>{box}<div><p>Own text {i}</p></div><p>Shared paragraph</p></body>") for i in range(5)]
    pages += [(9, "http://other.example/", f"<body>{box}</body>")]
    got = {r.page_id: (r.text, r.n_template) for r in html_main.main_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert got == {i: (f"Own text {i}\nShared paragraph", 1) for i in range(5)} | {9: ("Same box on all pages", 0)}
    assert html_main.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


@pytest.mark.parametrize("unit", ["<div>t", "<b>t", "<ul><li>t", "<div><p>t</b>", "<table><tr><td>t", "<section><article>t", "<div>t</i></b>", "<p><b>t", "<dl><dt>t<dd>u"])
def test_deep_nesting_takes_linear_time(unit):
    """50,000 open elements and more."""
    import time

    begin = time.monotonic()
    blocks, hashes, tags, outer = html_main.parse(unit * 50_000)
    html_main.page_parts(blocks, hashes, tags, outer)
    assert time.monotonic() - begin < 30 and sum(b[0].count("t") for b in blocks) == 50_000


def main_texts(spark, pages):
    return {r.page_id: r.text for r in html_main.main_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}


@pytest.mark.parametrize("copies", [3, 1000])
def test_copies_keep_their_text(spark, copies):
    body = "<div id=content><h1>Head</h1><div class=entry><p>One of two parts</p></div><div class=entry><p>Two of the parts</p></div></div>"
    url = lambda i: f"http://h.example/a?page={i}#top"
    pages = [(i, url(i), f"<body>{body}</body>") for i in range(copies)]
    pages += [(10_000 + i, url(i), f"<body><article><div class=entry><p>Marked</p></div></article><div>of {i}</div></body>") for i in range(copies)]
    pages += [(20_000 + i, f"http://i.example/{i}", f"<body>{body}<div><p>Copy {i}</p></div></body>") for i in range(copies)]
    got, text = main_texts(spark, pages), "Head\nOne of two parts\nTwo of the parts"
    assert all(got[i] == text and got[10_000 + i] == "Marked" and got[20_000 + i] == f"{text}\nCopy {i}" for i in range(copies))


def test_shared_table_stays(spark):
    table, box = "<table><tr><td><div>Cell</div></table>", "<div class=x><p>Box</p></div>"
    pages = [(i, f"http://h.example/{i}", f"<body>{box}<article><p>Text {i}</p>{table}</article></body>") for i in range(4)]
    pages += [(10 + i, f"http://h.example/{i}", f"<body>{box}<div><p>Longer text {i}</p>{table}</div></body>") for i in range(4)]
    assert main_texts(spark, pages) == {i: f"Text {i}\nCell" for i in range(4)} | {10 + i: f"Longer text {i}\nCell" for i in range(4)}


def test_template_goes_on_hosts_of_any_size(spark):
    box = "<div class=x><p>Section box</p></div>"
    pages = [(i, f"http://h.example/{i}", f"<body>{box if i < 3 else ''}<div><p>A text of its own {i}</p></div></body>") for i in range(400)]
    assert main_texts(spark, pages) == {i: f"A text of its own {i}" for i in range(400)}


# Mixing.


def test_mix(odd, documents):
    for docs in (odd, documents):
        rows = docs.select("doc_id", "text", "source").collect()
        size = [len(re.findall(SPACE, r.text or "")) for r in rows]
        sources = sorted({r.source for r in rows if r.source is not None}) + [None] * any(r.source is None for r in rows)
        total = {s: sum(n for n, r in zip(size, rows) if r.source == s) for s in sources}
        weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
        target, open_, rest = {}, set(sources), 1.5 * sum(size)
        while True:
            share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
            above = {s for s in open_ if share[s] > 2 * total[s]}
            target |= {s: 2.0 * total[s] for s in above}
            rest -= sum(2.0 * total[s] for s in above)
            open_ -= above
            if not above or not open_:
                target |= {s: share[s] for s in open_}
                break
        got = mixing.mix(docs).collect()
        assert in_any_order((r.doc_id, r["size"]) for r in got) == in_any_order(zip((r.doc_id for r in rows), size))
        assert all(r.taken <= 2 * r["size"] for r in got)
        by_source = collections.Counter()
        for r in got:
            by_source[(r.source_size, round(r.target, 6))] += r.taken
        want = collections.Counter()
        for s in sources:
            want[(total[s], round(target[s], 6))] += target[s]
        assert by_source.keys() == want.keys() and all(abs(by_source[k] - want[k]) <= len(sources) for k in want)
        assert in_any_order(got) == in_any_order(mixing.mix(docs).collect())
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.mix(odd.filter("text is null")).first().taken == 0


def test_schedule_is_even(spark):
    sizes = spark.createDataFrame([(False, f"s{i}", 256 * n) for i, n in enumerate((500, 300, 100))], "s_null boolean, s string, size bigint")
    slots = mixing.slot_schedule(mixing.source_targets(sizes, weights=(1,), share=1.0, cap=1.0), 900).collect()
    order = [r.k for r in sorted(slots, key=lambda r: r.slot)]
    for n in (90, 270, 600):
        assert all(abs(order[:n].count(k) - n * share) < 6 for k, share in enumerate((5 / 9, 3 / 9, 1 / 9)))
    for k, need in enumerate((500, 300, 100)):
        own = sorted((r.slot, r["rank"]) for r in slots if r.k == k)
        assert [rank for _, rank in own] == list(range(need))


def test_points_alone_reach_every_target(spark):
    sizes = [1] * 40 + [256 * 5000] + [300] * 40 + [256 * 40 + 1] + [7]
    table = spark.createDataFrame([(False, f"s{i:03}", n) for i, n in enumerate(sizes)], "s_null boolean, s string, size bigint")
    need = [-(-n // 256) for n in sizes]
    slots = mixing.slot_schedule(mixing.source_targets(table, weights=(1,), share=2.0, cap=1.0), sum(need)).collect()
    assert collections.Counter(r.k for r in slots) == dict(enumerate(need)) and len({r.slot for r in slots}) == sum(need)
    for k, n in enumerate(need):
        assert sorted(r["rank"] for r in slots if r.k == k) == list(range(n))


def test_gaps_of_the_points():
    numbers = [2, 3]
    while numbers[-1] < 1_500_000:
        numbers.append(sum(numbers[-2:]))
    assert mixing.GRID - mixing.STEP < mixing.STEP and mixing.GRID < 1 << 31
    for n in sorted({n + d for n in numbers for d in (-1, 0, 1)} | set(range(1, 400))):
        points = np.sort(np.arange(n) * mixing.STEP % mixing.GRID)
        assert np.diff(points, append=mixing.GRID).max() * n < 1.95 * mixing.GRID


def test_slots_of_documents(documents):
    got = mixing.mix(documents, block=64).collect()
    assert all((r.n_slots > 0) == (r.taken > 0) == (r.first_slot is not None) for r in got)
    assert all(r.taken <= 64 * r.n_slots for r in got)


# Secrets.


def base(text):
    found = [(m.start(), 0, m.end()) for m in secrets.ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_findings():
    rng = random.Random(4)
    bits = ["token", "Secret", "passwd", "api_key", "APIKEY", " ", '"', "'", ":", "=", "AKIA", "ABCD1234", "deadbeef0123", "cafe", "x", "é", "İ", "K", "ſ", "\n", ".", "-", "zzzzzz"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 30)))
        assert secrets.base_spans(text)[0] == base(text), text


def test_secret_scan(odd, documents):
    network = secrets.fit(documents)
    held = secrets.generated(600, seed=99)
    p = network.probability([w for w, _ in held])
    truth = np.array([y for _, y in held])
    assert (p[truth == 1] >= network.threshold).mean() > 0.9 and (p[truth == 0] >= network.threshold).mean() < 0.05
    for docs in (odd, documents):
        found = {(r.doc_id, r.text): [(f.begin, f.kind, f.end) for f in r.findings] for r in secrets.scan(docs, network).collect()}
        assert len(found) == docs.select("doc_id", "text").distinct().count()
        assert all([f for f in spans if f[1] < 3] == base(text or "") for (_, text), spans in found.items())
    clean = {r.doc_id: r for r in secrets.redacted(odd, network).collect() if r.doc_id != 5}
    assert clean[10].text == "[secret]\" [secret] [secret]" and clean[10].n_chars == 27 and clean[1].text is None and clean[4].text == "one"
    assert secrets.scan(odd.limit(0), secrets.fit(odd.limit(0))).count() == 0


def test_every_candidate_is_scored(spark, documents):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    key = lambda n, alphabet=letters + "0123456789": "".join(rng.choice(alphabet) for _ in range(n))
    path = "/srv/content/pages/about/the/company/history/and/people/list/"
    keys = [("only letters", "", key(20, letters)) for _ in range(50)] + [("late", path, key(32)) for _ in range(50)]
    keys += [("beside hex", "0123456789abcdef01234567-", key(40)) for _ in range(50)]
    texts = [(i, f"we sent it to {ahead}{own} on monday") for i, (_, ahead, own) in enumerate(keys)]
    texts += [(1000, f"we sent it to {path} on monday"), (1001, "eine donaudampfschifffahrtsgesellschaft here")]
    network, found = secrets.fit(documents), collections.Counter()
    for r in secrets.scan(spark.createDataFrame(texts, "doc_id bigint, text string"), network).collect():
        end = r.text.index(" on monday") if r.doc_id < 1000 else 0
        assert r.doc_id < 1000 or not r.findings
        found[keys[r.doc_id][0] if r.doc_id < 1000 else ""] += any(f.kind == 3 and f.end == end for f in r.findings)
    assert all(found[k] >= 45 for k in ("only letters", "late", "beside hex")), found


# Language.


def test_language(spark, documents):
    model = langid.fit(documents)
    got = langid.label_documents(documents, model).withColumn("held", langid.held_out()).collect()
    held = [r for r in got if r.held]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(odd, documents):
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.label_documents(odd, langid.fit(documents)).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[9][0] == "en"
    empty = langid.label_documents(odd, langid.fit(odd.limit(0)))
    assert {r.lang_pred for r in empty.collect()} == {"und"} and langid.label_documents(odd.limit(0), langid.fit(odd)).count() == 0


def test_forward_backward_is_exact():
    rng = np.random.default_rng(2)
    scores, step = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    begins, sizes = np.array([0, 4, 5]), np.array([4, 1, 4])
    got, transitions = langid.posteriors(scores, begins, sizes, step, sums=False)
    expected = np.zeros((3, 3))
    for b, n in zip(begins, sizes):
        marginal, z = np.zeros((n, 3)), 0
        for path in np.ndindex(*(3,) * n):
            p = np.exp(sum(scores[b + i, y] for i, y in enumerate(path)) + sum(step[x, y] for x, y in zip(path, path[1:])))
            z += p
            marginal[np.arange(n), path] += p
        for path in np.ndindex(*(3,) * n):
            p = np.exp(sum(scores[b + i, y] for i, y in enumerate(path)) + sum(step[x, y] for x, y in zip(path, path[1:]))) / z
            for x, y in zip(path, path[1:]):
                expected[x, y] += p
        assert np.allclose(got[b : b + n], marginal / z)
    assert np.allclose(transitions, expected)
    assert np.allclose(langid.posteriors(scores, begins, sizes, step)[0], got[:4].sum(0))


# Fingerprints.


def test_edited_texts(odd, documents):
    for docs in (documents, odd.filter("doc_id is not null").dropDuplicates(["doc_id"]), odd.filter("doc_id = 9")):
        rows = sorted((d, t or "") for d, t in pairs(docs))
        want = {}
        for i, (d, text) in enumerate(rows):
            n, follower = len(text), rows[(i + 1) % len(rows)][1]
            want[d] = (n, hashlib.sha256((text[: n - n // 2] + follower[: n // 2]).encode()).hexdigest())
        got = {r.doc_id: r for r in sketches.edited_and_next(docs).collect()}
        assert {d: (r.n_chars, r.edited_sha256) for d, r in got.items()} == want
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
        assert all((got[a].fingerprint == got[b].fingerprint) == (s == t) or a == b for a, s in rows[:60] for b, t in rows[:60])
    assert sketches.edited_and_next(odd).count() == len(ODD) and sketches.edited_and_next(odd.limit(0)).count() == 0


def test_sketches_merge_and_contain():
    rng = random.Random(1)
    book = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    part, other, line = book[10_000:16_000], "".join(rng.choice("ijklmno ") for _ in range(6000)), book[20_000:20_200]
    whole = sketches.sketch(book)
    assert sketches.containment(sketches.sketch(part), whole) > 0.98 and sketches.containment(sketches.sketch(other), whole) < 0.02
    # Merged sketches are those of the shingles of both, with few or many of them.
    for a, b in ((part, other), (line, other), (line, book[20_100:20_300]), (line, line), ("", line), (line, book[30_000:30_200])):
        both, got = np.union1d(sketches.shingles(a), sketches.shingles(b)), sketches.merged(sketches.sketch(a), sketches.sketch(b))
        assert got.whole == (len(both) <= sketches.FEW) and set(got.hashes) == set(both if got.whole else both[both < np.uint64(2**64 // 32)])
    half = sketches.sketch(book[:30_000] + "".join(rng.choice("pqrstuv ") for _ in range(30_000)))
    assert abs(sketches.containment(half, whole) - 0.5) < 0.05


def test_short_texts_in_long_ones():
    """A line in the book that holds it, and one of which half is in it."""
    rng = random.Random(4)
    book = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    for n in (13, 40, 200):
        line = book[30_000 : 30_000 + n]
        near = lambda text: sketches.likeness(text, sketches.sketch(text), book, sketches.sketch(book))
        assert near(line) == 1.0 and near("".join(rng.choice("xyz") for _ in range(n))) == 0.0
        found = sketches.containment(sketches.sketch(line), sketches.sketch(book))
        assert found is None or found == 1.0
    half = book[1000:1100] + "".join(rng.choice("xyz") for _ in range(100))
    assert abs(sketches.likeness(half, sketches.sketch(half), book, sketches.sketch(book)) - 0.47) < 0.03


def test_near_against_all_shingles(documents):
    """What the query estimates lies near the share of all shingles, and equals it for short texts."""
    rows = sorted((d, t or "") for d, t in pairs(documents))
    got = {r.doc_id: r for r in sketches.edited_and_next(documents).collect()}
    for i, (d, text) in enumerate(rows):
        a, b = sketches.shingles(text), sketches.shingles(rows[(i + 1) % len(rows)][1])
        want = len(np.intersect1d(a, b)) / min(len(a), len(b)) if len(a) and len(b) else float(len(a) == len(b))
        assert abs(got[d].near_next - want) < (1e-9 if min(len(a), len(b)) <= sketches.FEW else 0.35)


# Packing.


def test_pack(odd, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for docs in (odd, documents):
        want = []
        for d, text in pairs(docs):
            ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
            cuts = [0, *range(len(ids) % 1024 or min(1024, len(ids)), len(ids) + 1, 1024)]
            want += [(d, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        got = packing.pack(docs).collect()
        assert in_any_order(r[:5] for r in got) == in_any_order(want)
        full = collections.defaultdict(list)
        for r in got:
            full[r.sequence_id].append((r.offset, r.length))
        for places in full.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 1024
        assert len(full) <= 1.02 * sum(r.length for r in got) / 1024 + 1
    assert packing.pack(odd.limit(0)).count() == 0


def test_encoder_equals_tokenizer(documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, own = Tokenizer.from_file(path), packing.Encoder(open(path, encoding="utf-8").read(), public_tokenizers.PATTERN)
    rng = random.Random(1)
    texts = ["".join(rng.choice(" \n\t\x1c\x85\xa0ab1!'é　s") for _ in range(40)) for _ in range(1500)]
    texts += ["", "a <|endoftext|> b", "  a  b ", *(t for _, t in pairs(documents))]
    for text in texts:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_plan_is_best_fit():
    rng = random.Random(3)
    for _ in range(60):
        capacity = rng.choice([7, 20, 50])
        counts = {n: rng.randint(1, 9) for n in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))}
        bins = []
        for n in sorted(counts, reverse=True):
            for _ in range(counts[n]):
                fitting = [i for i, free in enumerate(bins) if free >= n]
                if fitting:
                    bins[min(fitting, key=lambda i: bins[i])] -= n
                else:
                    bins.append(capacity - n)
        places = collections.defaultdict(list)
        for n, ranges in packing.plan(counts, capacity).items():
            assert [r[0] for r in ranges] == [0, *(r[1] for r in ranges)][: len(ranges)] and ranges[-1][1] == counts[n]
            for first, end, sequence, each, at in ranges:
                for i in range(end - first):
                    places[sequence + i // each].append((at + i % each * n, n))
        for own in places.values():
            assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))]
        assert len(places) == len(bins) and max(sum(n for _, n in own) for own in places.values()) <= capacity


# Top k.


def test_top_k(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = vectors.collect()
    v = {r.vec_id: np.floor(np.array(r.embedding, float) * 256).astype(int) for r in rows}
    want = []
    for q in sorted(i for i in v if i % 50 == 0):
        best = sorted((-int(v[q] @ v[i]), i) for i in v if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert in_any_order(topk.top_k(vectors).collect()) == in_any_order(want)
    assert in_any_order(topk.top_k(vectors, n_pivots=4, block_rows=40, query_rows=3, step=5).collect()) == in_any_order(want)


def test_pivots_exclude_most_candidates(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 64))
    rows = centres[rng.integers(0, 20, 3000)] + 0.2 * rng.normal(size=(3000, 64))
    rows[7], rows[8], rows[100], rows[9] = 0, rows[50], rows[150], rows[150] * 1000
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id bigint, embedding array<double>")
    whole = np.floor(rows * 256).astype(np.int64)
    got = topk.top_k(vectors, counts=True).collect()
    for query in range(0, 3000, 50):
        scores = whole @ whole[query]
        want = sorted((i for i in range(3000) if i != query), key=lambda i: (-scores[i], i))[:5]
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == query] == [(i, scores[i]) for i in want]
    shares = [r.evaluated / 2999 for r in got if r["rank"] == 1]
    assert np.median(shares) < 0.1 and max(shares) < 1


def test_top_k_of_huge_and_small_numbers(spark):
    rows = [(0, [1e200, 1.0]), (1, [1e200, 2.0]), (2, [-1e200, 0.0]), (3, [1e-3, 0.0]), (4, [0.0, 5.0]), (50, [0.0, 1.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), k=2).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0] == [1, 4]
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 50] == [(4, 5 << 16), (1, 2 << 16)]


def test_top_k_odd_rows(spark):
    rows = [(100, [1e20, 2.0]), (50, [0.5, 0.5, 0.5]), (7, None), (8, [float("nan")]), (9, [None]), (None, [0.5]), (3, [0.5]), (3, [0.5]), (4, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x")).withColumn("block", F.lit(1))
    assert in_any_order(topk.top_k(df).collect()) == in_any_order([
        (50, 1, 100, 2**63 - 1), (50, 2, 3, 16384), (50, 3, 3, 16384), (50, 4, None, 16384), (50, 5, 4, 0),
        (100, 1, 3, 2**63 - 1), (100, 2, 3, 2**63 - 1), (100, 3, 50, 2**63 - 1), (100, 4, None, 2**63 - 1), (100, 5, 4, 0)])
    assert topk.top_k(df.limit(0)).count() == 0


# Repeated passages.


def without_windows(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i : i + width] for b in texts for i in range(len(b) - width + 1))
    out = []
    for (d, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return in_any_order(out)


def repeats_of(df, **how):
    return in_any_order((r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in repeats.without_repeats(df, **how).collect())


def test_repeats(spark, odd, documents):
    rng = random.Random(5)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randint(20, 300))) for _ in range(6)]
    rows = []
    for i in range(40):
        text = ""
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.6:
                p = rng.choice(pool)
                at = rng.randint(0, len(p) - 1)
                text += p[at : at + rng.randint(10, 300)]
            else:
                text += "".join(rng.choice("xyzw") for _ in range(rng.randint(1, 120)))
        rows.append((i, text))
    rows += [(3, rows[3][1]), (None, rows[5][1]), (None, None), (99, ""), (100, "a" * 500), (101, "ab" * 200), (102, "a" * 119), (102, "a" * 119)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert repeats_of(df, width=120, anchor=16) == without_windows(rows, 120)
    assert repeats_of(documents) == without_windows(pairs(documents), 400)
    kept = {(d, n): len(k) for d, n, _, k in repeats_of(odd)}
    assert kept[(7, 50_000)] == 0 and kept[(4, 3)] == 3 and repeats.without_repeats(odd.limit(0)).count() == 0


# Jaccard groups.


def alike(rows, width=4, least=85):
    """(id, set size, smallest id of the group) by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 100 * len(s & sets[j]) >= least * len(s | sets[j]):
                group[top(i)] = top(j)
    members = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        members[top(i)].append(d)
    return in_any_order((d, len(s), min((x for x in members[top(i)] if x is not None), default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("small, block", [(512, 2048), (4, 3)])
def test_jaccard_groups(spark, monkeypatch, small, block):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "LEAST_BLOCK", min(block, 64))
    monkeypatch.setattr(jaccard, "MOST_BLOCK", block)
    rng = random.Random(3)
    words, rows = [f"w{i}" for i in range(60)], []
    for _ in range(20):
        text = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 12)):
            own = list(text)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), "  ".join(own).upper() if rng.random() < 0.2 else " ".join(own)))
    rows += [(5, rows[7][1]), (None, rows[9][1]), (None, "q"), (None, None), (400, ""), (401, " \n"), (402, "A b"), (403, "a B"), (404, "a b"), (404, "zz")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit("x")).withColumn("n", F.lit("x"))
    assert in_any_order(r[:3] for r in jaccard.alike_groups(df).collect()) == alike(rows)


def test_jaccard_of_documents(documents, odd):
    assert in_any_order(r[:3] for r in jaccard.alike_groups(documents).collect()) == alike(pairs(documents))
    assert in_any_order(r[:3] for r in jaccard.alike_groups(odd).collect()) == alike(pairs(odd)) and jaccard.alike_groups(odd.limit(0)).count() == 0


@pytest.mark.parametrize("least", [60, 80, 85, 95])
def test_alike_sets_share_a_part(least):
    """Sets at the threshold share a key, however small and whatever parts stay empty; sets with half in common hardly ever do."""
    draw = np.random.default_rng(least)
    for _ in range(3000):
        a = np.unique(draw.integers(0, 2**64, int(draw.integers(1, draw.choice([4, 20, 300]))), np.uint64))
        gone = int(draw.integers(0, len(a)))
        b = np.unique(np.append(a[gone:], draw.integers(0, 2**64, int(draw.integers(0, 1 + max(0, 100 * (len(a) - gone) // least - len(a)))), np.uint64)))
        union = len(np.union1d(a, b))
        if 100 * len(np.intersect1d(a, b)) >= least * union and len(a) != len(np.intersect1d(a, b)):
            assert abs(jaccard.band_of(len(a), least) - jaccard.band_of(len(b), least)) <= 1
            assert len(np.intersect1d(jaccard.part_keys(a, least), jaccard.part_keys(b, least)))
    shared = 0
    for _ in range(100):
        both, own, other = (draw.integers(0, 2**64, 200, np.uint64) for _ in range(3))
        shared += bool(len(np.intersect1d(jaccard.part_keys(np.unique(np.append(both, own)), 85), jaccard.part_keys(np.unique(np.append(both, other)), 85))))
    assert shared < 100


def test_hub_edges_hold_keys_once(spark):
    """A node leads to the smallest with a key of its own; the keys are dealt and sorted once, in no hash table and no join."""
    rows = [(b"a", 5, [1, 2]), (b"b", 3, [2, 9]), (b"b", 8, [2, 9]), (b"c", 4, [9, 2]), (b"d", 1, [7]), (b"e", 2, []), (b"f", 6, None)]
    edges = jaccard._hub_edges(spark.createDataFrame(rows, "set binary, sid bigint, keys array<bigint>"))
    assert sorted(map(tuple, edges.collect())) == [(4, 3), (5, 3)]
    plan = edges._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and not re.search(r"Aggregate\(keys=\[key", plan)


def test_alike_texts_of_many_slices(spark):
    """A batch whose texts together are longer than what is held at once."""
    texts = [" ".join(f"{k}w{i}" for i in range(60_000)) for k in (0, 1, 0, 2, 1)]
    rows = [*enumerate([*texts, None, "", texts[3] + " more"])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.alike_groups(df).collect()}
    assert got == {0: (59_997, 0), 1: (59_997, 1), 2: (59_997, 0), 3: (59_997, 3), 4: (59_997, 1), 5: (0, 5), 6: (0, 6), 7: (59_998, 3)}


def test_common_lines_make_no_candidates(spark, monkeypatch):
    """Texts that share a few common lines are no candidates of each other, however many there are; near copies among them are."""
    rng, rows = random.Random(11), []
    lines = [" ".join(f"l{k}x{i}" for i in range(8)) for k in range(4)]
    for i in range(1500):
        words = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        for line in rng.sample(lines, 2):
            words.insert(rng.randrange(len(words)), line)
        rows.append((i, " ".join(words)))
    for i in range(12):
        words = rows[i * 50][1].split(" ")
        words[i * 7] = "other"
        rows.append((2000 + i, " ".join(words)))
    found, groups = [], jaccard._candidate_groups
    monkeypatch.setattr(jaccard, "_candidate_groups", lambda sets: found.append(groups(sets)) or found[0])
    got = {r.doc_id: r.component_id for r in jaccard.alike_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: i for i in range(1500)} | {2000 + i: i * 50 for i in range(12)}
    assert 24 <= found[0].count() <= 40


def test_alike_sets_need_a_key_in_common():
    """Whatever else is frequent, sets that are alike keep a key in common when each drops the most frequent ones that it can do without."""
    draw = np.random.default_rng(5)
    for least in (60, 80, 85, 95):
        for _ in range(600):
            a = np.unique(draw.integers(0, 2**64, int(draw.integers(1, draw.choice([20, 300]))), np.uint64))
            gone = int(draw.integers(0, 1 + len(a) * (100 - least) // 100))
            more = max(0, 100 * (len(a) - gone) // least - len(a))
            b = np.unique(np.append(a[gone:], draw.integers(0, 2**64, more, np.uint64)))
            if not len(b) or len(a) == len(b) == len(np.intersect1d(a, b)) or 100 * len(np.intersect1d(a, b)) < least * len(np.union1d(a, b)):
                continue
            times, needed = {}, []
            for own in (a, b):
                keys, spare = jaccard._part_keys(own, least)
                for odd in (0, 1):
                    mine = sorted((int(k) for k in keys if k & np.uint64(1) == odd), key=lambda k: (-times.setdefault(k, int(draw.integers(1, 9))), k))
                    needed.append(set(mine[spare[odd] :]))
            assert needed[0] & needed[2] or needed[1] & needed[3]


def test_keys_move_in_few_bytes(spark, monkeypatch):
    """Only keys of several sets leave the ranges, with their nodes, and copies of a set bring no keys."""
    monkeypatch.setattr(jaccard, "_KEYS_AT_ONCE", 300)
    monkeypatch.setattr(jaccard, "_CHARS_AT_ONCE", 2000)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a b c d e f g h", f"w{rng.randrange(10**6)}"]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts = [*texts, None, *texts[:30]]
    rows = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string").repartition(3)
    keyed = jaccard._sets(rows, 4, 80, 5).localCheckpoint()
    sets = {r.sid: (bytes(r.set), r.n, r.base) for r in keyed.filter("bucket is null").collect()}
    assert len(sets) == 111 and all(0 <= sid - base < 1 << 16 for sid, (_, _, base) in sets.items())
    node = {s: min(sid for sid, x in sets.items() if x[0] == s) for s, n, _ in sets.values() if n}
    copies = spark.createDataFrame([(sid, base) for sid, (s, n, base) in sets.items() if n and node[s] != sid], "sid bigint, base bigint")
    blobs = jaccard._without_copies(keyed, copies).localCheckpoint()
    have = {}
    for text in texts:
        own = jaccard.shingle_set(text)
        if len(own):
            have.setdefault(node[jaccard._digest(own)], jaccard.part_keys(own, 80).view(np.int64).tolist())
    times = collections.Counter(k for keys in have.values() for k in keys)
    want = sorted((k, n, times[k]) for n, keys in have.items() for k in keys if times[k] > 1)
    assert want and sorted(map(tuple, jaccard._met_keys(blobs).collect())) == want
    assert sum(len(r["keys"]) + len(r["at"]) for r in blobs.collect()) == 8 * sum(map(len, have.values()))


def test_workers_let_go(documents):
    """What packing keeps in a worker is gone when a task of another operator runs there."""
    import pyarrow as pa

    from diagarc.llm.common import map_batches

    def held(batch):
        import gc

        n = sum(type(x).__name__ == "Encoder" for x in gc.get_objects())
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    rows = documents.select("doc_id", "text").repartition(8).localCheckpoint()
    assert packing.pieces(rows).count() >= rows.count()
    assert {r.n for r in map_batches(rows, held, "n bigint").collect()} == {0}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, x) for x in range(1001, 1100)] + [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(150)]
    group = {x: x for e in edges for x in e}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        group[max(top(a), top(b))] = min(top(a), top(b))
    got = {r.node: r.label for r in components(spark.createDataFrame(edges + [(7, 7)], "u bigint, v bigint")).collect()}
    assert got == {x: top(x) for a, b in edges if a != b for x in (a, b)}


# Token counts.


def test_token_counts(odd, documents):
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    pieces = token_counts.vocabulary()
    whole = Tokenizer(Unigram([("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256)), *pieces], 0, True))
    for docs in (odd.filter("doc_id <> 7"), documents):
        got = in_any_order((r.doc_id, r.n_tokens) for r in token_counts.token_counts(docs).collect())
        mark = lambda t: "▁" + t.replace(" ", "▁")
        assert got == in_any_order((d, len(whole.encode(mark(t), add_special_tokens=False).ids) if t else 0) for d, t in pairs(docs))
    assert token_counts.token_counts(odd.limit(0)).count() == 0


def test_models_alike_at_first(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "xyxy")], "doc_id bigint, text string").coalesce(1)
    first = [("▁", -1.0), *((chr(0x4E00 + i), -1.0) for i in range(60)), ("x", -1.0), ("y", -1.0)]
    for last, n in (("xy", 3), ("xyxy", 2), ("zz", 5)):
        monkeypatch.setattr(token_counts, "vocabulary", lambda model, last=last: [*first, (last, -1.0)])
        assert token_counts.token_counts(docs).first().n_tokens == n


def test_ties_and_bytes():
    own = token_counts.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abc", -3.0), ("c", -1.0), ("▁", -1.0)])
    assert own.word("abc") == (1, 0, -3.0)  # of equal paths the piece that starts earliest
    assert own.word("é") == (2, 2, -13.0) and own.word("aé日") == (6, 5, -27.0)
    assert own.text("ab  c") == (5, 0) and own.text("") == (0, 0)


# All queries.


def test_names():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 11)]


def test_sql(spark):
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import compare

    con = compare.duck(SMALL)
    for name, sql in queries.ORACLES.items():
        difference = compare.compare(queries.QUERIES[name](spark, SMALL), con, sql)
        assert difference is None, f"{name}: {difference}"


def test_later_queries_and_sql(spark):
    """The queries after the first ten are registered too, and match their SQL."""
    import os
    import sys

    sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))]
    import __spark_entry__
    import compare

    assert [name.split("_")[0] for name in __spark_entry__.queries() if name.startswith("op")] == [f"op{n}" for n in range(1, 14)]
    assert __spark_entry__.oracle_sql().keys() >= queries.LATER_ORACLES.keys()
    con = compare.duck(SMALL)
    for name, sql in queries.LATER_ORACLES.items():
        difference = compare.compare(queries.LATER_QUERIES[name](spark, SMALL), con, sql)
        assert difference is None, f"{name}: {difference}"
