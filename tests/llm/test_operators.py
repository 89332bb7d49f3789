"""Small cases of every operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from spellcast.llm import (  # noqa: E402
    bpe, chat_format, decontaminate, html_extract, license_scan, minhash_dedup, quality_classifier, quality_rules, queries,
    substring_dedup, url_filter,
)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RNG = random.Random(5)


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


PASSAGE = prose(60, 1)
BASE = prose(200, 2)
NEAR = " ".join(w if i % 60 else "changed" for i, w in enumerate(BASE.split()))
ROWS = [
    (1, BASE), (2, NEAR), (3, BASE), (4, None), (5, ""), (6, "two words"), (7, "two words"),
    (8, prose(40, 3) + " " + PASSAGE), (9, PASSAGE + " " + prose(30, 4)), (9, PASSAGE + " " + prose(30, 4)),
    (10, "spam " * 300), (11, " \n\t "), (12, prose(30000, 6)), (None, BASE),
]


@pytest.fixture(scope="module")
def docs(spark):
    # Columns named like those the operators add, to clash with them.
    rows = [(i, t, "en", None if i == 3 else f"s{(i or 0) % 2}", len(t or ""), 7, "x", "y") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words long, h string, comp string")


def words(text):
    return (text or "").encode().split()


def shingled(text):
    w = [x.lower() for x in words(text)]
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def test_substring_dedup(spark, docs):
    got = substring_dedup.remove_repeats(docs, carry=("lang", "comp")).select("doc_id", "n_words", "n_removed", "kept_text", "carried.comp").collect()
    want = []
    for i, t in ROWS:
        w = words(t)
        keep = [True] * len(w)
        key = lambda d: 2**63 - 1 if d is None else d
        earlier = {tuple(words(u)[j : j + 13]) for d, u in ROWS if key(d) < key(i) for j in range(len(words(u)) - 12)}
        for j in range(len(w) - 12):
            if tuple(w[j : j + 13]) in earlier:
                keep[j : j + 13] = [False] * 13
        left = b" ".join(x for x, k in zip(w, keep) if k).decode()
        want.append((i, len(w), keep.count(False), left, "y"))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_substring_dedup_of_repeated_rows_and_shared_ids(spark):
    """Passages that end earlier in a repeated row, in one of an id's texts, or in a row without id."""
    p, q = prose(30, 41).split(), prose(40, 42).split()
    short, other = " ".join(p[:20]), " ".join(p[5:])
    rows = [
        (1, " ".join(p)), (2, short), (2, short), (3, " ".join(p)), (4, " ".join(q)), (5, " ".join(q[:18])), (5, " ".join(prose(1, 43).split() + q[1:])),
        (6, prose(20, 44) + " " + prose(13, 45)), (6, prose(20, 46) + " " + prose(14, 47)), (7, prose(13, 45) + " tail"), (8, "head " + prose(14, 47)),
        (None, prose(3, 48) + " " + " ".join(q[:15])), (None, prose(3, 49) + " " + " ".join(q[:15])), (None, prose(3, 50) + " " + " ".join(q[:30])), (None, other),
    ]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_removed", "kept_text").collect()
    want = []
    key = lambda d: 2**63 - 1 if d is None else d
    for i, t in rows:
        w = words(t)
        keep = [True] * len(w)
        earlier = {tuple(words(u)[j : j + 13]) for d, u in rows if key(d) < key(i) for j in range(len(words(u)) - 12)}
        for j in range(len(w) - 12):
            if tuple(w[j : j + 13]) in earlier:
                keep[j : j + 13] = [False] * 13
        want.append((i, keep.count(False), b" ".join(x for x, k in zip(w, keep) if k).decode()))
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert [r[1] for r in want[1:3]] == [20, 20]


def test_minhash_dedup(spark, docs):
    got = {r.doc_id: r for r in minhash_dedup.components(docs).collect()}
    assert {i: got[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 9, 10: 10, 11: 11, 12: 12}
    assert all(got[i].n_shingles == len(shingled(t)) for i, t in ROWS)
    assert minhash_dedup.components(docs).count() == len(ROWS)
    assert [got[i].kept for i in (1, 2, 6, 7)] == [True, False, True, False]
    assert minhash_dedup.components(docs.limit(0)).count() == 0


def test_minhash_dedup_of_shared_and_missing_ids(spark):
    """Texts of one id are one document; rows without id are linked, searched and dropped like others."""
    one, other, third = prose(100, 21), prose(1000, 22), prose(80, 23)
    near = " ".join(one.split()[:-3])
    rows = [(1, one), (2, near), (2, other), (3, other), (2, ""), (None, one), (None, third), (None, third), (None, third + " more"), (None, ""), (None, None), (None, "x y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.components(frame).collect()), key=str)
    want = [(1, 96, 1, True), (2, 93, 1, False), (2, 996, 1, False), (3, 996, 1, False), (2, 0, 2, True), (None, 96, 1, False), (None, 0, None, True), (None, 0, None, True), (None, 1, None, True)]
    assert [g for g in got if g[1] not in (76, 77)] == sorted(want, key=str)
    loose = [g for g in got if g[1] in (76, 77)]
    assert sorted(g[1] for g in loose) == [76, 76, 77] and len({g[3] for g in loose if g[1] == 76}) == 1 and {g[3] for g in loose} == {True, False}
    kept = [tuple(r) for r in minhash_dedup.keep_one(frame).collect()]
    assert (1, one) in kept and len(kept) == 5 and not any(i in (2, 3) for i, _ in kept)  # a document goes with all its rows
    assert sum(t in (third, third + " more") for _, t in kept) == 1


def test_minhash_dedup_moves_candidates_only(spark):
    texts = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    nodes = spark.range(0, 5000, 10).select(F.col("id").alias("node"))
    passed = {r.doc_id for r in minhash_dedup._likely(texts, nodes).collect()}
    assert set(range(0, 5000, 10)) <= passed and len(passed) < 520
    shuffled = minhash_dedup._likely(texts, nodes)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in shuffled and "SortMergeJoin" not in shuffled


def test_minhash_dedup_chain_of_partial_links(spark):
    """A group where most pairs are below the limit: components must still be those of all pairs."""
    rng = random.Random(9)
    base = prose(150, 11).split()
    texts = []
    for i in range(60):
        w = list(base)
        for p in rng.sample(range(150), rng.randint(1, 9)):
            w[p] = f"w{i}x{p}"
        texts.append((i, " ".join(w)))
    sets = {i: shingled(t) for i, t in texts}
    parent = {i: i for i in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = minhash_dedup.components(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: root(i) for i in sets}


def test_decontamination(spark, docs):
    cut = " ".join(PASSAGE.split()[:52])
    items = spark.createDataFrame(
        [(1, PASSAGE.upper()), (2, None), (3, ""), (4, "two words"), (5, prose(20, 99)), (6, prose(300, 2)), (7, cut), (None, PASSAGE), (7, cut)],
        "item_id long, text string",
    )
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained(docs, items).collect()}
    want = {
        (d, i) for d, t in ROWS for i, u in [(1, PASSAGE), (4, "two words"), (5, prose(20, 99)), (6, prose(300, 2)), (7, cut), (None, PASSAGE)]
        if shingled(t) and 100 * len(shingled(t) & shingled(u)) >= 75 * len(shingled(u))
    }
    assert got == want and {(8, 1), (9, 1), (8, 7)} <= got
    assert decontaminate.clean(docs, items).columns == docs.columns
    assert decontaminate.contained(docs, items.limit(0)).count() == 0
    assert decontaminate.contained(docs.limit(0), items).count() == 0


def test_decontamination_without_ids_and_with_short_items(spark):
    item, other = prose(20, 61), prose(30, 62)
    items = spark.createDataFrame([(None, item), (2, other), (3, "just three words"), (4, ""), (5, None)], "item_id long, text string")
    rows = [(1, "x " + item), (None, prose(9, 63) + " " + other), (None, "clean text without any item"), (2, "Just  three WORDS"), (3, "these are just three words too"), (4, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_item) for r in decontaminate.contained(docs, items).collect()}
    assert got == {(1, None, 16), (None, 2, 26), (2, 3, 1)}
    left = sorted((tuple(r) for r in decontaminate.clean(docs, items).collect()), key=str)
    assert left == sorted([rows[2], rows[4], rows[5], rows[6]], key=str)


def test_decontamination_finds_short_items(spark):
    """Items of 1 to 8 shingles in many documents, whole and with the last shingles cut off."""
    texts = {n: prose(n, 500 + n).split() for n in range(5, 13)}
    items = [(n, " ".join(w)) for n, w in texts.items()]
    rows = []
    for i in range(400):
        for n, w in texts.items():
            cut = w[: 4 + -(-3 * (n - 4) // 4)] if i % 2 else w
            rows.append((len(rows), " ".join([prose(i % 37, i), *cut, prose(60, 1000 + i)])))
    got = decontaminate.contained(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(d, 5 + d % 8) for d in range(len(rows))]


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG/en/12?x", "http://example.org", "http://b.com/de/x", "http://b.com/fr/", "http://com/de/",
            "x://notexample.org/es/", "http://h.net/" + "a/" * 5000, "http://" + "l." * 3000 + "org/", "http://b.com/fr/", "http://q.org#/es/"]
    pages = spark.createDataFrame([(i % 12, u, "z", "z") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string")
    got = url_filter.judge(pages, url_filter.rule_table(spark))
    found = sorted((r.rule, r.verdict) for r in got.collect() if r.rule)
    assert found == [("com/de/", "block")] * 2 + [("com/fr/", "allow")] * 2 + [("example.org/en/1", "block")] + [("org/", "allow")] * 2
    assert got.count() == len(urls)
    tie = url_filter.rule_table(spark, [("allow", "org", "/"), ("block", "org", "/")])
    assert got.sparkSession is spark and {r.verdict for r in url_filter.judge(pages, tie).filter("rule is not null").collect()} == {"block"}
    assert {r.verdict for r in url_filter.judge(pages, tie.limit(0), default="block").collect()} == {"block"}
    assert url_filter.judge(pages.limit(0), tie).count() == 0


def test_quality_rules(spark, docs):
    got = quality_rules.apply_rules(docs).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got}
    for i, t in ROWS:
        w = words(t)
        seen = {}
        for j in range(len(w) - 7):
            seen.setdefault(tuple(w[j : j + 8]), []).append(j)
        covered = {j + k for at in seen.values() if len(at) > 1 for j in at for k in range(8)}
        assert (by_id[i].n_words, by_id[i].n_repeat_words) == (len(w), len(covered))
        assert by_id[i].base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
    assert quality_rules.apply_rules(docs.limit(0)).count() == 0


def test_quality_rules_drop_failing_hosts(spark):
    good = prose(50, 8)
    rows = [(i, "spam " * 100 if i % 10 else good, f"bad{i // 100}") for i in range(200)] + [(i, good, "fine") for i in range(1000, 1400)]
    kept = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).filter("kept").collect()
    assert {r.doc_id for r in kept} == set(range(1000, 1400))


def test_quality_classifier(spark):
    # Texts of independent words: 600 documents, a fifth toxic, a fifth shouting.
    rows = [(i, prose(60, i) + (" Trash idiot." if i % 5 == 0 else ""), "en", f"s{i % 3}", 7) for i in range(600)]
    rows = [(i, t.upper() if i % 5 == 1 else t, a, b, c) for i, t, a, b, c in rows] + [(600, None, None, None, 0), (601, "", None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long")
    labels = spark.createDataFrame([(i, int(i % 5 != 1), int(i % 5 == 0)) for i in range(0, 600, 2)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    out = quality_classifier.good(docs, labels)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.collect()}
    assert {i for i in kept if i < 600} == {i for i in range(600) if i % 5 > 1} and {600, 601} <= kept
    assert quality_classifier.good(docs, labels.limit(0)).count() == docs.count()
    assert quality_classifier.good(docs.limit(0), labels).count() == 0


def test_chat_format(spark):
    hard = "~0<s>[INST]~1 </s>[/INST]<"
    rows = [(1, 0, "user", hard, "v"), (1, 1, "assistant", hard, "v"), (2, 0, "assistant", None, "v"), (3, None, None, "", "v"), (3, 1, "user", "a", "v"),
            (3, 1, "user", "a", "v"), (None, 0, "user", "b", "v"), (4, 0, "system", "s", "v"), (4, 1, "user", "x" * 100000, "v"), (4, 2, "assistant", "é😀", "v")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, valid string")
    out = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(given)).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [("user", hard), ("assistant", hard)] and out[1].learned == hard
    assert [(t.role, t.text) for t in out[3].turns] == [("", ""), ("user", "a"), ("user", "a")]
    assert out[4].learned == "é😀" and out[2].learned == "" and [(t.role, t.text) for t in out[None].turns] == [("user", "b")]
    assert {i: r.valid for i, r in out.items()} == {1: True, 2: False, 3: False, None: False, 4: True}
    assert chat_format.format_conversations(given.limit(0)).count() == 0


def test_html_extraction(spark):
    pages = [
        (1, "u", "<html><body><nav>x y</nav><article><header><h1>T</h1></header><p>a &amp; b<p>c<aside>no</aside><form>q</form>d <i>e</i>f"
                 "<section class='comments'><p>bad</p></section><p>1 < 2\n 3</article><footer>f", "z"),
        (2, None, None, "z"), (3, "u", "", "z"), (4, "u", "<script>var a='</p>'</script><p>" + "only text here. " * 20 + "</p>", "z"), (4, "u", "plain", "z"),
        (5, "u", "<article>" + "<p>w</p>" * 20000, "z"),
    ]
    got = html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string, text string")).collect()
    texts = sorted((r.page_id, r.text) for r in got)
    assert texts[:3] == [(1, "T\na & b\nc\nd ef\n1 < 2 3"), (2, ""), (3, "")]
    assert texts[3:5] == [(4, ("only text here. " * 20).strip()), (4, "plain")] and texts[5][1] == "\n".join("w" * 20000)


def test_html_extraction_keeps_short_regions():
    long = "<p>" + "long text " * 50 + "</p>"
    kept = ("long text " * 50).strip()
    assert html_extract.main_text("<h1>Title</h1><nav>Menu</nav>" + long * 3 + "<div class='ad'>buy</div><p>End.</p>") == "\n".join(["Title", kept, kept, kept, "End."])
    assert html_extract.main_text("<p>Out</p><article><h1>Title</h1><nav>Menu</nav>" + long + "<div class='ad'>buy</div><p>End.</p></article>") == f"Title\n{kept}\nEnd."


def test_html_extraction_keeps_text_inside_marked_wrappers():
    body = "<h1>Title</h1><p>" + "long text " * 50 + "</p><div class='ad'>buy</div><p>End.</p>"
    kept = "Title\n" + ("long text " * 50).strip() + "\nEnd."
    for wrapper in ("<div class='content with-sidebar'>{}</div>", "<div class='no-sidebar'>{}</div>", "<form>{}</form>", "<div id='login'><form>{}</form></div>"):
        menu = "<nav>Menu</nav>" + wrapper
        assert html_extract.main_text(menu.format(f"<article>{body}</article>") + "<footer>f") == kept
        assert html_extract.main_text(f"<main>{menu.format(body)}</main>") == kept
        assert html_extract.main_text(menu.format(body)) == kept
    assert html_extract.main_text(f"<nav>Menu<article>{body}</article>") == kept  # left open
    several = "".join(f"<div class='widget'><article><p>post {i}</p></article></div>" for i in range(5))
    assert html_extract.main_text(several) == "\n".join(f"post {i}" for i in range(5))
    comments = "<div class='comments'><p>" + "long remarks " * 200 + "</p></div>"
    # What is beside the article or inside it is still dropped.
    assert html_extract.main_text(f"<article>{body}{comments}</article>") == kept
    assert html_extract.main_text(f"<article>{body}<div class='comments'><article>no</article></div></article><form>q</form><div class='comments'><article>no</article></div>") == kept
    assert html_extract.main_text(f"{body}<aside><article>teaser</article></aside>") == kept


def test_html_extraction_never_keeps_marked_elements():
    """Comments, adverts, notices and forms are dropped however long they are."""
    short, remarks = "<h1>T</h1><p>short article text here.</p>", "long remarks " * 50
    for mark in ("div class='comments'", "div class='ad'", "div class='cookie-notice'", "form", "div id=commentlist", "div class='adsbox x'", "section class='topnav'", "div class=mainMenu"):
        block = f"<{mark}>{remarks}</{mark.split()[0]}>"
        for page in (short + block, f"<article>{short}{block}</article>", f"<main>{short}{block}</main>", f"<article>{short}</article>{block}"):
            assert html_extract.main_text(page) == "T\nshort article text here.", page[:90]
    content = "<div id='content'><h1>T</h1><p>" + "main text " * 60 + "</p><p>End.</p></div>"
    kept = "T\n" + ("main text " * 60).strip() + "\nEnd."
    assert html_extract.main_text(content + "<div class='teasers'><article>teaser</article></div>") == kept
    assert html_extract.main_text("<header><h1>Site</h1></header><div class='page-header'>Site</div><div>text</div>") == "text"
    assert html_extract.main_text("<head><title>x</title><body><p>no end of the head") == "no end of the head"


def test_html_extraction_is_linear():
    for page, n in (("<a " * 350_000, 1_049_999), ("<a \">\" " * 100_000, None), ("<a \"" * 250_000 + ">", 0), ("<div class=ad><b>" * 50_000 + "</b>" * 50_000, 0),
                    ("<div>" * 8000 + "</b>" * 8000, 0), ("<" * 500_000 + ">", 500_001), ("<p>x" * 100_000, 199_999), ("<!--" * 200_000 + ">", 0)):
        began = time.process_time()
        text = html_extract.main_text(page)
        assert time.process_time() - began < 6 and (n is None or len(text) == n), page[:20]


def test_html_region_equals_brute_force():
    """The region with most text among all runs of windows over the limit, and pages built from it."""
    rng = random.Random(11)
    for _ in range(300):
        weights = [rng.choice([0, 0, 5, 40, 400]) for _ in range(rng.randrange(1, 14))]
        windows = {i: sum(weights[i : i + html_extract.WINDOW]) for i in range(max(len(weights) - html_extract.WINDOW + 1, 1))}
        high = [i for i in windows if windows[i] > html_extract.SURGE * max(windows.values())]
        runs = [(a, min(b + html_extract.WINDOW, len(weights))) for a in high for b in high if a <= b
                and all(i in high for i in range(a, b + 1)) and a - 1 not in high and b + 1 not in high]
        best = max(runs, key=lambda r: (sum(weights[r[0] : r[1]]), -r[0]), default=(0, 0))
        assert html_extract.densest(weights) == best
        parts = [("ad", "x" * w) if rng.random() < 0.2 else ("p", "y" * w) for w in weights if w]
        page = "".join(f"<div class='ad'>{t}</div>" if k == "ad" else f"<p>{t}</p>" for k, t in parts)
        assert html_extract.main_text(page) == "\n".join(t for k, t in parts if k == "p")


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    letters = " aeth'sdre\n\t0123 \x85\x1c\xa0é漢😀zqx  ..!!"
    texts = [None, "", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "don't " * 3000] + ["".join(RNG.choice(letters) for _ in range(RNG.randint(0, 40))) for _ in range(500)]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    coded = bpe.encode(docs, VOCABULARY)
    got = {r.doc_id: (r.ids, r.decoded) for r in bpe.decode(coded, VOCABULARY).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (ids, library.decode(ids, skip_special_tokens=False))


def test_license_scan(spark):
    texts = ["the MIT License, and mit-license", None, "", "x General Public License y", "# SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0 WITH LLVM-exception",
             "SPDX-License-Identifier: AND", "mit licenses permit license", "w " * 50000 + "apache license"]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word, got[0].labels) == (6, 2, 1, 4, "mit")
    assert (got[1].n_words, got[1].labels, got[1].score, got[2].first_word) == (0, "", 0.0, None)
    assert got[3].base_labels == "gpl" and got[4].labels == "apache,gpl,mit" and got[4].permitted is True and got[4].base_labels == ""
    assert got[5].labels == "" and got[6].n_base == 0 and got[7].first_word == 50000
    assert license_scan.evaluate(license_scan.postfix("MIT AND (GPL-3.0-or-later OR ISC)")) == (True, {"mit", "gpl", "isc"})
    assert license_scan.postfix("(MIT OR") is None and license_scan.evaluate(license_scan.postfix("MIT AND GPL-2.0"))[0] is False


def test_pipeline(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    rows = out.collect()
    assert 0 < len(rows) < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert len({r.doc_id for r in rows}) == len(rows)


def test_queries_have_the_agreed_columns(spark, sf_dir):
    wanted = {
        "op1_substring_dedup": "doc_id n_words n_removed kept_sha256", "op3_url_filter": "page_id host path rule verdict",
        "op4_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op6_minhash_dedup": "doc_id n_shingles component_id kept", "op7_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        "op8_html_extraction": "page_id url text n_chars", "op9_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op10_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    }
    for name, columns in wanted.items():
        assert queries.QUERIES[name](spark, sf_dir).columns[: len(columns.split())] == columns.split()
    extra = queries.op7_chat_format(spark, sf_dir).filter("conv_id = -7").first()
    assert extra.loss_sha256 == hashlib.sha256(queries.CONTROL_TEXT.encode()).hexdigest()


def plain_components(rows):
    """The document kept of every group of rows (id, text), and all ids that stay."""
    sets = [(i, shingled(t)) for i, t in rows]
    group = {i: i for i, _ in sets}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((top(i), top(j)))
                group[y] = x
    return {i for i, _ in sets if top(i) == i}


def plain_repeats(rows):
    """Texts after removing 13-word windows that start in a document with a smaller id."""
    first, out = {}, {}
    for i, t in sorted(rows):
        w = words(t)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    for i, t in rows:
        w = words(t)
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        if not gone:
            out[i] = t
        elif len(gone) < len(w):
            out[i] = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
    return out


def test_pipeline_equals_plain_python(spark, sf_dir, tmp_path):
    """Every stage's rows against a plain version over what the stage before kept; the classifier's verdicts are given."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        made[name] = sorted(map(tuple, docs.collect()), key=lambda r: r[0])
    rows = [(r[0], r[1]) for r in made["quality_classifier"]]
    stay = plain_components(rows)
    assert [(r[0], r[1]) for r in made["minhash_dedup"]] == [r for r in rows if r[0] in stay] and len(stay) < len(rows)
    cut = plain_repeats([(r[0], r[1]) for r in made["minhash_dedup"]])
    assert {r[0]: r[1] for r in made["substring_dedup"]} == cut
    items = [shingled(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {i for i, t in cut.items() if any(x and 100 * len(shingled(t) & x) >= 75 * len(x) for x in items)}
    assert [r[0] for r in made["decontamination"]] == sorted(set(cut) - leaks) and leaks
    coder = Tokenizer.from_file(VOCABULARY)
    coder.encode_special_tokens = True
    for (i, n, ids, _), r in zip(made["bpe"], made["decontamination"]):
        want = coder.encode(r[1] or "", add_special_tokens=False).ids
        assert (i, n, ids) == (r[0], len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest())


def test_license_base_columns_equal_brute_force(spark, sf_dir):
    """Places, words and labels of the base phrases by a plain scan of every word."""
    import re

    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(-1, None), (-2, ""), (-3, "MIT-License mit LICENSE apache\nlicense; general public license general public"), (-3, "mit license " * 300), (-4, "smit license")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = []
    for i, t in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        hits = [(k, label) for p, label in phrases.items() for k in range(len(w)) if tuple(w[k : k + len(p)]) == p]
        at = [k for k, _ in hits]
        want.append((i, len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))))
    key = lambda r: (r[0], r[1])
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(want, key=key)
    assert sum(r[2] for r in want) > 300 and all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_empty_tables_of_the_text_operators(spark):
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY, decoded=True).count() == 0
