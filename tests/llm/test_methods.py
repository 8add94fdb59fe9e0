"""Parts of the operators against brute force, and the defined cases: nulls, empties, ties, repeats, empty tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import covertree, language, lm, mixing, pages, pii, repeats, secrets, simhash, suffixes, tiling
from millrace.llm.components import connected
from tests.llm.test_operators import kept_bytes, pii_spans


@pytest.mark.parametrize("letters", ["ab", "abcd", "a"])
def test_two_stage_order(letters):
    rng = random.Random(1)
    for width in (3, 7, 20):
        text = "".join(rng.choice(letters) for _ in range(400)) + "\0" * (2 * width)
        codes = np.frombuffer(text.encode(), np.uint8)
        starts = np.array(sorted(rng.sample(range(380), 200)))
        got = suffixes.two_stage(codes, starts, width)
        assert sorted(got) == starts.tolist()
        heads = [text[i : i + width] for i in got]
        assert heads == sorted(heads)


@pytest.mark.parametrize("length", [4, 10])
def test_repeats_on_few_letters(spark, length):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += [texts[0], texts[3] + texts[4], "a" * 70, "a" * 90, "", "é\0é" * 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(docs, length).collect()}
    assert got == kept_bytes(list(enumerate(texts)), length)


def test_repeats_of_hot_hashes(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP", 2)
    texts = [f"{i} the same long passage stands here {i * 7919}" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(docs, 12).collect()}
    assert got == kept_bytes(list(enumerate(texts)), 12)


def test_hot_hashes_stay_in_their_host(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP", 1)
    passage = "<p>one passage that stands once on each host</p>"
    rows = [(h * 10 + i, f"http://h{h}.example/{i}", f"<p>page {h} {i} has words {h * 7 + i} of its own</p>" + (passage if i == 0 else "")) for h in range(2) for i in range(3)]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all("one passage that stands once on each host" in got[h * 10] for h in range(2))
    slices = [(h, 2, 10 * h + i, 0, 10 * h + i, b"abcdef" if h < 2 or i else b"uvwxyz") for h in range(3) for i in range(2 if h else 1)]
    frame = spark.createDataFrame(slices, "hash long, n long, rank long, start long, owner long, slice binary")
    assert sorted(r["owner"] for r in suffixes.repeated(frame, 6, 1, later=False).collect()) == [10, 11]


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_covering_masks_miss_no_pair(radius):
    masks = simhash.covering_masks(list(range(64)), radius)
    rng = random.Random(3)
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not flips & m for m in masks)


def test_links_of_split_buckets(spark):
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    values = {centre}
    for _ in range(300):
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(64)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "x long")
    roots = {r["node"]: r["root"] for r in connected(simhash.links(frame, 2, bucket=20), "test").collect()}
    assert set(roots.values()) == {min(signed)}  # each value is one bit from another one


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    want = {x: find(x) for e in edges for x in e if find(x) != x}
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "u long, v long"), "test").collect()}
    assert {k: v for k, v in got.items() if k != v} == want


def test_cover_tree_pairs(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 8))
    x = np.concatenate([x, x[:60] + rng.normal(size=(60, 8)) * 0.06, x[:5]])
    rows = [(i, i % 2, v.tolist()) for i, v in enumerate(x)] + [(900, 1, None), (901, 1, [0.0] * 8), (902, 1, [float("nan")] * 8), (903, None, x[0].tolist()), (904, 1, [None] * 8), (905, 1, [])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r[0]: tuple(r)[1:] for r in covertree.near_duplicates(frame, 0.98, block=25).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (np.arange(len(x))[:, None] % 2 == np.arange(len(x)) % 2)
    reach = near.copy()
    for _ in range(8):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    for i in range(len(x)):
        least = int(np.flatnonzero(reach[i]).min())
        assert got[i] == (int(near[i].sum()) - 1, least, least == i)
    assert all(got[i] == (0, i, True) for i in range(900, 906))


def test_pii_on_random_texts():
    rng = random.Random(7)
    parts = ["a@b.co", "@", "1.2.3.4", ".", "4111 1111-1111 1111", "+1 (555) 123-4567", "+", "9", "300.1.1.1", "x_y%z@q-r.s.t", " ", "-", "7.7.7", "555555555555"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        base = [s[:3] for s in pii.find(text) if s[0] in pii.BASE]
        assert sorted(base) == sorted(pii_spans(text)), text


def test_pii_takes_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000):
        pii.find(text)


def test_pii_kinds_and_mask():
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")
    assert pii.mask("write to a@b.co or x") == "write to <EMAIL> or x"
    assert pii.mask("iban GB82 WEST 1234 5698 7654 32.") == "iban <IBAN>."
    assert pii.mask("nothing") == "nothing"


def test_tiling_finds_reordered_parts():
    words = np.arange(40, dtype=np.uint64)
    assert tiling.tile(np.concatenate([words[20:40], [99], words[:20]]).astype(np.uint64), words, 3) == 40
    assert tiling.tile(words[:10], words, 3) == 10
    assert tiling.tile(np.array([1, 2], np.uint64), words, 3) == 0


def test_network_finds_what_patterns_do_not(spark):
    rng = random.Random(8)
    key = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    rows = [(i, f"some plain words stand here password = {key(32)} and https-example-page-{i}-of-many words") for i in range(300)]
    rows.append((999, f"some plain words stand here passphrase {key(32)} and words"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    network = secrets.train(docs)
    assert 0.5 <= network.threshold <= 1
    got = {r["doc_id"]: r["spans"] for r in secrets.digest(docs, network).collect()}
    assert all("assign:" in got[i] for i in range(300))
    assert sum("model:" in got[i] for i in range(300)) < 60


def test_training_reads_every_document(spark):
    texts = [" ".join(f"w{i}x{k}" for k in range(20)) for i in range(24)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    of = np.arange(lm.BUCKETS + 1) % lm.CLASSES
    table = lm.fit(docs, of, np.ones(lm.CLASSES))
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        rows = lm.Tokens(data, np.array([0, len(data)])).features()[:, 1]  # the last two words, of this text only
        assert (table[rows[2:]] != 0).any(axis=1).all()


def test_network_sees_all_of_a_long_run(spark):
    rng = random.Random(8)
    key = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    rows = [(i, f"some plain words stand here password = {key(32)} and https-example-page-{i}-of-many words") for i in range(300)]
    path = "/many-plain-words/of-a-page-path" * 3
    rows += [(999, f"some plain words stand here passphrase {key(32)} and words"), (1000, f"some plain words stand here {path}/{key(32)}{path}-1 and words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    network = secrets.train(docs)
    got = {r["doc_id"]: r["spans"] for r in secrets.digest(docs, network).collect()}
    assert got[999] == "model:39:71" and got[1000].startswith("model:28:")
    assert sum("model:" in got[i] for i in range(300)) < 60
    assert secrets.windows(3, 40) == [(3, 40)] and secrets.windows(0, 100) == [(0, 48), (24, 72), (48, 96), (52, 100)]


def test_secrets_learn_from_every_document(spark, monkeypatch):
    """Each document holds a finding with a character of its own, whose weights move if the place is not left out."""
    letters = sorted(c for c in secrets.CODES if c.isalnum())
    rows = [(i, f"password = {c * 12} and some words") for i, c in enumerate(letters)] + [(1000 + i, "nothing in here " * 9) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(secrets, "TASK_DOCS", 10)
    network, fresh = secrets.train(docs), secrets.Network()
    codes = [secrets.CODES[c] for c in letters]
    moved = (network.taps[1][:, codes] != fresh.taps[1][:, codes]).any(axis=(0, 2))
    left_out = {r["doc_id"] for r in docs.filter(secrets.F.pmod(secrets.F.xxhash64(secrets.F.lit(5), "doc_id", "text"), secrets.F.lit(secrets.HELD)) == 0).collect()}
    assert all(moved[i] for i in range(len(letters)) if i not in left_out) and len(left_out) < 40
    seen = secrets._responses(docs.withColumn("part", secrets.F.lit(0)), network, None)
    assert seen[:, 2].sum() == sum(len(secrets.labelled([r["text"]])[1]) for r in docs.collect())


def test_secrets_are_trained_once_a_round(spark):
    """One pass counts the documents, one a round trains, and one gives the responses."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([(i, f"password = s{i}cretwordofmine and some words") for i in range(60)], "doc_id long, text string")
    assert secrets.train(docs.mapInArrow(counted, docs.schema)) is not None
    assert read.value <= 60 * (secrets.ROUNDS + 2)


def test_threshold_follows_the_recall():
    network = secrets.Network()
    x = np.random.default_rng(1).integers(0, secrets.SYMBOLS, (200, secrets.LENGTH))
    y = (np.arange(200) < 20).astype(np.float32)  # few positives of no pattern: their probabilities are low
    network.calibrate(x, y)
    assert network.threshold < 0.5
    assert (network.probabilities(x)[y > 0] >= network.threshold).mean() >= secrets.RECALL


def test_pages_without_article(spark):
    page = "<body><div class='cookie-banner'>We use {n} cookies</div><div>Site wide words that every page of this host shows</div><div>Own story number {n} told in {n} words</div><script>x()</script><p>Tom &amp; Ann</body>"
    rows = [(i, f"http://h.example/{i}", page.format(n=i)) for i in range(5)] + [(7, None, None), (8, "http://h.example/8", ""), (9, "http://h.example/9", "<p>open <b>tag")]
    got = {r["page_id"]: r for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3]["text"] == "Own story number 3 told in 3 words Tom & Ann"
    assert (got[7]["text"], got[7]["n_chars"], got[7]["url"], got[8]["text"], got[9]["text"]) == ("", 0, None, "", "open tag")


def test_short_blocks_that_repeat_on_a_host(spark):
    page = "<body><ul><li>Home<li>Our shop<li>Contact us now</ul><div>Own story {n} is told with words {m}</div><div>Share this page</div><p>Only {n}</p><div>Call us</div><div>any day but Sunday</div></body>"
    rows = [(i, f"http://h.example/{i}", page.format(n=i, m=i * 31)) for i in range(4)] + [(9, "http://other.example/", "<div>Share this page</div><p>and more</p>")]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(4)] == [f"Own story {i} is told with words {i * 31} Only {i}" for i in range(4)]
    assert got[9] == "Share this page and more"


def test_repeats_inside_of_articles(spark):
    rng = random.Random(12)
    story = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    own, post = [story(30) for _ in range(6)], story(60)
    notice = "<div>All rights of this text are with the publisher of the site</div><div>Read more</div>"
    rows = [(i, f"http://h.example/{i}", f"<nav>Menu</nav><article><p>{own[i]}</p>{notice}</article>") for i in range(6)]
    # a story that stands on two pages is no boilerplate, and its longer version keeps it
    rows += [(10 + i, f"http://h.example/p{i}", f"<article><p>{post}</p></article><p>{i}</p>") for i in range(2)]
    rows.append((20, "http://h.example/long", f"<main><p>{post}</p><p>{own[0][::-1]} {story(200)}</p></main>"))
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(6)] == own
    assert got[10] == got[11] == post
    assert got[20].startswith(post)


def test_class_words_do_not_hide_the_article():
    text = lambda page: " ".join(t for k, t, _ in pages.blocks(page) if k == pages.ARTICLE)
    assert text("<main class='has-sidebar'><p>one</p><div class='share'>x</div></main>") == "one"
    assert text("<main><article class='post share-enabled'>two</article></main>") == "two"
    assert text("<div class='with-sidebar'><article>three</article><div>x</div></div>") == "three"
    assert text("<article>four</article><div class='related'><article>x</article></div>") == "four"
    assert text("<article>five<article class='comment'>x</article></article>") == "five"
    assert text("<aside><article>x</article></aside>") == ""


CASES = [
    (None, None, None, None), (1, "", "en", None), (2, None, "en", "s"), (3, " \t\n", None, "s"), (3, " \t\n", None, "s"), (4, "word", "xx", "t"),
    (5, "lorem ipsum dolor sit amet " * 4000, "la", "t"), (6, "x" * 300_000, "la", "s"), (7, "a@b.co password=abcdef123456 " + "f" * 30, "en", "s"), (7, "a@b.co password=abcdef123456 " + "f" * 30, "en", "s"),
]
OPERATORS = {
    "mix": lambda d, b: mixing.mix(d, mixing.quality_weights(d.select("doc_id", F.lit(1).alias("quality")))),
    "lm": lambda d, b: lm.score(d),
    "language": lambda d, b: language.predict(d, language.train(d), ["doc_id"]),
    "secrets": lambda d, b: secrets.digest(d, secrets.train(d)),
    "simhash": lambda d, b: simhash.near_duplicates(d),
    "pii": lambda d, b: pii.digest(d),
    "repeats": lambda d, b: repeats.remove_repeats(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_defined_cases(spark, name):
    docs = spark.createDataFrame(CASES, "doc_id long, text string, lang string, source string")
    for extra in ("size", "n", "owner", "hash", "key", "component_id", "rank", "spans", "label", "score"):
        docs = docs.withColumn(extra, F.lit("clash"))
    got = OPERATORS[name](docs, None).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(c[0]) for c in CASES)
    twins = [r for r in got if r["doc_id"] == 7]
    assert twins[0] == twins[1]
    assert OPERATORS[name](docs.limit(0), None).collect() == []


def test_tiling_defined_cases(spark):
    docs = spark.createDataFrame(CASES, "doc_id long, text string, lang string, source string").withColumn("coverage", F.lit("clash"))
    tests = spark.createDataFrame([(1, None), (2, ""), (3, "word"), (4, "lorem ipsum dolor sit amet lorem ipsum"), (4, "lorem ipsum dolor sit amet lorem ipsum")], "item_id long, text string")
    got = [(r["doc_id"], r["item_id"]) for r in tiling.find_tests(docs, tests, ["doc_id"]).collect()]
    assert sorted(got) == [(4, 3), (5, 4), (5, 4)]
    assert tiling.find_tests(docs.limit(0), tests, ["doc_id"]).count() == 0
    assert tiling.find_tests(docs, tests.limit(0), ["doc_id"]).count() == 0
    left = {r["doc_id"] for r in tiling.clean(docs, tests).collect()}
    assert left == {None, 1, 2, 3, 6, 7}


def test_keep_one_of_equal_rows(spark):
    docs = spark.createDataFrame(CASES, "doc_id long, text string, lang string, source string")
    got = [r["doc_id"] for r in simhash.keep_one(docs).collect()]
    assert sorted(got, key=str) == sorted([1, 4, 5, 6, 7], key=str)


def test_keep_one_of_null_and_shared_ids(spark):
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (-1, texts[4]), (None, texts[5]), (9, texts[5])]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted([(0, texts[0]), (0, texts[1]), (5, texts[2]), (5, texts[3]), (-1, texts[4]), (9, texts[5])])


def test_language_score_range(spark):
    docs = spark.createDataFrame(CASES, "doc_id long, text string, lang string, source string")
    for r in language.predict(docs, language.train(docs), ["doc_id"]).collect():
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (None, 1, 2, 3))
    assert {r["lang_pred"] for r in language.predict(docs, None, ["doc_id"]).collect()} == {"und"}


def test_no_source_is_above_three_epochs(spark):
    docs = spark.createDataFrame([(i, "w " * 10, f"s{i % 3}") for i in range(30)] + [(99, "w " * 5000, None)], "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert all(r["target"] <= 3 * r["source_size"] for r in got)
    targets = {r["source"]: r["target"] for r in got}
    assert sum(targets.values()) == pytest.approx(5300)
    assert re.match("s", min(s for s in targets if s))


def test_language_sample_is_cut_before_it_is_ranked(spark):
    """The smallest hashes of each language are picked, and of a hot one few rows meet in the window."""
    from pyspark.sql import functions as F

    from millrace.llm import language

    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 60 == 0, "rare").otherwise("hot").alias("lang"), F.lit("some words").alias("text"))
    picked = language.sample(docs, 40)
    usable = docs.filter(~language.held_out(F.col("doc_id"))).withColumn("mark", F.xxhash64(F.lit(4), F.col("doc_id")))
    want = {}
    for r in sorted(usable.collect(), key=lambda r: r["mark"]):
        want.setdefault(r["lang"], []).append(r["doc_id"])
    assert {r["lang"]: r["count"] for r in picked.groupBy("lang").count().collect()} == {k: language.WINDOWS_PER_DOC * min(40, len(v)) for k, v in want.items()}
    bound = [-(2.0**63) + 2.0**64 * min(1.0, language.MARGIN * 40 / n) for n in (5900, 100)]
    below = usable.filter((F.col("lang") == "hot") & (F.col("mark") <= bound[0])).count()
    assert 40 <= below <= 300


@pytest.mark.parametrize(
    "source,want",
    [
        ('<article><p>one</p><a href="x>two</a></article>', ["one", "two"]),
        ("<article><p>one</p><a href='x>two</article>", ["one", "two"]),
        ('<article><p>one</p><a href="x two', ["one"]),
        ('<article><a title="a > b">one</a> two</article>', ["one two"]),
        ("<article>one</div></p></b> two</article>", ["one", "two"]),
    ],
)
def test_broken_markup_is_no_text(source, want):
    from millrace.llm.pages import blocks

    assert [text for _, text, _ in blocks(source)] == want


def test_open_elements_take_time_in_proportion():
    import time

    from millrace.llm.pages import blocks

    for start, end in (("<div>", "</span></section>"), ("<b>", "<p>x</p>"), ("<p><i>", "</u></ul>"), ('<a href="', ">x")):
        took = []
        for n in (4_000, 16_000):
            began = time.process_time()
            blocks(start * n + end * n)
            took.append(time.process_time() - began)
        assert took[1] < 10 * max(took[0], 0.02)


def test_op3_defined_cases(spark):
    """Empty tables, null html, clashing columns, repeated rows and a very long page."""
    from millrace.llm import pages

    story = " ".join(f"word{i}" for i in range(40_000))
    menu = "<div>Home and News and About us and Contact</div>"
    html = lambda text: f"<html><body>{menu}<article><p>{text}</p></article></body></html>"
    rows = [(1, "http://a/1", html("first story")), (1, "http://a/1", html("first story")), (2, "http://a/2", html(story)), (3, None, None), (None, "http://a/4", ""), (5, "http://a/5", html("fifth"))]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "page_id long, url string, html string, key int, hash int, host_hash int, start int")
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in pages.extract(docs).collect())
    assert got == [(0, "", 0), (1, "first story", 11), (1, "first story", 11), (2, story, len(story)), (3, "", 0), (5, "fifth", 5)]
    assert pages.extract(docs.limit(0)).collect() == []


def naive_tiling(doc, test, least):
    """Greedy string tiling word by word: all runs of unmarked words, the longest first, leftmost in the document."""
    a, b = [False] * len(doc), [False] * len(test)
    while True:
        runs = []
        for i in range(len(doc)):
            for j in range(len(test)):
                k = 0
                while i + k < len(doc) and j + k < len(test) and doc[i + k] == test[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                if k >= least:
                    runs.append((k, i, j))
        if not runs:
            return sum(b)
        longest = max(runs)[0]
        for k, i, j in sorted(runs, key=lambda r: r[1:]):
            if k == longest and not any(a[i : i + k]) and not any(b[j : j + k]):
                a[i : i + k] = b[j : j + k] = [True] * k


def test_tiling_is_greedy():
    rng = np.random.default_rng(3)
    for case in range(250):
        words = rng.integers(1, [3, 6, 40][case % 3], 90).astype(np.uint64)
        test = rng.integers(1, [3, 6, 40][case % 3], rng.integers(1, 30)).astype(np.uint64)
        doc = np.concatenate([words[:20], test[len(test) // 2 :], words[20:40], test[: len(test) // 2 + 2]])
        least = min(3, len(test))
        assert tiling.tile(doc, test, least) == naive_tiling(doc.tolist(), test.tolist(), least)


def test_tiling_of_repetitive_texts_takes_little_time():
    import time

    began = time.process_time()
    assert tiling.tile(np.ones(200_000, np.uint64), np.ones(100, np.uint64)) == 100
    assert tiling.tile(np.arange(200_000, dtype=np.uint64) % np.uint64(7), np.arange(300, dtype=np.uint64) % np.uint64(5)) == 300
    assert time.process_time() - began < 5


def test_blocks_of_the_benchmark_are_told_one_by_one(spark):
    tests = spark.createDataFrame([(i, "some words of a test") for i in range(10)], "item_id long, text string")
    blocks = tiling._blocks(tests, 12)
    assert len(next(blocks)) == 2 and len(list(blocks)) == 4
    assert list(tiling._blocks(tests.limit(0), 12)) == [[]]


def test_spans_that_are_clear_of_others():
    import random

    draw = random.Random(2)
    for _ in range(300):
        spans = [("k", a := draw.randrange(60), a + draw.randrange(1, 12)) for _ in range(draw.randrange(8))]
        clear = secrets.clear_of(spans)
        for a in range(70):
            for n in (1, 5):
                assert clear(a, a + n) == (not any(s < a + n and a < e for _, s, e in spans))


def test_op7_defined_cases(spark):
    """Empty tables, null and repeated ids, clashing columns."""
    rows = [(1, "a", [1.0, 0.0]), (1, "a", [1.0, 0.0]), (None, "a", [1.0, 0.001]), (4, "b", [1.0, 0.0]), (5, None, [1.0, 0.0]), (6, "a", [0.0, 0.0]), (7, "a", None)]
    vectors = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, label string, embedding array<double>, node int, mark0 int, root int")
    got = sorted(((r["vec_id"] or 0), r["n_links"], r["component_id"]) for r in covertree.near_duplicates(vectors).collect())
    assert got == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7)]
    assert covertree.near_duplicates(vectors.limit(0)).collect() == []


def test_steps_of_tasks_are_added_in_order(spark):
    """Two levels of sums give the mean by tokens; reruns of the whole score agree to the last digit."""
    from millrace.llm import lm

    draw = np.random.default_rng(4)
    rows, want = [], {}
    for task in range(13):
        for chunk in (0, 2):
            moved = np.unique(draw.integers(0, lm.CHUNK, 5)) + chunk * lm.CHUNK
            step, seen = draw.normal(size=(len(moved), lm.CLASSES)).astype(np.float32), float(draw.integers(1, 9))
            rows.append((chunk, task % lm.FAN, task, moved.astype(np.int32).tobytes(), np.full(len(moved), seen, np.float32).tobytes(), (step * np.float32(seen)).tobytes()))
            for m, s in zip(moved.tolist(), step, strict=True):
                total, weight = want.get(m, (np.zeros(lm.CLASSES), 0.0))
                want[m] = (total + s * seen, weight + seen)
    steps = spark.createDataFrame(rows, "chunk long, part int, task int, moved binary, weight binary, step binary").repartition(5)
    sums = steps.repartition("chunk", "part").sortWithinPartitions("chunk", "part", "task").mapInArrow(lm._sum_steps, "chunk long, part int, moved binary, weight binary, step binary")
    got = {}
    for r in sums.repartition("chunk").sortWithinPartitions("chunk", "part").mapInArrow(lm._mean_steps, "moved binary, step binary").collect():
        got |= dict(zip(np.frombuffer(r["moved"], np.int32).tolist(), np.frombuffer(r["step"], np.float32).reshape(-1, lm.CLASSES), strict=True))
    assert set(got) == set(want)
    assert all(np.allclose(got[m], total / weight, atol=1e-5) for m, (total, weight) in want.items())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    once, again = (sorted((r["doc_id"], r["score"]) for r in lm.score(docs).collect()) for _ in range(2))
    assert once == again


def test_batches_of_long_texts_go_in_parts(spark):
    """No task hands on, or holds results of, more than ``PIECE_BYTES`` of texts at a time; one longer text goes alone."""
    import pyarrow as pa

    from millrace.llm.arrays import PIECE_BYTES

    class Frame:
        """Gives the function that a task would run over Arrow batches."""

        def __init__(self, frame):
            self.frame, self.schema, self.sparkSession = frame, frame.schema, frame.sparkSession

        def select(self, *_):
            return self

        def mapInArrow(self, work, _):
            return work

    texts = ["a@b.co " + "word " * 400, None, "", "x" * (PIECE_BYTES + 5)] * 300
    texts[7::4] = ["y"] * 299
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1200)), "text": texts, "has_letter_": [bool(t) for t in texts]})
    docs = Frame(spark.createDataFrame([(0, "")], "doc_id long, text string"))
    tests = spark.createDataFrame([(1, "no such words anywhere in these texts at all")], "item_id long, text string")
    network = language.Network(["de", "en"])
    for work in (
        pii.over_texts(docs, ["doc_id"], "masked string", lambda text: (pii.mask(text),)),
        tiling.clean(docs, tests),
        language.predict(docs, network, ["doc_id", "text"]),
    ):
        got = list(work(iter([batch])))
        assert [i for part in got for i in part.column("doc_id").to_pylist()] == list(range(1200))
        sizes = [sum(len(texts[i] or "") for i in part.column("doc_id").to_pylist()) for part in got]
        assert all(size <= PIECE_BYTES or part.num_rows == 1 for size, part in zip(sizes, got, strict=True))
        if "score" in got[0].schema.names:
            assert all(part.schema.field("score").type == pa.float64() for part in got)
    assert list(pii.over_texts(docs, ["doc_id"], "masked string", lambda text: (text,))(iter([batch.slice(0, 0)]))) == []
