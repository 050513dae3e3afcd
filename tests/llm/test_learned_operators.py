"""Toxicity, quality, pages, embeddings and the pipeline: parts against plain versions, results against labels and fixtures."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offermart.llm import lattice, models, packing, postings, quality, simhash, toxicity, wrapper
from tests.llm.conftest import LONG, ROWS

SF = "/root/testdata/sf0.01"


def edits(a, b):
    """Levenshtein distance with swaps of neighbours as one edit."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[-2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


def test_automaton_accepts_what_is_near():
    rng = random.Random(3)
    terms = ["moron", "scum", "ab", "abc", "pathetic", "disgusting", "abab", "babababa"]
    trie = toxicity.Trie(terms)
    allowed = {t: (len(t) >= 4) + (len(t) >= 8) for t in terms}
    words = {"".join(rng.choice("abcmorn") for _ in range(rng.randint(0, 9))) for _ in range(1500)}
    for t in terms:
        for _ in range(60):
            w = list(t)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "a"])
            words.add("".join(w))
        words.update(t[:i] + t[i + 1] + t[i] + t[i + 2 :] for i in range(len(t) - 1))
    for w in words:
        near = [edits(w, t) for t in terms if edits(w, t) <= allowed[t]]
        assert trie.distance(w) == min(near, default=None), w


def test_lexicon_and_context():
    lexicon = toxicity.Lexicon(["moron", "pathetic"], ["lowei"], {"baron", "macron"})
    kinds = {w: lexicon.kind(w) for w in ("moron", "loweixy", "m0ron", "morron", "pathtic", "baron", "lowe", "river")}
    assert kinds == {"moron": 0, "loweixy": 1, "m0ron": 2, "morron": 2, "pathtic": 2, "baron": None, "lowe": None, "river": None}
    abuse = toxicity.features("You are a moron.", lexicon)
    for text in ('They cried "you moron" once.', "She said moron was rude.", "«Quel moron», dit-il", "“a moron”"):
        quoted = toxicity.features(text, lexicon)
        assert quoted[0] == 0 and quoted[3] > 0 and abuse[0] > 0 and abuse[3] == 0
    assert toxicity.features(None, lexicon) == toxicity.features("", lexicon) == [0.0] * 5
    assert toxicity.Trie([]).distance("word") is None


def test_logistic_and_network():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    w = models.fit_logistic(x, y)
    assert ((x @ w[:-1] + w[-1] > 0) == y).mean() > 0.97
    curved = (np.abs(x[:, 0]) > 0.7).astype(float)
    noisy = np.where(rng.random(3000) < 0.1, 1 - curved, curved)
    net = models.Network(epochs=60).fit(x, noisy)
    p = net.predict(x)
    assert ((p > 0.5) == curved).mean() > 0.93
    assert abs(p.mean() - noisy.mean()) < 0.08  # calibrated on average
    assert np.allclose(models.Network().fit(x, np.ones(3000)).predict(x), 3001 / 3002)
    assert models.Network().fit(np.zeros((0, 3)), np.zeros(0)).predict(x[:2]).tolist() == [0.5, 0.5]


def plain_means(texts):
    """Means of word vectors by dictionaries: every word's neighbours are counted one by one."""
    known, total, words = quality._Keys(), {}, []
    vector = lambda key: np.bincount(quality.index_vectors([key])[0][0], quality.index_vectors([key])[1][0], quality.DIMS)
    for text in texts:
        keys, n, marks = quality.tokens(text, known)
        words.append((keys, n, marks))
        for i, key in enumerate(keys):
            around = [*keys[max(0, i - quality.REACH) : i], *keys[i + 1 : i + 1 + quality.REACH]]
            total[key] = total.get(key, 0) + sum(map(vector, around), np.zeros(quality.DIMS))
    vectors = {}
    for key, context in total.items():
        length = np.sqrt((context**2).sum())
        vectors[key] = np.rint((vector(key) / np.sqrt(quality.NONZERO) + (context / length if length else 0)) * quality.UNIT)
    return [(marks + sum((vectors[k] for k in keys), np.zeros(quality.DIMS))) / n / quality.UNIT for keys, n, marks in words], total


@pytest.mark.parametrize("head", [0, 40, quality.HEAD])
def test_means_of_word_vectors_equal_plain_ones(spark, docs, head):
    """Each word has its own vector; what is broadcast and what is joined makes no difference."""
    few = spark.read.parquet(f"{SF}/documents.parquet").limit(60).select("doc_id", "text")
    rows = few.unionByName(docs.where("length(text) < 1000 OR text IS NULL").select("doc_id", "text")).collect()
    table = spark.createDataFrame(rows, few.schema).repartition(3)
    words = quality.word_vectors(table)
    means, carried = quality.pooled(table, words, "doc_id", F.lit(False), carry=True, head=head)
    got = [(r["row"]["doc_id"], r["row"]["text"], r["id"], np.frombuffer(r["mean"], np.float32)) for r in means.join(carried, "at").collect()]
    want, total = plain_means([r["text"] for r in rows])
    assert words.count() == len(total) and (quality.head_count(words, head) > 1) == (head < len(total))
    assert len(got) == len(rows) and all(a == b for a, _, b, _ in got)
    by_text = {r["text"]: mean for r, mean in zip(rows, want)}
    assert all(np.allclose(mean, by_text[text], atol=1e-5) for _, text, _, mean in got)


def test_sums_over_batches():
    """Groups that run over batches, small and large numbers, single rows."""
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 9, 200))
    rows = rng.integers(-100, 100, (200, quality.DIMS)) * np.where(rng.random(200) < 0.3, 1000, 1)[:, None]
    batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.ones(200, np.int64)), quality.packed(rows)], names=["key", "n", "vec"])
    assert (quality.unpacked(batch.column("vec")) == rows).all()
    for size in (1, 7, 200):
        cut = (batch.slice(at, size) for at in range(0, 200, size))
        got = [(k, s.tolist(), n) for first, sums, counts in quality.summed(cut, "key") for k, s, n in zip(first.column("key").to_pylist(), sums, counts)]
        assert got == [(k, rows[keys == k].sum(0).tolist(), (keys == k).sum()) for k in np.unique(keys)]


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (5, None, None), (None, 1, 1), (6, 0, 1), (8, 1, 0), (10, 1, 0), (11, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("score", [toxicity.toxicity, quality.quality])
def test_scores_awkward(docs, none, labels, score):
    got = score(docs, labels, carry=True)
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert sorted(str((r["id"], r["row"]["text"])) for r in rows) == sorted(str(r) for r in ROWS)
    assert got.select("row.*").columns == docs.columns
    assert len({r["score"] for r in rows if r["row"]["text"] and r["row"]["text"].startswith("The quick")}) == 1
    assert score(none, labels).count() == 0
    assert {r["score"] for r in score(docs, labels.limit(0)).collect()} == {0.5}


@pytest.mark.parametrize("score, label, least", [(toxicity.toxicity, "toxic", 0.95), (quality.quality, "quality", 0.95)])
def test_held_out_accuracy(spark, score, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = score(docs, labels).join(labels, F.col("id") == F.col("doc_id")).where("held_out").select("predicted", label).collect()
    assert len(got) > 50 and np.mean([a == b for a, b in got]) >= least


def page(article, menu="Home", foot="About us", extra=""):
    return (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>{menu}</a></li></ul></nav>"
            f"<div class='ad'>Buy</div><script>var a = '</p>';</script>{article}{extra}<footer>{foot}</footer></body></html>")


PAGES = [
    (1, "http://a.example/1", page("<article><h1>One &amp; all</h1><p>First  text<br>goes on.<p>Second <b>bold</b></article>"), "One & all\nFirst text goes on.\nSecond bold"),
    (2, "http://a.example/2", page("<main><p>Only&nbsp;this &lt;tag&gt;</p><aside>no</aside><form>no</form></main>", extra="<div id='comments'><p>nice!</p></div>"), "Only this <tag>"),
    (3, "http://a.example/2", None, ""), (4, None, "", ""), (None, "no url", "plain &eacute;t&eacute;", "plain été"),
    (5, "http://b.example/", page("<article><header><h1>Head</h1><span>by me</span></header><p>Body</p><section class='comments'><p>reader</p></section></article>"), "Head\nBody"),
    (6, "http://c.example/", page("<article><p>" + LONG + "</p></article>"), LONG),
    (6, "http://c.example/", page("<article><p>" + LONG + "</p></article>"), LONG),
    (7, "http://d.example/", "<p>open <b>never <i>closed <a href='x", "open never closed <a href='x"),
    (8, "http://d.example/", "<div>" * 2000 + "deep" + "</div>" * 1000, "deep"),
]


def test_pages_awkward(spark):
    rows = [(i, u, h, "x") for i, u, h, _ in PAGES]
    got = wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(map(str, [(r["id"], r["text"]) for r in got])) == sorted(map(str, [(i, t) for i, _, _, t in PAGES]))
    assert wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_template_is_learned_by_host(spark):
    """Without marks of any kind: what all pages of a host share goes, what varies stays; copies of a page do not make a template."""
    rows = [
        (i, f"http://x.example/{i}", f"<body><div>Site of X</div><div><p>Text number {i} of many</p><p>and more {i * 7}</p></div><div><p>All rights</p><span>2024</span></div></body>")
        for i in range(8)
    ]
    rows += [(100 + i, f"http://y.example/{i}", "<body><div>Same</div><div><p>copy</p></div></body>") for i in range(8)]
    got = {r["id"]: r["text"] for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Text number {i} of many\nand more {i * 7}" for i in range(8))
    assert all(got[100 + i] == "Same\ncopy" for i in range(8))


def test_template_decides_inside_the_article(spark):
    """A bare line that all pages of a host repeat inside the article goes; near copies of one article keep all their lines."""
    said = "<h2>Read on</h2><p>Subscribe to our daily letter</p>"
    rows = [(i, f"http://x.example/{i}", f"<article><h1>Title {i}</h1><p>Text number {i} of many</p><p>and more {i * 7}</p>{said}</article>") for i in range(8)]
    story = [f"part {k} of the story tells what happened on day {k * k} in town {k + 5}" for k in range(30)]
    for i in range(8):
        parts = [p.replace("town", f"village{i}") if k == 3 * i else p for k, p in enumerate(story)]
        rows.append((100 + i, f"http://y.example/{i}", "<article><h1>Story</h1><p>" + "</p><p>".join(parts) + "</p></article>"))
    got = {r["id"]: r["text"] for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title {i}\nText number {i} of many\nand more {i * 7}" for i in range(8))
    assert all(len(got[100 + i].split("\n")) == 31 and f"village{i} {3 * i + 5}" in got[100 + i] for i in range(8))


def test_names_and_raw_elements_keep_article_text():
    """Parts of class names, hints around the article, and elements without an end tag of their own hide no text."""
    text = lambda html: wrapper.main_text(wrapper.parse(html), set(), [], None)
    assert text("<div class='content with-sidebar'><p>a</p></div>") == "a"
    assert text("<main class='no-sidebar'><p>a</p></main>") == text("<div id='page' class='has-ads'><p>a</p></div>") == "a"
    assert text("<article><header class='entry-header'><h1>T</h1></header><div class='article-header'><h2>S</h2></div><p>a</p></article>") == "T\nS\na"
    assert text("<div class='sidebar'><article><p>a</p><div class='ad'>Buy</div></article></div>") == "a"
    assert text("<article><p>a</p></article><div id='comments'><article><p>reader</p></article></div>") == "a"
    assert text("<article><p>one <svg class=\"i\"/> two</p><p>three</p></article>") == "one two\nthree"
    assert text("<p>a</p><button-group>b</button-group><p>c</p>") == "a\nb\nc"
    assert text("<p>a <svg> b</p><p>c <svg><path></svg> d</p><button>e") == "a b\nc d\ne"
    assert text("<article><p>let <math><mi>x</mi></math> be</p><script>var a = '<p>no</p>'</script></article>") == "let x be"
    page = wrapper.parse("<div><p><a href='/'>all of it linked</a></p></div>")
    shape, where, _ = wrapper.outline(page)
    assert wrapper.main_text(page, set(), where, wrapper.align(shape, shape)) == "all of it linked"


def test_alignment_maximises_matches():
    """Simple tree matching against trying everything, on small random trees."""
    rng = random.Random(5)

    def tree(depth):
        return (rng.choice("ab"), tuple(tree(depth - 1) for _ in range(rng.randint(0, 3)) if depth))

    def text(t):
        return t[0] + (" ( " + " ".join(map(text, t[1])) + " )" if t[1] else "")

    def best(x, y):
        if x[0] != y[0]:
            return 0
        options = [0]
        for n in range(1, min(len(x[1]), len(y[1])) + 1):
            for p in itertools.combinations(x[1], n):
                for q in itertools.combinations(y[1], n):
                    options.append(sum(best(a, b) for a, b in zip(p, q)))
        return 1 + max(options)

    for _ in range(60):
        x, y = ("r", tree(2)[1]), ("r", tree(2)[1])
        assert sum(p >= 0 for p in wrapper.align(text(x), text(y))) == best(x, y)


def test_pages_given(spark):
    """The given pages mark their article: its blocks, read plainly, are the text."""
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["id"]: r["text"] for r in wrapper.extract(pages).collect()}
    for r in pages.collect():
        inner = r["html"].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


def test_lattice_points():
    roots = lattice.lattice_roots()
    assert roots.shape == (240, 8) and np.allclose((roots**2).sum(1), 2)
    x = np.random.default_rng(1).normal(size=(2000, 8)) * 2
    q = lattice.nearest_point(x)
    assert np.allclose((2 * q) % 1, 0) and np.allclose(q.sum(1) % 2, 0)
    d = ((x - q) ** 2).sum(1)
    assert d.max() <= 1 + 1e-9  # the covering radius
    assert all(d[i] <= ((x[i] - q[i] - roots) ** 2).sum(1).min() + 1e-9 for i in range(2000))


def test_recall_at_the_bound():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    hasher = lattice.Hasher(64, lattice.TABLES, lattice.BLOCKS, lattice.PROBES, lattice.SCALE)
    met = np.zeros(len(x), bool)
    for t in range(lattice.TABLES):
        (hx, px), (hy, py) = hasher.cells(x, t), hasher.cells(y, t)
        met |= (px == hy[:, None]).any(1) | (py == hx[:, None]).any(1)
    apart = np.bitwise_count((hasher.sketches(x) ^ hasher.sketches(y)).view(np.uint64)).sum(1)
    assert met.mean() >= 0.9995 and apart.max() <= lattice.SKETCH_BITS


def test_embeddings_awkward(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(3, 16))
    rows = [(i, (centre[i % 3] + rng.normal(size=16) * 0.05).tolist(), i % 3 if i % 7 else None) for i in range(60)]
    same = rows[1][1]
    rows += [(100, same, 1), (101, same, 1), (101, same, 1), (102, [2 * v for v in same], 1), (None, same, 1), (103, same, 2)]
    rows += [(200, None, 1), (201, [], 1), (202, [0.0] * 16, 1), (203, [None] * 16, 1), (204, [float("nan")] * 16, 1),
             (205, [float("inf")] + [1.0] * 15, 1), (206, same[:8], 1), (207, [1e300] * 16, 0), (208, [1e-300] * 16, 0)]
    schema = "vec_id long, embedding array<double>, label int, cid string, v string, kind string, n string"
    frame = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema)
    got = lattice.near_copies(frame).collect()

    def unit(v):
        if not v or any(e is None or not np.isfinite(e) for e in v) or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v, _ in rows]
    label = np.arange(len(rows))
    links = np.zeros(len(rows), int)
    for i, j in itertools.combinations(range(len(rows)), 2):
        if units[i] is not None and units[j] is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]):
            if units[i] @ units[j] >= 0.93:
                links[[i, j]] += 1
                label = simhash.merge_labels(label, np.array([i]), np.array([j]))
    want = []
    for i, (vid, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(label == label[i]) if rows[j][0] is not None]
        want.append((vid, int(links[i]), min(ids) if ids else None))
    assert sorted(map(str, want)) == sorted(map(str, [(r["id"], r["n_links"], r["component"]) for r in got]))
    assert all(r["kept"] == (r["id"] == r["component"]) for r in got)
    assert lattice.near_copies(frame.limit(0)).count() == 0


def test_pipeline_stages(spark):
    """Every stage against its own input, decided again without joins."""
    from tests.llm.test_text_operators import plain_contamination, plain_fingerprint, plain_groups

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for (name, stage), check in zip(corpus_pipeline.STAGES, ("toxic", "quality", "copies", "benchmark", "packed")):
        out = stage(spark, docs, SF).persist()
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if check == "packed":
            assert {r["doc_id"] for r in out.collect()} == set(before)
            break
        after = {r["doc_id"]: tuple(r) for r in out.collect()}
        assert out.columns == corpus_pipeline.COLUMNS and all(after[i][1] == before[i] for i in after)
        gone = set(before) - set(after)
        if check in ("toxic", "quality"):
            marks = {r["doc_id"]: r[check] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            good = [i for i in before if marks.get(i) == (check == "quality")]
            assert np.mean([i in after for i in good]) > 0.97
            assert gone and np.mean([(i in after) == (marks[i] == (check == "quality")) for i in before if i in marks]) > 0.93
        elif check == "copies":
            ids = sorted(before)
            label = plain_groups([plain_fingerprint(before[i]) for i in ids], 3)
            assert set(after) == {ids[x] for x in set(label)}
        else:
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == {i for i, _, hit, _ in plain_contamination(list(before.items()), items) if not hit}
        docs = out


def test_pipeline_awkward(docs, none, spark, tmp_path):
    """Null and repeated ids, empty and long texts pass every stage; so does an empty table."""
    clean = [(i, 1, 0) for i in (1, 8, 10, 11, 13)]
    spark.createDataFrame(clean, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "dog near the river")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (docs, none):
        rows = start.select(*corpus_pipeline.COLUMNS)
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, str(tmp_path))
            rows = spark.createDataFrame(rows.collect(), rows.schema)
        assert (rows.count() > 0) == (start is docs)
    assert packing.pack(none).columns == ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert postings.SMALL_ROWS > 0


def test_headings_of_sections_stay_and_notices_go(spark):
    """Every recipe has the same headings; a notice stands at the end of all articles, a linked one in their midst."""
    words = lambda i, part: " ".join(f"{part}{i}x{k}" for k in range(30))
    page = lambda i: (
        f"<html><body><article><p>Sponsored recipe</p><h1>Dish {i}</h1><h2>Ingredients</h2><ul><li>{words(i, 'a')}</li></ul>"
        f"<p><a href='/s'>Subscribe to our letter</a></p><h2>Method</h2><p>{words(i, 'b')}</p><h2>More</h2><p>All our recipes are tested.</p></article></body></html>"
    )
    rows = [(i, f"https://cook.example/{i}", page(i)) for i in range(8)]
    got = {r["id"]: r["text"] for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Dish {i}\nIngredients\n{words(i, 'a')}\nMethod\n{words(i, 'b')}" for i in range(8)}


def test_pages_without_any_mark(spark):
    """With marks made plain boxes and names removed, aligned slots alone find nearly the same blocks."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    boxes = F.regexp_replace("html", r"(?i)<(/?)(article|main|header|footer|nav|aside|form|section|menu)\b[^>]*>", "<$1div>")
    bare = F.regexp_replace(boxes, r"""(?i)\s(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "")
    want, got = ({r["id"]: r["text"] for r in wrapper.extract(p).collect()} for p in (pages, pages.withColumn("html", bare)))
    same = extra = lost = 0
    for i, text in want.items():
        a, b = (Counter(t.split("\n")) if t else Counter() for t in (text, got[i]))
        same, extra, lost = same + (a & b).total(), extra + (b - a).total(), lost + (a - b).total()
    assert same / (same + extra) >= 0.95 and same / (same + lost) >= 0.98


def test_labelled_sample_is_bounded(spark):
    """One id with most rows is one row of the sample; ids that no document has take no place in it."""
    docs = spark.createDataFrame([(7, f"text {i}") for i in range(300)] + [(i, f"own {i}") for i in range(100, 140)] + [(None, "x"), (8, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in [7, 8, *range(100, 2000)]] + [(7, 1), (None, 1), (101, None)], "doc_id long, quality int")
    take = lambda n: models.labelled(docs, labels, "quality", F.lit(False), "doc_id", "text", n).collect()
    rows = take(1000)
    assert sorted(r["id"] for r in rows) == [7, 8, *range(100, 140)] and len(take(10)) == 10
    assert {r["id"]: r["y"] for r in rows}[7] == 1 and {r["id"]: r["text"] for r in rows}[8] is None
    assert sorted(map(tuple, take(10))) == sorted(map(tuple, take(10)))
