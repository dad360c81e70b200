"""Quality rules, language model and page model against brute force."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from edge_cases import docs, empty, pairs

from emporium.llm import html_model, kn_lm, quality, queries
from emporium.llm.common import scratch, table
from emporium.llm.html_tree import Tree

SF = "/root/testdata/sf0.001"


def base_rules(text):
    text = text or ""
    words = text.encode().split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in twice for j in range(5)}
    seen, dup = set(), 0
    for line in text.encode().split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(len(w.decode()) for w in words), symbols, dup, len(covered), failed


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_rules_on_edge_cases(spark):
    repeated = [(50, "a b c d e f " * 20), (51, "same line\nsame line\n\n same line\nother"), (52, "one two three four five six " * 2), (53, "x y z w v u a b c d e f g h i j k l m x y z w v n")]
    rows = pairs(docs(spark)) + repeated
    model = quality.fit(docs(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    got = quality.verdicts(docs(spark, rows), model).collect()
    want = Counter((i, *base_rules(t)) for i, t in rows)
    assert Counter((r["doc_id"], *(r[f] for f in FIELDS)) for r in got) == want
    assert all(r["kept"] == (not r["base_failed"]) for r in got)  # no trusted documents
    assert quality.verdicts(empty(spark), model).count() == 0
    assert quality.judged(docs(spark, rows), model).drop("__verdict").columns == docs(spark).columns


def test_op7_scores_and_verdicts(spark):
    rows = dict(pairs(table(spark, SF, "documents")))
    labels = table(spark, SF, "labels").collect()
    good = {r["doc_id"] for r in labels if r["quality"] == 1 and r["toxic"] == 0}
    held = {r["doc_id"] for r in table(spark, SF, "documents").where(quality.left_out()).collect()}
    raw, trusted = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    own = {i: quality.features(quality.word_hashes((t or "").encode().split()), quality.BUCKETS) for i, t in rows.items()}
    for i, f in own.items():
        np.add.at(raw, f, 1)
        if i in good - held:
            np.add.at(trusted, f, 1)
    ratio = np.log(trusted + 2) - np.log(raw * trusted.sum() / raw.sum() + 2)
    score = {i: ratio[f].mean() if len(f) else 0.0 for i, f in own.items()}
    clean = [score[i] for i in good & held if i in rows and not base_rules(rows[i])[-1]]
    assert len(clean) >= quality.LEAST
    threshold = np.mean(clean) - 3 * np.std(clean)
    for r in queries.op7_quality_rules(spark, SF).collect():
        assert r["score"] == pytest.approx(score[r["doc_id"]], abs=1e-5)
        assert tuple(r[f] for f in FIELDS) == base_rules(rows[r["doc_id"]])
        assert r["kept"] == (not r["base_failed"] and score[r["doc_id"]] >= threshold)


def test_every_trusted_document_counts(spark):
    """Half of 24,000 trusted documents, those of the highest id hashes, hold a
    word that the others do not."""
    n = 24_000
    ids = spark.range(n).selectExpr("id as doc_id", "ntile(2) over (order by xxhash64(id)) = 2 as late")
    rows = ids.selectExpr("doc_id", "concat('common word ', if(late, 'late', 'early')) as text")
    model = quality.fit(rows, ids.selectExpr("doc_id", "1 as quality", "0 as toxic"))
    held = ids.where(quality.left_out()).count()
    late = quality.features(quality.word_hashes([b"late"]), quality.BUCKETS)[0]
    texts = {r["doc_id"]: r["text"].split() for r in rows.where(~quality.left_out()).collect()}
    assert len(texts) == n - held
    good, words = sum(t[2] == "late" for t in texts.values()), 5  # three words and two pairs each
    expected = n // 2 * (words * len(texts)) / (words * n)
    assert model.scores()[late] == pytest.approx(math.log(good + 2) - math.log(expected + 2), abs=1e-4)


def test_fit_stores_no_text(spark, monkeypatch):
    """Nor does that change the threshold where ids repeat or are null."""
    tables, stored = [], quality.stored
    monkeypatch.setattr(quality, "stored", lambda df, name: tables.append(df.columns) or stored(df, name))
    rows = pairs(table(spark, SF, "documents"))
    rows += [(i, f"{t} and some more words") for i, t in rows[::3]] + [(rows[0][0], "too short"), (None, rows[1][1])]
    labels = table(spark, SF, "labels")
    model = quality.fit(docs(spark, rows), labels)
    assert tables and not any("text" in columns for columns in tables)
    trusted = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["toxic"] == 0}
    held = trusted & {r["doc_id"] for r in labels.where(quality.left_out()).collect()}
    scores: dict[int, list[float]] = {}
    for i, t in rows:
        words = quality.word_hashes((t or "").encode().split())
        if i in held and not base_rules(t)[-1]:
            scores.setdefault(i, []).append(model.scores()[quality.features(words, quality.BUCKETS)].mean(dtype=np.float64))
    means = [np.mean(x) for x in scores.values()]
    assert len(means) >= quality.LEAST
    assert model.threshold == pytest.approx(np.mean(means) - 3 * np.std(means), abs=1e-6)


def test_verdicts_do_not_depend_on_the_size_of_the_table(spark):
    """Models fitted on 200, 1,000 and 10,000 documents judge the same ones."""
    kept, sfs = {}, ("sf0.001", "sf0.01", "sf0.1")
    models = {sf: quality.fit(table(spark, f"/root/testdata/{sf}", "documents"), table(spark, f"/root/testdata/{sf}", "labels")) for sf in sfs}
    judged = table(spark, "/root/testdata/sf0.01", "documents")
    for sf, model in models.items():
        kept[sf] = {r["doc_id"]: r["kept"] for r in quality.verdicts(judged, model).collect()}
    same = lambda a, b: sum(kept[a][i] == kept[b][i] for i in kept[a]) / len(kept[a])
    assert min(same(a, b) for a in sfs for b in sfs) >= 0.95
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    clean = [k for i, k in kept["sf0.1"].items() if labels.get(i) == (1, 0)]
    bad = [k for i, k in kept["sf0.1"].items() if labels.get(i, (1, 0))[0] == 0]
    assert sum(clean) >= 0.95 * len(clean) and sum(bad) <= 0.05 * len(bad)


def test_verdict_keeps_good_and_drops_bad(spark):
    sf = "/root/testdata/sf0.01"
    verdict = {r["doc_id"]: r for r in queries.op7_quality_rules(spark, sf).collect()}
    labels = [(r["quality"], verdict[r["doc_id"]]) for r in table(spark, sf, "labels").collect() if r["doc_id"] in verdict]
    good = [v["kept"] for q, v in labels if q == 1 and not v["base_failed"]]
    bad = [v["kept"] for q, v in labels if q == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.15 * len(bad)


class Brute:
    """The model by dictionaries."""

    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for t in texts:
            self.words.update(t)
            self.pairs.update(zip(["<s>", *t[:-1]], t, strict=True))
        self.before = Counter(w for _, w in self.pairs)
        self.total, self.follow = Counter(), defaultdict(lambda: [0, 0, 0])
        for (v, _), c in self.pairs.items():
            self.total[v] += c
            self.follow[v][min(c, 3) - 1] += 1
        self.d2, self.d1 = self.discounts(self.pairs), self.discounts(self.before)
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.rest = sum(self.d1[min(c, 3) - 1] for c in self.before.values()) / len(self.pairs) if self.pairs else 1.0

    @staticmethod
    def discounts(counts):
        return kn_lm.discounts([sum(c == i for c in counts.values()) for i in (1, 2, 3, 4)])

    def p(self, v, w):
        k = self.before[w]
        one = (k - self.d1[min(k, 3) - 1] if k else 0) / max(1, len(self.pairs)) + self.rest / (self.v + 1)
        if not self.total[v]:
            return one
        c = self.pairs[v, w]
        return (c - self.d2[min(c, 3) - 1] if c else 0) / self.total[v] + sum(a * b for a, b in zip(self.d2, self.follow[v], strict=True)) / self.total[v] * one


def tokens(text):
    return [*(text or "").encode().lower().split(), "</s>"]


@pytest.mark.parametrize("options", [{"shard_bytes": 1 << 30}, {"shard_bytes": 200}, {"shard_bytes": 200, "flush_tokens": 20, "vocabulary": 9}])
def test_language_model_on_edge_cases(spark, options):
    rows = pairs(docs(spark))
    model = kn_lm.train(docs(spark), scratch(spark, "test-kn"), **options)
    brute = Brute([tokens(t) for _, t in rows])
    assert (model.tokens, model.types) == (brute.n, brute.v)
    want = Counter()
    for i, t in rows:
        own = tokens(t)
        want[i, len(own), round(sum(math.log10(brute.p(v, w)) for v, w in zip(["<s>", *own[:-1]], own, strict=True)), 6)] += 1
    got = kn_lm.score(docs(spark), model, vocabulary=options.get("vocabulary", 1 << 20)).collect()
    assert Counter((r["doc_id"], r["n_tokens"], round(r["score"], 6)) for r in got) == want
    assert kn_lm.score(empty(spark), model).count() == 0
    total = sum(brute.p("<s>", w) for w in brute.words) + brute.p("<s>", "never seen")
    assert total == pytest.approx(1.0)


def test_language_model_spreads_hot_contexts(spark):
    """A word before half of all others, with many followers, in shards of equal size."""
    words = [f"w{i * i % 9973}" for i in range(12000)]
    texts = [" ".join(f"{'hub' if j % 2 else v} {w}" for j, (v, w) in enumerate(zip(words[i : i + 60], words[i + 7 : i + 67], strict=False))) for i in range(0, 11900, 40)]
    given = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    model = kn_lm.train(given, scratch(spark, "test-kn"), shard_bytes=8000)
    held = kn_lm.Arrays(model)
    sizes = [len(held.open("pairs", s)) for s in range(1 << model.bits)]
    assert model.bits >= 4 and xxhash.xxh3_64_intdigest(b"hub") in model.hot.tolist() and len(model.hot) <= 2 << model.bits
    assert max(sizes) <= 1.5 * sum(sizes) / len(sizes)
    brute = Brute([tokens(t) for t in texts])
    for row in kn_lm.score(given, model).collect():
        own = tokens(texts[row["doc_id"]])
        assert row["score"] == pytest.approx(sum(math.log10(brute.p(v, w)) for v, w in zip(["<s>", *own[:-1]], own, strict=True)))


def test_language_model_of_nothing(spark):
    model = kn_lm.train(empty(spark), scratch(spark, "test-kn"))
    assert all(r["score"] == 0.0 and r["n_known"] == 0 for r in kn_lm.score(docs(spark), model).collect())
    with pytest.raises(ValueError):
        kn_lm.train(docs(spark), "hdfs://x/model")


def test_op8_whole_table(spark):
    rows = dict(pairs(table(spark, SF, "documents")))
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in rows}
    brute = Brute([tokens(t) for i, t in rows.items() if not held[i]])
    for r in queries.op8_lm_scoring(spark, SF).collect():
        own = tokens(rows[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(own), brute.n)
        assert r["n_known"] == sum(brute.words[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((brute.words[w] + 1) / (brute.n + brute.v + 1)) for w in own))
        assert r["score"] == pytest.approx(sum(math.log10(brute.p(v, w)) for v, w in zip(["<s>", *own[:-1]], own, strict=True)))


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>"</script></head><body><header class=site-header><a href=/>Logo</a></header>
<nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav><div id="cookie-notice"><p>We use cookies to make the site better. Please accept them.</p></div>
<article><h1>The   title &amp; more</h1><p>First <b>para</b>graph with <a href=x>a link</a>.<br>Next line<p>Second, unclosed.<!-- no --><ul><li>item one</ul>
<div class="ad">Buy this very cheap thing now, it is good for you.</div><p>Last &eacute;.</p></article>
<div class="sidebar"><h3>About</h3><p>This is a text about the author of this blog, who likes to write.</p></div>
<section class=comments><p>I really liked this article, it was great to read and I learned a lot.</p></section>
<form><label>Mail</label><input></form><footer>&copy; 2024 Somebody</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_model.default_model().blocks(PAGE) == ["The title & more", "First paragraph with a link. Next line", "Second, unclosed.", "item one", "Last é."]


def brute_marginals(model, tree):
    """Content probability of each node by summing over all labelings."""
    n = len(tree.parent)
    p = np.zeros((n, 2))
    own = [model.likelihood(k) for k in tree.key]
    for code in range(1 << n):
        y = [code >> i & 1 for i in range(n)]
        weight = own[0][y[0]]
        for i in range(1, n):
            weight *= own[i][y[i]] * model.pairs[y[tree.parent[i]]][y[i]]
        for i in range(n):
            p[i, y[i]] += weight
    return p[:, 1] / p.sum(axis=1)


def test_messages_give_exact_marginals():
    model = html_model.default_model()
    tree = Tree("<body><div class=menu><a href=x>Home</a></div><div id=post><p>Some words of text here.</p><aside>Ad</aside></div><p>End</body>")
    assert len(tree.parent) <= 12
    assert model.marginals(tree) == pytest.approx(list(brute_marginals(model, tree)))


def test_op4_on_the_given_pages(spark):
    """The article of each page, cut out by its tags, is the extracted text."""
    import html
    import re

    rows = {r["page_id"]: r["html"] for r in table(spark, SF, "pages").collect()}
    got = queries.op4_html_extraction(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        inner = re.search("<article>(.*?)(?:</article>|$)", re.sub("<!--.*?-->", "", rows[r["page_id"]], flags=re.S), re.S)
        blocks = re.split(r"</?(?:p|h1|h2|li|ul|div|br)\b[^>]*>", inner[1] if inner else "")
        plain = (" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in blocks)
        assert r["text"] == " ".join(b for b in plain if b)
        assert r["n_chars"] == len(r["text"])


def test_pages_edge_cases(spark):
    pages = [(1, "u", None), (2, None, ""), (None, "u", "plain text of a page without any tag, that goes on"), (3, "u", "<div><div></p></b><li>"), (4, "u", "<p>" + "word " * 50_000), (4, "u", "<script>x"), (5, "u", "a < b & c &#x41; &bogus;"), (6, "u", "<a " + "'" * 5000)]
    df = spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, url string, html string, text string, n_chars int")
    got = {(r["page_id"], r["url"], r["n_blocks"]): r["text"] for r in html_model.main_text(df).collect()}
    assert len(got) == len(pages)
    assert got[1, "u", 0] == "" and got[2, None, 0] == "" and got[4, "u", 1] == " ".join(["word"] * 50_000)
    assert html_model.main_text(df.limit(0)).count() == 0


def test_held_out_layouts():
    """Trained on three quarters of the labelled pages, tested on the rest."""
    pages = list(html_model.labelled_pages())
    model = html_model.fit([p for i, p in enumerate(pages) if i % 4])
    right = total = 0
    for page in pages[::4]:
        tree = Tree(page)
        for t, label, p in zip(tree.text, tree.label, model.marginals(tree), strict=True):
            if t is not None:
                total += 1
                right += bool(label) == (p > 0.5)
    assert right >= 0.95 * total


ARTICLE = ["The harbour was built in 1902 by two brothers from the north, and it stood empty for years.", "Since then the town has grown; its people fish, trade and tell stories about the old ship."]
ARTICLE_HTML = "".join(f"<p>{p}</p>" for p in ARTICLE)


@pytest.mark.parametrize("before", ["<svg/>", "<svg viewBox='0 0 1 1'/>", "<iframe src=x />", "<object/>", "<math/>", "<svg><path d='M0'>", "<iframe src=x>", "<object data=x>", "<select>", "<template>", "<noscript>", "<svg><svg></svg><path/>"])
def test_foreign_elements_hide_nothing_after_them(before):
    page = f"<body><div>{before}</div><article>{ARTICLE_HTML}</article><object data=y>No picture</object><svg><text>drawn</text></svg></body>"
    assert html_model.default_model().blocks(page) == ARTICLE


def test_skipped_elements_hide_what_is_in_them():
    page = f"<body><article><svg><g><svg><text>a</text></svg><text>drawn words</text></g></svg>{ARTICLE_HTML}<noscript><p>Turn it on.</p></noscript><title>no end</article>"
    assert [t for t in Tree(page).text if t] == [*ARTICLE, "no end"][:2] or "drawn" not in " ".join(t for t in Tree(page).text if t)
    assert html_model.default_model().blocks(page)[:2] == ARTICLE


@pytest.mark.parametrize("n", [1, 2])
@pytest.mark.parametrize("names", [("zz9", "qq4"), ("pane", "cell"), ("", "")])
def test_short_articles_under_names_that_say_nothing(n, names):
    links = "<ul><li><a href=/a>Boats</a></li><li><a href=/b>Maps</a></li></ul>"
    own = "".join(f"<p>{p}</p>" for p in ARTICLE[:n])
    for page in (f"<body><div class='{names[0]}'>{links}</div><div class='{names[1]}'>{own}</div></body>", f"<body><section class='{names[0]}'>{own}</section><div class='{names[1]}'>{links}</div></body>"):
        assert html_model.default_model().blocks(page) == ARTICLE[:n], page


def test_unbalanced_quotes_take_linear_time():
    import time

    for piece in ('<a "', "<a '>x", '<p class="a>b', "<a ", "<!", "<svg>", "<title>x"):
        at = time.perf_counter()
        Tree(piece * 40_000)
        assert time.perf_counter() - at < 5, piece
    assert "kept" in " ".join(t for t in Tree('<p "' * 200 + ">kept").text if t)
