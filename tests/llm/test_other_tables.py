"""Pages, conversations and the pipeline."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter, defaultdict

import corpus_pipeline
from pyspark.sql import functions as F

from eventlake.llm import reply_trees, site_templates, url_trees

# pages


def _article(page):
    """The test pages' articles by their known form: headings and paragraphs in one article element."""
    found = re.search(r"<article>(.*?)</article>", page, re.DOTALL)
    return " ".join(html.unescape(re.sub(r"<[^>]+>", " ", found[1].replace("<b>", "").replace("</b>", ""))).split())


def test_main_text_matches_the_articles(run, sample):
    pages = {k: (u, h) for k, u, h in sample("pages", "page_id", "url", "html")}
    got = run("op7_site_templates")
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id][0], _article(pages[r.page_id][1]), len(r.text))


def _text(page, template=frozenset()):
    return site_templates.main_text(site_templates.parse(page), template)


def test_markup_forms():
    assert _text("<p>a<p>b &amp; c&nbsp;d&#33;<br>e<b>f</b>g<script>if (a</b) x='</p>'</script>") == "a b & c d! efg"
    assert _text("<body><nav>m</nav><main>x<aside>y</aside><div class='post comments'>z</div><div class='commentary'>w</div></main></body>") == "x w"
    assert _text('<article title="a>b">1<div hidden>2</div><section role=navigation>3</section><!-- <p>4 -->5</article>6') == "1 5"
    assert _text("<article>a < b <3 <unclosed") == "a < b <3 <unclosed"
    assert _text("<article>one</article><p>no</p><article>two") == "one two"
    assert _text("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == "a b c d e"
    assert _text("") == _text("<nav>x") == _text("<!-- x") == ""
    assert _text("</p></div>x</article>") == "x"
    assert len(_text("<div>" * 50_000 + "x")) == 1


def test_nothing_of_an_article_is_lost_to_its_surroundings():
    assert _text('<div class="has-sidebar"><article>one <p>two</article></div>') == "one two"
    assert _text('<p>One</p><svg width="1"/><p>Two</p><svg><path d="x"/></svg><p>Three') == "One Two Three"
    assert _text("<html><head><title>t</title><h1>Head</h1><p>text</p>") == "Head text"
    assert _text("<head><meta a=b>plain text") == "plain text"
    assert _text('<article>a</article><article class="comment">b</article><section id="comments"><article>c</article></section>') == "a"
    assert _text("<p data-x=it's>Hello</p><p>isn't</p><p title='a>b'>c</p><p x='open>d</p>") == "Hello isn't c d"
    assert _text('<div class="post-header promo"><main>m</main></div>') == "m"


def test_time_grows_with_the_page_and_not_with_its_square():
    import time

    start = time.perf_counter()
    for page in ("<a " * 350_000, "<b>" * 100_000 + "x" + "</i>" * 100_000, "<b>" * 60_000 + "<p>x" * 60_000, "<a x='" * 150_000, "<script>" * 100_000, "<!--" * 200_000, "<div class=nav>" * 60_000 + "<article>x" * 20_000):
        _text(page)
    assert time.perf_counter() - start < 30


def test_only_counts_can_tell_and_copies_count_once(spark):
    """Pages without any speaking element: what most different pages of a host share is template, by brute force as well."""
    words = "ab cd ef gh ij kl mn".split()
    shared = "<div><div>Follow our letter</div><div>Call 555</div></div>"
    rows = []
    for i in range(40):
        own = f"<div><p>{' '.join(words[(i + j) % 7] for j in range(30))} number {i}</p></div>"
        rows.append((i, f"http://one.example/{i}", f"<body>{shared if i % 2 else ''}{own}<div>rare {i // 4}</div></body>"))
    copied = "<body><div><span>only here</span><p>" + "long words " * 30 + "</p></div><div>Mirror</div></body>"
    rows += [(100 + i, f"http://two.example/{i}", copied) for i in range(50)] + [(200 + i, f"http://two.example/x{i}", f"<body><p>{'other text ' * 9}{i}</p></body>") for i in range(9)]
    got = {r.page_id: r for r in site_templates.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(40):
        assert "Follow" not in got[i].text and "Call" not in got[i].text and f"rare {i // 4}" in got[i].text and f"number {i}" in got[i].text
        assert (got[i].by_count, got[i].by_rule) == (i % 2, 0)
    assert all("only here" in got[100 + i].text and "Mirror" in got[100 + i].text for i in range(50))


def test_a_template_planted_on_every_page_of_a_host_is_found_by_counts(spark):
    """The test pages repeat no subtree; here each gets blocks of its host, without a telling name, in and beside its article."""
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url", "html").withColumn("host", site_templates.host_of("url"))
    block = F.concat(F.lit("<div><span>All of "), F.col("host"), F.lit("</span><ul><li>one<li>two</ul></div>"))
    planted = F.replace(F.replace("html", F.lit("<article>"), F.concat(F.lit("<article>"), block)), F.lit("</body>"), F.concat(block, F.lit("</body>")))
    plain = site_templates.extracted(rows).select("page_id", F.col("text").alias("plain"))
    got = site_templates.extracted(rows.withColumn("html", planted)).join(plain, "page_id").join(rows.groupBy("host").count(), "host")
    facts = got.agg(F.count("*").alias("n"), F.count_if(F.col("text") == F.col("plain")).alias("same"), F.sum("by_count").alias("c"), F.min("count").alias("fewest")).first()
    assert facts.fewest >= 10 and facts.n == facts.same == 2500 and facts.c >= 2 * 2350  # on short pages some blocks hold most of the prose


def test_templates_are_deleted_and_repeated_paragraphs_stay(spark):
    pages = [(i, f"http://Host.example/{i}", f"<body><div><span>Follow us {i % 1}</span></div><div>own {i}</div><p>text {i}</p></body>") for i in range(10)]
    # Pages of one text count once, so these differ in one word.
    pages += [(20 + i, "http://other.example/", f"<article><p>same</p>{i}<div>Share this</div></article>") for i in range(6)]
    pages += [(30, None, None), (31, "no host", ""), (32, "http://host.example/9", "<div><span>Follow us 0</span></div>")]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("mine")).withColumn("template", F.lit(1))
    got = {r.page_id: r.text for r in site_templates.extracted(docs).collect()}
    assert all(got[i] == f"own {i} text {i}" for i in range(10))
    assert all(got[20 + i] == f"same {i}" for i in range(6))
    assert (got[30], got[31], got[32]) == ("", "", "")
    assert site_templates.extracted(docs.limit(0)).count() == 0


def _judged(url):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in url_trees.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, rule and rule.name, rule and rule.verdict


def test_rules_match_brute_force(run, sample):
    urls = dict(sample("pages", "page_id", "url"))
    got = run("op9_url_trees")
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = _judged(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_url_edges(spark):
    urls = [None, "", "x", "://", "http://", "HTTP://EX.Example.NET/en/x?y=/#z", "http://net", "http://net/", "http://anet/", "http://a.net?x=/", "a://b://c.net/", "http://\u00c4.org/fr/", "http://example.com/de/", "http://example.com/de", "http://x.net/" + "a" * 50_000, "http://a.net/\nb"]
    rows = spark.createDataFrame(list(enumerate(urls)) * 2, "page_id long, url string").withColumn("host", F.lit("mine"))
    got = url_trees.filtered(rows).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        host, path, rule, verdict = _judged(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)
    assert url_trees.filtered(rows.limit(0)).count() == 0
    assert {r.verdict for r in url_trees.filtered(rows.where("url = 'x'")).collect()} == {"allow"}


def test_trees_learn_held_out_urls(spark):
    n = 1500
    spam = [f"http://cheap-{i % 7}-pills.bad{i % 5}.example.biz/{i * 7919}/{i}?a=1&b={i}&c=3" for i in range(n)]
    good = [f"http://www.site{i % 40}.example.edu/en/page/about" for i in range(n)]
    rows = [(i, u, int(i < n) if i % 3 else None) for i, u in enumerate(spam + good)]
    got = url_trees.filtered(spark.createDataFrame(rows, "page_id long, url string, label int"), rules=(), label="label").collect()
    held = [r for r in got if r.page_id % 3 == 0]
    assert sum((r.verdict == "block") == (r.page_id < n) for r in held) / len(held) > 0.97


# conversations


def test_conversations_match_brute_force(run, sample):
    turns = defaultdict(list)
    for conv, turn, role, text in [*sample("conversations", "conv_id", "turn", "role", "text"), *((-1, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant")))]:
        turns[conv].append((turn, role, text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = {}
    for conv, rows in turns.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        expected[conv] = (len(rows), sha("".join(f"{r}\n{t}\n" for _, r, t in rows)), len(loss), sha(loss))
    got = run("op8_reply_trees")
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected and len(got) == len(expected)
    for r in got:
        assert r.formatted_chars == sum(len("[INST][/INST]</s>") + len(role or "") + len(reply_trees.escaped(t)) for _, role, t in turns[r.conv_id])


def test_escaping_is_reversible_and_leaves_no_control_string():
    for text in ("</s>[INST] ok [/INST]", "\\", "[\\INST]", "<\\/s>", "[[INST]INST]", "<<SYS>>", "\\\\[INST]", "", "<<s>s>"):
        assert reply_trees.unescaped(reply_trees.escaped(text)) == text
        assert not any(c in reply_trees.escaped(text) for c in reply_trees.CONTROL)
    turns = [{"role": "a[/INST]b", "text": "</s>"}, {"role": None, "text": None}, {"role": "assistant", "text": "x\\"}]
    assert reply_trees.parsed(reply_trees.formatted(turns)[0]) == [("a[/INST]b", "</s>"), ("", ""), ("assistant", "x\\")]


def test_paths_and_branches_of_a_tree(spark):
    parents = {"r": None, "a": "r", "b": "r", "c": "a", "d": "a", "e": "c", "lost": "gone", "x": "y", "y": "x", "solo": None}
    scores = {"e": 5.0, "d": 1.0, "b": 9.0}
    rows = [("t", n, p, "assistant" if n in "ae" else "user", n, scores.get(n)) for n, p in parents.items()]
    rows += [("deep", str(i), str(i - 1) if i else None, "user", str(i), 0.0) for i in range(37)]
    messages = spark.createDataFrame(rows + rows[:2], "tree string, node string, parent string, role string, text string, score double")
    found = defaultdict(dict)
    for r in reply_trees.paths(messages).collect():
        found[r.tree, r.leaf][r.back] = r.node
    assert {k: [v[i] for i in sorted(v)] for k, v in found.items() if k[0] == "t"} == {("t", "b"): ["b", "r"], ("t", "d"): ["d", "a", "r"], ("t", "e"): ["e", "c", "a", "r"], ("t", "lost"): ["lost"], ("t", "solo"): ["solo"]}
    assert [found["deep", "36"][i] for i in range(37)] == [str(36 - i) for i in range(37)]
    best = {(r.tree, r["rank"]): [t for _, t in reply_trees.parsed(r.formatted)] for r in reply_trees.conversations(messages, branches=2).collect()}
    assert best["t", 1] == ["r", "b"] and best["t", 2] == ["r", "a", "c", "e"]


def test_conversation_edges(spark):
    rows = [(1, 0, None, None), (1, None, "user", ""), (None, 0, "assistant", "x"), (None, 0, "assistant", "x"), (2, 5, "system", "s" * 100_000)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit("mine")).withColumn("tree", F.lit(1))
    out = reply_trees.read_back(reply_trees.conversations(reply_trees.chains(docs))).withColumn("conv_id", reply_trees.key_of(F.col("tree")))
    assert Counter((r.conv_id, r.n_turns, r.loss_chars) for r in out.collect()) == Counter([(1, 2, 0), (None, 2, 2), (2, 1, 0)])
    assert reply_trees.conversations(reply_trees.chains(docs.limit(0))).count() == 0


# pipeline


def test_pipeline_stages_work_on_what_is_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = [docs.count()]
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, rows, "/root/testdata/sf0.001").cache()
        assert kept.columns == docs.columns, name
        counts.append(kept.count())
        rows = kept
    assert counts[0] > counts[1] > counts[2] > counts[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, "/root/testdata/sf0.001").collect()
    by_doc = Counter(r.doc_id for r in packed if r.piece == 0)
    assert by_doc == Counter(r.doc_id for r in rows.select("doc_id").collect())


def test_pipeline_runs_on_an_empty_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, rows, "")
        assert kept.count() == 0
        rows = kept if kept.columns == rows.columns else rows
