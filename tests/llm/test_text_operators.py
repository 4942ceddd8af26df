"""Near copies, fingerprints, rules and page text against brute force and literal expectations."""

import hashlib
import html
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import fingerprint, jaccard, queries, rules, wrapper
from postlens.session import BATCH
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, node bigint, n bigint, shingle bigint, range int, host string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, 1, 1, 1, "h") for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_as_sql(spark, name):
    assert difference(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLE[name]) is None


# --- near copies ---------------------------------------------------------------------------------


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} - {()}
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def expected_components(rows):
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, one in enumerate(sets):
        for j in range(k):
            if one and sets[j] and 100 * len(one & sets[j]) >= 75 * len(one | sets[j]):
                parent[find(k)] = find(j)
    least = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            least[find(k)] = min(least.get(find(k), row[0]), row[0])
    return Counter((r[0], len(sets[k]), least.get(find(k)) if sets[k] else r[0]) for k, r in enumerate(rows))


def got_components(df):
    return Counter(map(tuple, jaccard.jaccard_components(df).collect()))


def planted(seed, groups=25):
    """Groups of edited copies around the border of similarity, common passages, and short texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    passage = rng.choices(words, k=60)
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.choice([6, 20, 60, 200]))
        for _ in range(rng.randint(1, 9)):
            copy = base[:]
            for _ in range(rng.randint(0, 1 + len(base) // 40)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.3:
                copy = copy[: len(copy) - len(copy) // 10]
            if rng.random() < 0.3:
                copy = copy + passage
            rows.append(" ".join(copy))
    rows += rows[:10] + ["one two", "One  two", "one two three", "", None, " \n\t", "a b c d e", "A B C D E"]
    rng.shuffle(rows)
    ids = rng.sample(range(10000), len(rows))
    return [(i, t, "s") for i, t in zip(ids, rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    if seed == 2:  # blocks of many chunks
        monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 200)
    rows = planted(seed)
    assert got_components(frame(spark, rows)) == expected_components(rows)


def test_sieve_has_its_first_place(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SIEVE_BITS", 2)
    rows = planted(3, groups=8)
    assert got_components(frame(spark, rows)) == expected_components(rows)


def expected_links(rows):
    sets = [shingle_set(r[1]) for r in rows]
    linked = lambda one, other: one and other and 100 * len(one & other) >= 75 * len(one | other)
    return Counter(
        (r[0], sum(bool(linked(own, other)) for j, other in enumerate(sets) if j != k)) for k, (r, own) in enumerate(zip(rows, sets))
    )


def got_links(df):
    return Counter((r.doc_id, r.n_links) for r in jaccard.jaccard_links(df).collect())


@pytest.mark.parametrize("chunks", [False, True])
def test_all_links_are_counted(spark, chunks, monkeypatch):
    """A group of near copies has links between all of them, not only those that join it."""
    if chunks:
        for name, value in (("COUNTED_NODES", 7), ("TILE_NODES", 3), ("TILE_SHINGLES", 16)):
            monkeypatch.setattr(jaccard, name, value)
    base = [f"g{k}" for k in range(80)]
    group = [" ".join([*base[:k], f"new{k}", *base[k + 1 :]]) for k in range(30)]
    rows = planted(5) + [(20000 + k, t, "s") for k, t in enumerate([*group, group[0], group[0]])] + [(None, group[1], "s")]
    got = got_links(frame(spark, rows))
    assert got == expected_links(rows)
    assert max(n for _, n in got) >= 32


def test_components_of_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, text, "s"), (5, text, "s"), (None, text + " more", "s"), (None, "alone", "s"), (3, text, None), (9, "", "s"), (9, None, "s")]
    assert got_components(frame(spark, rows)) == expected_components(rows)
    assert got_components(frame(spark, rows).limit(0)) == Counter()
    kept = Counter((r.doc_id, r.text) for r in jaccard.one_of_each_component(frame(spark, rows)).collect())
    assert kept == Counter({(3, text): 1, (None, text + " more"): 1, (None, "alone"): 1, (9, ""): 1, (9, None): 1})


def test_word_hashes_follow_words():
    shingler = jaccard.Shingler()
    rng = random.Random(1)
    texts = ["".join(rng.choice("abAB é\n\t\x0b漢") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    seen = {}
    for text in [*texts, "x" * 200000]:
        words = WORD.findall(text.translate(LOWER))
        hashes = shingler.words(text).tolist()
        assert len(hashes) == len(words)
        for word, value in zip(words, hashes):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_tree_lets_no_link_through():
    """Every linked pair of different components is among the tree's pairs."""
    rng = np.random.default_rng(3)
    for _ in range(20):
        base = rng.integers(0, 2**63, 300, dtype=np.uint64)
        sets = []
        for _ in range(60):
            n = int(rng.integers(30, 300))
            sets.append(np.unique(np.concatenate([base[:n], rng.integers(0, 2**63, int(rng.integers(0, 60)), dtype=np.uint64)])))
        parts = rng.integers(0, 10, len(sets)).tolist()
        tree = jaccard.CountTree([jaccard.count_vector(s) for s in sets], parts)
        found = {frozenset(p) for p in tree.pairs()}
        for i in range(len(sets)):
            for k in range(i):
                common = len(np.intersect1d(sets[i], sets[k]))
                if parts[i] != parts[k] and 100 * common >= 75 * (len(sets[i]) + len(sets[k]) - common):
                    assert frozenset((i, k)) in found


def test_components_of_a_chain(spark):
    links = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert {r.component for r in jaccard.components(links).collect()} == {0}
    assert jaccard.components(links.limit(0)).collect() == []


# --- fingerprints ----------------------------------------------------------------------------------


def test_fingerprint_query(spark):
    rows = sorted(queries.QUERIES["op3_fingerprints"](spark, SF_DIR).collect(), key=lambda r: r.doc_id)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    order = sorted(texts)
    errors = []
    for k, row in enumerate(rows):
        own, following = texts[row.doc_id], texts[order[(k + 1) % len(order)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        assert row.n_chars == len(own)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        one, other = ({tuple(WORD.findall(t)[j : j + 5]) for j in range(len(WORD.findall(t)) - 4)} for t in (own, edited))
        if len(one) > 20 and other:
            errors.append(row.near_edited - len(one & other) / len(one | other))
    assert len(rows) == len(texts)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.06  # 128 bins: about 0.042


def expected_bins(hashes):
    """One permutation by hand: least value a bin, then each empty bin asks the others in its own order."""
    low = (1 << (63 - fingerprint.BIN_BITS)) - 1
    values = {}
    for h in hashes:
        h = (h % (1 << 64)) >> 1
        bin, value = h >> (63 - fingerprint.BIN_BITS), h & low
        if value != low:
            values[bin] = min(values.get(bin, low), value)
    if not values:
        return ""
    out = []
    for bin in range(fingerprint.BINS):
        source = bin if bin in values else min(values, key=lambda other: fingerprint.place_in_order(bin, other))
        out.append(f"{values[source] & 255:02x}")
    return "".join(out)


def test_bins_and_densification(spark):
    texts = ["", "one", "one two three four", "a b c d e", "a b c d e f g", " ".join(f"w{k}" for k in range(400)), "x " * 3000, None]
    df = frame(spark, [(k, t, "s") for k, t in enumerate(texts)]).select(
        fingerprint.shingles(F.col("text")).alias("h"), fingerprint.fingerprint(F.col("text")).alias("f")
    )
    for row in df.collect():
        assert row.f == expected_bins(row.h)


def test_fingerprints_of_odd_rows(spark):
    rows = [(1, "same words in this text here", "s"), (2, "same words in this text here", "s"), (2, None, "s"), (None, "x", "s"), (7, "é🙂ab", "s")]
    got = fingerprint.fingerprint_documents(frame(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[7].n_chars == 4 and by_id[7].edited == "é🙂x"
    assert by_id[None].edited == "x" and by_id[None].near_next == 0
    same = [r.fingerprint for r in got if r.doc_id in (1, 2) and r.n_chars]
    assert len(set(same)) == 1
    assert fingerprint.fingerprint_documents(frame(spark, rows).limit(0)).collect() == []
    one = fingerprint.fingerprint_documents(frame(spark, rows[:1])).first()
    assert one.near_next == 1


def test_ranges_hold_every_neighbour(spark):
    rng = random.Random(9)
    ids = sorted(rng.sample(range(-(10**9), 10**9), 700))
    rows = fingerprint.beside_next(frame(spark, [(i, f"t{i}", "s") for i in ids]).select("doc_id", "text"), ["text"]).collect()
    following = dict(zip(ids, ids[1:] + ids[:1]))
    assert {r.doc_id: r.next_text for r in rows} == {i: f"t{n}" for i, n in following.items()}
    assert len(rows) == len(ids)


# --- rules -----------------------------------------------------------------------------------------


def counts_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    again = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again)


def test_rules_of_odd_rows(spark):
    rng = random.Random(2)
    texts = [None, "", " \n \t", "a b c d e a b c d e", "x " * 500, "l1\nl1\n\nl1 \n", "#$ é🙂 a|b\x0bc\x0cd\r\n<>&", "w " * 3 + "v"]
    texts += [" ".join(rng.choices("abcd", k=rng.randint(1, 60))) for _ in range(100)]
    rows = [(k, t, rng.choice([None, "src", "https://Host.org/x", "host.org"])) for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in rules.host_rules(frame(spark, rows)).collect()}
    for doc_id, text, source in rows:
        r = got[doc_id]
        words, chars, symbols, lines, again = counts_by_hand(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (words, chars, symbols, lines, again)
        assert r.base_failed == (words < 10 or 100 * again > 20 * words)
        assert r.host == {None: "", "src": "src"}.get(source, "host.org")
    assert rules.host_rules(frame(spark, rows).limit(0)).collect() == []


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{k}" for k in range(50))
    rows = [(k, good, f"host{k % 20}") for k in range(400)]
    rows += [(1000 + k, "too short" if k % 10 else good, "bad.org") for k in range(100)] + [(2000, "too short", "tiny.org"), (2001, good, "tiny.org")]
    got = {r.doc_id: r for r in rules.host_rules(frame(spark, rows)).collect()}
    assert all(got[k].kept for k in range(400))
    assert not any(got[1000 + k].kept for k in range(100))
    assert got[2001].kept and not got[2000].kept  # two documents say little about a host


def test_one_failure_does_not_condemn_a_host(spark):
    """Rates of 200 hosts of 50 documents lie between 2 and 30 %; 5,000 hosts have one document; one host fails mostly."""
    rng = random.Random(5)
    sizes = [(f"one{k}", 1, rng.uniform(0.02, 0.3)) for k in range(5000)] + [(f"many{k}", 50, rng.uniform(0.02, 0.3)) for k in range(200)]
    counts = [(host, n, sum(rng.random() < rate for _ in range(n))) for host, n, rate in sizes] + [("bad", 50, 45)]
    hosts = spark.createDataFrame([(host, n, f, 0, 0) for host, n, f in counts], "host string, documents long, base_n long, symbols_n long, lines_n long")
    alike = rules.likeness(hosts)
    assert 0.02 < alike["base"] < 0.12 and alike["symbols"] == alike["lines"] == 0
    got = {r.host: r for r in rules.host_verdicts(hosts).collect()}
    assert sum(f for _, n, f in counts if n == 1) > 500
    assert [host for host, r in got.items() if r.bad] == ["bad"]
    failed = [got[host].base_rate for host, n, f in counts if n == f == 1]
    assert max(failed) < 0.3 and min(failed) > got["bad"].symbols_rate == 0


def test_hosts_that_tell_nothing_get_the_mean(spark):
    schema = "host string, documents long, base_n long, symbols_n long, lines_n long"
    single = spark.createDataFrame([(f"h{k}", 1, int(k < 3), 1, 0) for k in range(10)], schema)
    assert {(r.base_rate, r.symbols_rate, r.lines_rate, r.bad) for r in rules.host_verdicts(single).collect()} == {(0.3, 1.0, 0.0, True)}
    alone = spark.createDataFrame([("", 8, 2, 0, 8)], schema)
    assert [(r.base_rate, r.lines_rate) for r in rules.host_verdicts(alone).collect()] == [(0.25, 1.0)]
    apart = spark.createDataFrame([("a", 5, 5, 0, 0), ("b", 5, 0, 0, 0)], schema)
    assert {r.host: r.base_rate for r in rules.host_verdicts(apart).collect()} == {"a": 1.0, "b": 0.0}


def test_rules_of_very_long_and_repeated_rows(spark):
    long = " ".join(f"w{k}" for k in range(300_000))
    rows = [(1, long, "a"), (None, "too short", "a"), (None, "too short", "a"), (2, long + " " + long, "a")]
    got = rules.host_rules(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_repeat_words) for r in got) == [(0, 2, 0), (0, 2, 0), (1, 300_000, 0), (2, 600_000, 600_000)]


# --- pages -----------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a = "<p>no</p>";</script></head>
<body class="x"><header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice">We use cookies</div><aside>Side <p>bar</p></aside>%s<form><input name=q><button>Go</button></form>
<section id="comments"><p>First!</p></section><footer>&copy; 2020</footer></body></html>"""


def test_page_by_hand():
    body = "<article><h1>Head&nbsp;line</h1><p>One <b>two</b>\n three<br>four<p>five &lt;six&gt;<div class='ad'>Buy</div><ul><li>x<li>y</ul></article>"
    assert wrapper.main_text(PAGE % body) == "Head line\nOne two three four\nfive <six>\nx\ny"


def test_pages_that_are_broken_or_empty():
    assert wrapper.main_text(None) == wrapper.main_text("") == wrapper.main_text("<p></p>") == ""
    assert wrapper.main_text("just text") == "just text"
    assert wrapper.main_text("<article><p>a<b>b</article") == "ab"
    assert wrapper.main_text("<div class='ad'><article><p>kept</p></article>") == "kept"
    assert wrapper.main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    assert wrapper.main_text("<article><a title='x>y' href=z>q</a> 1 < 2 <!-- <p>no --> end") == "q 1 < 2 end"
    long = "<article>" + "<p>word &amp;</p>" * 20000 + "</article>"
    assert wrapper.main_text(long) == "\n".join(["word &"] * 20000)


def test_constant_places_become_template():
    """A line that all pages of a host have at one place is template; the rest of the article is content."""
    pages = [PAGE % f"<div class=body><p>Text of page {k} that is long enough.</p><p>Read more on our site</p></div>" for k in range(6)]
    constant, slot = wrapper.induced(pages)
    assert any(c.endswith("\nRead more on our site") for c in constant)
    assert slot == "html/div.body"
    texts = [wrapper.main_text(page, frozenset(constant), slot) for page in pages]
    assert texts == [f"Text of page {k} that is long enough." for k in range(6)]


def texts_of_host(pages):
    constant, slot = wrapper.induced(pages)
    return [wrapper.main_text(page, frozenset(constant), slot) for page in pages]


@pytest.mark.parametrize("tag", ["div class=t", "section", "blockquote", "pre", 'div class="w-1/2"'])
def test_all_siblings_of_the_slot_are_kept(tag):
    blocks = [[f"Block {b} of page {k} has its own words {b * k}." for b in range(4)] for k in range(6)]
    wrapped = [f"<h2>Part {k}</h2>".join(f"<{tag}>{t}</{tag.split()[0]}>" for t in own) for k, own in enumerate(blocks)]
    texts = texts_of_host([PAGE % f"<div id=top><div class=body><h1>Title {k}</h1>{w}</div></div>" for k, w in enumerate(wrapped)])
    assert texts == [f"Title {k}\n" + f"\nPart {k}\n".join(own) for k, own in enumerate(blocks)]


def test_a_slot_is_never_one_kind_of_block():
    """Paragraphs around long quotes are kept, those after the last quote too."""
    quotes = [[f"Quote {b} of page {k} " + "with many more words " * 5 + f"{b * k}." for b in range(3)] for k in range(6)]
    body = [f"<p>Before {k}.</p>" + "".join(f"<blockquote>{q}</blockquote>" for q in own) + f"<p>After {k}.</p>" for k, own in enumerate(quotes)]
    assert texts_of_host([PAGE % f"<div class=body>{b}</div>" for b in body]) == [
        "\n".join([f"Before {k}.", *own, f"After {k}."]) for k, own in enumerate(quotes)
    ]


def test_all_articles_are_kept():
    body = "<article><p>One</p><article>In it</article></article><div><article>Two</article></div><aside><article>Tease</article></aside>"
    assert wrapper.main_text(PAGE % body) == "One\nIn it\nTwo"
    assert wrapper.main_text(PAGE % f"<main><p>Intro</p>{body}</main>") == "Intro\nOne\nIn it\nTwo"


@pytest.mark.parametrize(
    "part",
    [
        "<h2 id=related>%s</h2>",
        "<h2 id=related-work>%s</h2>",
        "<section id=social-history>%s</section>",
        "<p class=notice-period>%s</p>",
        '<p><a href="/view?id=comments">%s</a></p>',
        '<p><a data-id="share" class=share>%s</a></p>',
        '<pre><span class="comment">%s</span></pre>',
    ],
)
def test_words_drop_no_article_text(part):
    assert wrapper.main_text(f"<article><p>Long text first.</p>{part % 'Kept'}<div class='ad'>Buy</div></article>") == "Long text first.\nKept"


@pytest.mark.parametrize("name", ["content with-sidebar", "content sidebar", "page widget"])
def test_a_word_does_not_drop_most_of_a_page(name):
    pages = [PAGE % f"<div class='{name}'><p>Text of page {k}, long enough to be most of it.</p><p>More {k}.</p></div>" for k in range(6)]
    assert texts_of_host(pages) == [f"Text of page {k}, long enough to be most of it.\nMore {k}." for k in range(6)]


def host_texts(spark, pages):
    df = spark.createDataFrame([(k, "http://a.org/x", p) for k, p in enumerate(pages)], "page_id bigint, url string, html string")
    return [r.text for r in sorted(wrapper.extract_text(df).collect(), key=lambda r: r.page_id)]


def test_every_layout_has_its_template_and_slot(spark):
    """A layout with few of a large host's pages has a slot and template texts of its own."""
    large = [f"<div class=body><p>Text of page {k} that is long enough.</p><p>Read more</p></div>" for k in range(60)]
    rare = [f"<div class=top>Top {k}</div><div class=story><p>Story {k} that is long enough to be one.</p><p>By the desk</p></div>" for k in range(5)]
    texts = host_texts(spark, [f"<html>{b}</html>" for b in large + rare])
    assert texts[:60] == [f"Text of page {k} that is long enough." for k in range(60)]
    assert texts[60:] == [f"Story {k} that is long enough to be one." for k in range(5)]


def test_one_article_under_many_menus_is_no_template(spark):
    same = "<div class=body><p>The same long text of one article.</p><p>Its second part.</p><p>Read more</p></div>"
    other = [f"<div class=body><p>Text of page {k} that is long enough.</p><p>Read more</p></div>" for k in range(6)]
    pages = [f"<html><nav>Menu {k}</nav>{same}</html>" for k in range(60)] + [f"<html><nav>x</nav>{b}</html>" for b in other]
    texts = host_texts(spark, pages)
    assert set(texts[:60]) == {"The same long text of one article.\nIts second part."}
    assert texts[60:] == [f"Text of page {k} that is long enough." for k in range(6)]


def test_the_slot_comes_from_all_pages(spark):
    """A text on four fifths of a large host's pages is template; eight pages of it may show otherwise."""

    def page(host, k):
        own = f"<div class=a><p>Page {k} of host {host} {f'has a first part {k} of its own ' * 4}</p><p>And a second part {k}.</p></div>"
        other = k % 5 == 0
        terms = f"Other terms, which only page {k} of this host has, not others" if other else "Terms of this host, which most of its pages have, not all"
        lines = "<hr>" * (1 + other * (-1) ** (k % 2))
        return f"<html>{own}<div class=b>{terms}</div><div class=c>Seen by {k} people</div>{lines}</html>"

    rows = [(100 * host + k, f"http://h{host}.org/{k}", page(host, k)) for host in range(8) for k in range(40)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for r in wrapper.extract_text(df).collect():
        host, k = divmod(r.page_id, 100)
        assert r.text == f"Page {k} of host {host} {' '.join([f'has a first part {k} of its own'] * 4)}\nAnd a second part {k}."


def test_slots_equal_one_alignment_of_all_pages(spark):
    """Every page has a longest text of its own here, in a link, and a size of its own."""
    rng = random.Random(7)
    rows, expected = [], {}
    for host in range(6):
        for layout in range(2):
            scope = 10 * host + layout
            words = [[f"text {b} " + "word " * rng.randint(1, 9) for b in range(8)] for _ in range(12 + layout)]
            for k, own in enumerate(words):
                own = [t if rng.random() < 0.25 else f"text {b} of host {host}" for b, t in enumerate(own)]
                blocks = "".join(f"<div class=b{b // 4}><div class=c{b}>{t}</div></div>" for b, t in enumerate(own))
                html = f"<a>Link {scope} {k} {'which is the longest of the texts ' * 3}</a>{blocks}" + "<hr>" * (2 * k + layout)
                rows += [(k, html, scope, -1 - host)] * rng.randint(1, 2)
                expected.setdefault(scope, set()).add(html)
                expected.setdefault(-1 - host, set()).add(html)
    rows += [(None, None, 0, -1), (1, "", 0, -1), (2, "<p>one</p>", 5, -100), (None, "<p>two</p>", 5, -100)]
    df = spark.createDataFrame(rows, "page_id bigint, html string, layout_scope bigint, host_scope bigint")
    got = {r.scope: r.slot for r in wrapper.slots(df).collect()}
    assert got == {scope: wrapper.induced(sorted(pages))[1] for scope, pages in expected.items()}
    assert len(set(got.values())) > 2


def test_few_pages_have_no_template():
    constant, _ = wrapper.induced([PAGE % "<article><p>Same</p></article>"] * 2)
    assert constant == []


def tree_size_brute(a, b):
    """Simple tree matching by its recursion, without a table kept."""
    if a.label != b.label:
        return 0
    xs, ys = a.children(), b.children()
    m = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs, 1):
        for k, y in enumerate(ys, 1):
            m[i][k] = max(m[i - 1][k], m[i][k - 1], m[i - 1][k - 1] + tree_size_brute(x, y))
    return 1 + m[-1][-1]


def test_alignment_is_the_largest():
    rng = random.Random(4)

    def random_page(depth=0):
        tag = rng.choice(["div", "p", "ul", "span"])
        inner = "".join(random_page(depth + 1) for _ in range(rng.randint(0, 3))) if depth < 3 else "t"
        return f"<{tag}>{inner}</{tag}>"

    for _ in range(60):
        one, other = wrapper.parsed(random_page()), wrapper.parsed(random_page())
        assert len(wrapper.aligned(one, other)) == tree_size_brute(one, other)


def test_deep_and_long_pages_are_aligned_whole(monkeypatch):
    deep = "<div>" * 300 + "x" + "</div>" * 300
    assert len(wrapper.aligned(wrapper.parsed(deep), wrapper.parsed(deep))) == 301
    rng = random.Random(5)
    pages = [wrapper.parsed("".join(rng.choice(["<p>a<b>b</b></p>", "<hr>", "<div><ul><li>c</ul></div>"]) for _ in range(90))) for _ in range(6)]
    whole = [tree_size_brute(one, other) for one, other in zip(pages, pages[1:])]
    for short, cells in ((64, 1 << 20), (1000, 1 << 20), (0, 50), (1000, 50)):
        monkeypatch.setattr(wrapper, "SHORT_ROW", short)
        monkeypatch.setattr(wrapper, "KEPT_CELLS", cells)
        assert [len(wrapper.aligned(one, other)) for one, other in zip(pages, pages[1:])] == whole


def test_page_query(spark):
    """The given pages have one article each: its blocks, tags taken out, references decoded."""
    rows = queries.QUERIES["op4_wrapper_text"](spark, SF_DIR).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for row in rows:
        body = re.search("<article>(.*)</article>", pages[row.page_id], re.S)[1]
        parts = re.sub("</?(h1|p)>", "\0", body).split("\0")
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", " " if "<br>" in p else "", p)).split()) for p in parts]
        assert row.text == "\n".join(line for line in lines if line)
        assert row.n_chars == len(row.text)


def test_pages_of_odd_rows(spark):
    schema = "page_id bigint, url string, html string, host string, constant string, text string"
    page = PAGE % "<article><p>x</p></article>"
    rows = [(1, None, page), (1, None, page), (None, "not a url", None), (2, "http://a.org/x", ""), (3, "http://A.org:80/y", page)]
    df = spark.createDataFrame([(*r, "h", "c", "t") for r in rows], schema)
    got = Counter(map(tuple, wrapper.extract_text(df).collect()))
    assert got == Counter((i, u, "x" if h else "") for i, u, h in rows)
    assert wrapper.extract_text(df.limit(0)).collect() == []


# --- memory of the near copies -------------------------------------------------------------------


def test_common_shingles_do_not_hang_on_arrow_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        texts = [f"one two three four five {' '.join(f'w{i}x{k}' for k in range(8))}" for i in range(6)]
        docs = frame(spark, [(i, t, "s") for i, t in enumerate(texts)]).select("doc_id", "text").coalesce(1)
        rows = jaccard.node_rows(docs).collect()
    finally:
        spark.conf.set(name, before)
    common = [x for r in rows for x in zip(r.common or [], r.counts or [])]
    assert [r.doc_id for r in rows] == list(range(6)) and len(common) == 1 and common[0][1] == 6


def test_common_shingles_are_counted_in_one_copy():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, 30).astype(np.uint64)) for _ in range(9)]
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    common, found = jaccard.common_among(sets)
    assert common.tolist() == values[counts >= 4].tolist() and found.tolist() == counts[counts >= 4].tolist()
    assert not len(jaccard.common_among([])[0]) and not len(jaccard.common_among(sets[:1])[0])


def test_near_copies_take_texts_in_small_batches(spark):
    before = {name: spark.conf.get(name) for name in BATCH}
    try:
        for name in BATCH:
            spark.conf.unset(name)
        jaccard.jaccard_components(frame(spark, [(1, "a b c d e f", "s")])).collect()
        assert {name: spark.conf.get(name) for name in BATCH} == BATCH
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_blocks_hold_each_node_once(spark):
    """Copies of a row are one, a node alone is none, and the pivot stands in its block."""
    rows = [(1, 5, 9), (1, 5, 9), (1, 6, 9), (1, 7, 8), (1, 7, 8), (2, 5, 9), (2, 5, 9), (3, 6, 9)]
    found = jaccard.with_pivots(spark.createDataFrame(rows, "shingle bigint, node bigint, n bigint")).collect()
    assert sorted((r.shingle, r.node, r.n) for r in found) == [(1, 5, 9), (1, 6, 9), (1, 7, 8)]
    assert len({(r.pivot, r.pivot_n) for r in found}) == 1
    assert [r.node for r in found if r.node == r.pivot] == [found[0].pivot]


def test_a_small_set_does_not_make_the_bound_of_large_ones_weak():
    """Unlike large sets leave a block even where its smallest set makes the tree's vectors short."""
    rng = np.random.default_rng(7)
    one, other, small = (np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)) for n in (2000, 2000, 10))
    near = np.unique(np.concatenate([one[50:], rng.integers(0, 2**63, 50, dtype=np.uint64)]))
    members = [[i, i, jaccard.vector_bytes(jaccard.count_vector(s))] for i, s in enumerate((one, other, small, near))]
    assert (0, 1) in {tuple(sorted(p)) for p in jaccard.CountTree([jaccard.vector_of(m[2]) for m in members], range(4)).pairs()}
    assert jaccard.nodes_in_pairs(1, members) == [(1, 0, 0), (1, 3, 3)]


def test_sets_stay_where_they_are_in_joins_by_node(spark):
    """Only pairs are shuffled when sets verify them."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i : i + 40]), "s") for i in range(12)]
    _, links, sets = jaccard.joining(frame(spark, rows))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = jaccard.verified(links, sets)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2
    assert sets.count() == 12
