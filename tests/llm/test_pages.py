import random
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lexroll.llm import licences, main_text as m, transcripts as t, url_filter as u


def pattern(glob):
    return re.compile("".join({"**": ".*", "*": "[^/]*"}.get(p, re.escape(p)) for p in re.findall(r"\*\*|\*|[^*]", glob)), re.S)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab/.*", min_size=0, max_size=12), min_size=1, max_size=12), st.lists(st.text("ab/.é", max_size=14), min_size=1, max_size=20))
def test_masks_match_globs(globs, urls):
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    masks = u.Masks(globs)
    limit, u.LONG_URL = u.LONG_URL, 9  # some go one by one
    try:
        got = masks.run([x.encode() for x in urls])
    finally:
        u.LONG_URL = limit
    for url, row in zip(urls, got):
        assert row.tolist() == [bool(pattern(g).fullmatch(url)) for g in globs], (globs, url)


def test_many_globs_need_several_words():
    globs = [f"host{i}.example/**" for i in range(60)]
    masks = u.Masks(globs)
    assert masks.words > 10
    got = masks.run([f"host{i}.example/x".encode() for i in range(60)] + [b""])
    assert got[:60].tolist() == [[i == j for j in range(60)] for i in range(60)] and not got[60].any()


def test_judged_urls(spark):
    urls = {
        1: ("http://A.example.org/es/5?x", "a.example.org", "/es/5", "example.org/es/", "block"),
        2: ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        3: ("https://x.org/", "x.org", "/", "org/", "allow"),
        4: ("https://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        5: ("http://casino.com/fr/1", "casino.com", "/fr/1", "com/fr/", "allow"),
        6: ("http://casino.com/en/1#top", "casino.com", "/en/1", None, "block"),
        7: ("http://evil.net/a.org/x", "evil.net", "/a.org/x", None, "allow"),
        8: (None, "", "", None, "allow"),
        9: ("no scheme", "", "", None, "allow"),
        10: ("http://x.com", "x.com", "", None, "allow"),
        11: ("http://x.com/de/" + "y" * 9_000, "x.com", "/de/" + "y" * 9_000, "com/de/", "block"),
        12: ("a\nb://ÉA.org?x://y.com/de/", "Éa.org", "", None, "allow"),
    }
    pages = spark.createDataFrame([(k, v[0], "x") for k, v in urls.items()] + [(3, urls[3][0], "x")], "page_id long, url string, verdict string")
    got = u.judge_urls(pages).collect()
    assert len(got) == 13
    for r in got:
        assert tuple(r)[1:] == urls[r["page_id"]][1:], r
    assert u.judge_urls(pages.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><a href=/>Home</a> <span>Site name</span></header><nav><ul><li><a href=/a>A</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, as most of all others do. Accept them.</div>
<div class="layout sidebar-right"><article><h1>A&nbsp;title &amp; more</h1><p>First  para <b>bo</b>ld &#233;.<br>line two<p>Second &lt;tag&gt;.
<div class="ad">Buy this wonderful thing today, it is the best one that was ever made for you and me.</div>
<form><p>Write to us and send a long message about anything at all.</p><button>Go</button></form>
<ul><li>one</li><li>two</li></ul><p></p></article>
<section id="comments"><h2>Comments</h2><p>I liked this article very much indeed and will read it again tomorrow.</p></section></div>
<aside><p>Other things that you could read, if you were to like that, which we hope.</p></aside><footer>&copy; us</footer>"""


def test_main_text():
    assert m.main_text_of(PAGE) == "A title & more First para bold é. line two Second <tag>. one two"
    assert m.main_text_of(None) == m.main_text_of("") == m.main_text_of("<p> </p><!-- x") == ""
    assert m.main_text_of("plain text & more") == "plain text & more"
    assert m.main_text_of("<article>" + "<p>word</p>" * 3000).count("word") == 3000
    assert m.main_text_of("<p>a < b and 1<2</p>") == "a < b and 1<2"


@settings(max_examples=300, deadline=None)
@given(st.text("<>/!-\"'= pabdiv&;nbsp", max_size=80))
def test_any_markup_ends(page):
    m.main_text_of(page)


def test_minimum_cut_by_brute_force():
    random.seed(3)
    for _ in range(1500):
        n = random.randint(1, 8)
        source, sink = ([random.randint(0, 9) for _ in range(n)] for _ in range(2))
        edges = {(i, j): random.randint(1, 6) for i in range(n) for j in range(i + 1, n) if random.random() < 0.4}

        def cost(side):
            own = sum(sink[i] if side[i] else source[i] for i in range(n))
            return own + sum(c for (i, j), c in edges.items() if side[i] != side[j])

        best = min(cost([b >> i & 1 for i in range(n)]) for b in range(1 << n))
        assert cost(m.minimum_cut(source, sink, edges)) == pytest.approx(best)


def test_main_texts_of_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 5), (2, None, None, 5), (2, None, None, 5)], "page_id long, url string, html string, n_chars int")
    got = m.main_texts(pages).collect()
    assert sorted((r["page_id"], r["n_chars"]) for r in got) == [(1, len(m.main_text_of(PAGE))), (2, 0), (2, 0)]
    assert m.main_texts(pages.limit(0)).count() == 0


def test_markers():
    assert t.split_marker("User: hi") == ("user", "hi")
    assert t.split_marker("### Assistant:") == ("assistant", "")
    assert t.split_marker("<|system|> x") == ("system", "x")
    assert t.split_marker("[HUMAN] x") == ("user", "x")
    assert t.split_marker("A user: said")[0] is None and t.split_marker("users: x")[0] is None


def test_viterbi_by_brute_force():
    from itertools import product

    lines = ["User: hi?", "well", "AI: a long answer " + "x" * 200, "more", "ok then?"]
    counts = {("move", 2, 4): 9, ("move", 4, 5): 7, ("move", 5, 2): 5, ("move", 2, 3): 4, ("size", 5, 4): 8, ("asks", 2, 1): 6}
    model = t.model_from(counts)

    def score(path):
        total = model.start[path[0]]
        for i, (line, state) in enumerate(zip(lines, path)):
            total += sum(table[state, v] for table, v in zip(model.shown, t.observe(line)))
            total += model.move[path[i - 1], state] if i else 0
        return total

    assert score(model.states(lines)) == pytest.approx(max(map(score, product(range(t.STATES), repeat=len(lines)))))
    assert model.states([]) == []


def test_transcripts(spark):
    rows = [(c, k, "user" if k % 2 == 0 else "assistant", ("Short question?" if k % 2 == 0 else "A long answer. " * 20)) for c in range(60) for k in range(6)]
    rows += [(100, 0, "system", "Be kind."), (100, 1, "user", "Hi?\nAre you there?"), (100, 1, "user", "Hi?\nAre you there?"), (100, 2, "assistant", None)]
    rows += [(None, 0, "user", "lost one"), (None, 0, "user", "lost two"), (101, None, "tool", ""), (102, 700, "user", "late"), (102, 1, "user", "early")]
    rows += [(103, 1, "user", f"many {i}") for i in range(5000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    logs = t.logs_of(table).cache()
    # 61 whole conversations, two lost rows, the one without a turn, two pieces of 102, the crowded one in parts
    assert logs.where("conv_id <= 100").count() == 61 and logs.where("conv_id IS NULL").count() == 2
    assert logs.where("conv_id = 102").count() == 2
    assert logs.where("conv_id = 103").agg(F.max(F.size("turns"))).first()[0] < 600
    model = t.learn_model(logs.where("conv_id <= 100"))
    got = {r["conv_id"]: r for r in t.parse_transcripts(logs.where("conv_id < 100"), model, ("conv_id",)).collect()}
    assert sum([x["role"] for x in r["turns"]] == ["user", "assistant"] * 3 for r in got.values()) >= 54
    assert got[0]["rendered"].startswith("<|user|>\nShort question?\n<|assistant|>\nA long answer.")
    empty = spark.createDataFrame([(1, None), (2, "")], "conv_id long, text string")
    assert [r["turns"] for r in t.parse_transcripts(empty, model).collect()] == [[], []]
    assert t.logs_of(table.limit(0)).count() == 0
    assert len(t.turns_of("hello", t.learn_model(t.logs_of(table.limit(0))))) == 1


@pytest.mark.parametrize("fan", [64, 2])
def test_long_conversations_are_parsed_as_one(spark, monkeypatch, fan):
    monkeypatch.setattr(t, "PIECE_TURNS", 50)
    monkeypatch.setattr(t, "PART_ROWS", 20)
    monkeypatch.setattr(t, "FAN", fan)
    draw = random.Random(2)
    rows = [(c, k, "user" if k % 2 == 0 else "assistant", " ".join(draw.choices(["so", "is", "it?", "long " * 20, "ok.\nthen"], k=4))) for c, n in ((1, 600), (2, 3), (3, 120)) for k in range(n)]
    rows += [(3, 60, "user", "again and again")] * 70
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    logs = t.logs_of(table)
    assert logs.agg(F.sum(F.size("turns"))).first()[0] == len(rows)  # repeated rows are kept
    model = t.learn_model(logs)
    whole = {}
    for r in logs.orderBy("conv_id", "piece", "part").collect():
        whole.setdefault(r["conv_id"], []).extend((x["role"], x["shown"]) for x in r["turns"])
    counts = t.Counter()
    for turns in whole.values():
        t.count_known(t.known_states(turns), counts)
    once = t.model_from(counts)
    assert all(t.np.allclose(a, b) for a, b in zip((once.start, once.move, *once.shown), (model.start, model.move, *model.shown)))
    got = {}
    for r in t.carried(logs, model).orderBy("conv_id", "piece", "part").collect():
        got.setdefault(r["conv_id"], []).extend(model.states(r["text"].split("\n"), r["enter"], r["leave"]))
    assert got == {c: model.states([line for line, _ in t.known_states(turns)]) for c, turns in whole.items()}
    assert any(t.turns_of(r["text"], model, r["enter"], r["leave"])[0][2] for r in t.carried(logs, model).where("enter IS NOT NULL").collect())


def test_licences(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("a/LICENSE", "Some words here\n" + mit + "\nand many more words that are not about it at all, not one of them, no."),
        ("a/b/x.txt", "no header"), ("a/b/y.txt", gpl + "\ntext"), ("a/c/COPYING.txt", gpl), ("a/c/d/z.txt", None), ("q/w.txt", "x"),
        ("q/odd.txt", "This licence is unlike any that you have ever seen, friend."), (None, mit), (None, "x"), ("a/b/x.txt", "no header"), ("top.txt", ""),
    ]
    files = spark.createDataFrame(rows, "path string, text string").withColumn("licence", F.lit("z"))
    got = [(r["path"], r["licence"], r["how"]) for r in licences.scan_licences(files).collect()]
    key = str
    assert sorted(got, key=key) == sorted([
        ("a/LICENSE", "MIT", "header"), ("a/b/x.txt", "GPL-3.0", "inherited"), ("a/b/y.txt", "GPL-3.0", "header"), ("a/c/COPYING.txt", "GPL-3.0", "header"),
        ("a/c/d/z.txt", "GPL-3.0", "inherited"), ("q/w.txt", None, None), ("q/odd.txt", None, None), (None, "MIT", "header"), (None, None, None),
        ("a/b/x.txt", "GPL-3.0", "inherited"), ("top.txt", None, None),
    ], key=key)
    assert licences.scan_licences(files.limit(0)).count() == 0
