"""Main text of pages, and archives."""

import gzip
import os
import random
import subprocess
import sys
from collections import Counter, defaultdict

import pytest

from millrace.llm import templates, warc
from millrace.llm.page_text import Page


def text(html, found=frozenset()):
    return Page(html).text(set(found))


def test_blocks_references_and_blanks():
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><p>Menu</p></nav><article><h1>A &lt;b&gt;&nbsp;
      c</h1><p>One <b>two</b>three<br>four<p>Five &amp six &amx; &#233;</p></p><ul><li>x<li>y</ul>tail<script>"</p>"</script>
      <div class="ad-box"><p>Buy</div><pre>a
      b</pre><table><tr><td>1<td>2<tr><td>3</table></article><p>outside</p><footer>F</footer>"""
    assert text(page) == "A <b> c\nOne twothree four\nFive & six &amx; é\nx\ny\ntail\na b\n1\n2\n3"


@pytest.mark.parametrize("left_out", [
    "<aside>z</aside>", "<form>z</form>", '<div class="cookie notice">z</div>', "<div id='comments'>z</div>", "<!-- z -->",
    "<section hidden>z</section>", '<p role="navigation">z</p>', "<noscript>z</noscript>", "<textarea>z</textarea>", "<svg>z</svg>",
    '<div class="user-comment"><article>z</article></div>', "<iframe>z</iframe>", "<STYLE>z</STYLE >", "<menu><li>z</menu>",
])
def test_what_is_left_out(left_out):
    assert text(f"<article><p>a</p>{left_out}<p>b</p></article>") == "a\nb"
    assert text(f"<body><p>a</p>{left_out}<p>b</p>") == "a\nb"


def test_pages_without_an_article():
    assert text("<body><header>h</header><main><p>a</p></main><p>b</p>") == "a"
    assert text("plain text") == "plain text" and text("") == "" and text("<p>") == "" and text("a < b") == "a < b"
    assert text("<article></article><p>x</p>") == "x"


@pytest.mark.parametrize("page", [
    '<div class="content no-sidebar"><article>{}</article></div>', '<div id="page" class="has-sidebar">{}</div>', "<form>{}</form>",
    '<article id="search-basics">{}</article>', '<p title="a hidden gem">{}</p>', "<form><main>{}</main></form>", "<main><form>{}</form></main>",
    '<article class="search">{}</article>', '<div class="sidebar widget"><div><article>{}</article></div></div><p>x</p>',
    '<article><h1 class="entry-header">{}</h1></article>', '<article><div class="header">{}</div></article>', '<h1 class="header">{}</h1>',
    '<form><nav>Menu</nav><ul><li>First thing</li><li>Second thing</li></ul><article>{}</article></form>', "<div data-role='main'>a</div><main>{}</main>",
])
def test_names_and_forms_do_not_drop_the_main_content(page):
    assert text(f"<body>{page.format('The main text')}</body>") == "The main text"


def test_names_and_forms_beside_the_main_content_go():
    assert text('<main><p>The main text</p><div class="related"><article>Next</article></div></main>') == "The main text"
    assert text('<p>The main text</p><div class="promo"><article>Next</article></div>') == "The main text"
    assert text('<article>a</article><div class="promo"><article>A longer text</article></div>') == "a"
    assert text("<main><p>The main text</p><form>Send</form></main>") == "The main text"
    assert text('<article>a</article><p hidden>The main text</p><p HIDDEN=""><article>b</article></p>') == "a\nb"


def test_damaged_and_huge_pages():
    assert text("<article><p>a<!-- never ends") == "a"
    assert text('<article><p title="a>b">c</p><a href="x') == "c"
    assert text("</p></div>a</article>") == "a"
    assert text("<div>" * 50_000 + "x") == "x"
    assert text('<a "' * 50_000) == ""
    assert len(text("<p>" + "word " * 200_000)) == 999_999


SITE = '<body><div class="top"><p>Read our daily letter</p></div><p>Own text {0}</p><div><ul><li>{0}</ul></div><p>Imprint</p></body>'


def site(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, text string, host int")


def test_subtrees_recurring_on_a_host_go(spark):
    rows = [(i, f"http://a.org/{i}", SITE.format(i)) for i in range(30)] + [(100 + i, f"http://b.org/{i}", SITE.format(i)) for i in range(3)]
    rows += [(200 + i, "http://a.org/x", "<body><div class='top'><p>Read our daily letter</p></div><article><p>Imprint</p></article>") for i in range(2)]
    rows += [(300, None, None), (301, "", ""), (302, "no scheme", "<p>Imprint</p>"), (None, "http://a.org/", SITE.format("n")), (3, "http://a.org/3", SITE.format(3))]
    got = {(r["page_id"], r["url"]): r for r in templates.extract_text(site(spark, rows)).collect()}
    assert len(templates.extract_text(site(spark, rows)).collect()) == len(rows)
    assert got[4, "http://a.org/4"]["text"] == "Own text 4\n4" and got[4, "http://a.org/4"]["n_templates"] == 3
    assert got[101, "http://b.org/1"]["text"] == "Read our daily letter\nOwn text 1\n1\nImprint"
    assert got[200, "http://a.org/x"]["text"] == "Imprint"
    assert got[300, None]["text"] == got[301, ""]["text"] == "" and got[300, None]["n_chars"] == 0
    assert got[302, "no scheme"]["text"] == "Imprint" and got[None, "http://a.org/"]["text"] == "Own text n\nn"
    assert templates.extract_text(site(spark, [])).collect() == []


def test_text_copied_within_articles_stays(spark):
    rows = [(i, "http://a.org/", "<nav>N</nav><article><p>The same everywhere</p></article>") for i in range(40)]
    got = templates.extract_text(site(spark, rows)).collect()
    assert {r["text"] for r in got} == {"The same everywhere"} and {r["n_templates"] for r in got} == {1}


def words(seed, n=60):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in templates.extract_text(site(spark, rows)).collect()}


def test_boxes_recurring_within_articles_go(spark):
    box = "<div class='c7'><h3>Our letter</h3><p>Every Monday by mail</p></div>"
    page = "<article><h1>Title {0}</h1><p>{1}</p>" + box + "<ul><li>yes</li><li>{0}</li></ul><p>{2}</p></article>"
    rows = [(i, "http://a.org/", page.format(i, words(i), words(1000 + i))) for i in range(12)]
    rows += [(100 + i, "http://b.org/", page.format(i, words(i), words(1000 + i))) for i in range(9)]
    # many rows of one article, with the box, and near copies of it, each with another word changed
    rows += [(200 + i, "http://a.org/", page.format("x", words(500), words(501))) for i in range(30)]
    long = [words(600 + k, 30) for k in range(20)]
    for i in range(30):
        copy = [p.replace(p[:6], f"changed{i}") if k == i % 20 else p for k, p in enumerate(long)]
        rows.append((300 + i, "http://a.org/", "<article>" + "".join(f"<p>{p}</p>" for p in copy) + box + "</article>"))
    got = texts(spark, rows)
    for i in range(12):
        assert got[i] == f"Title {i}\n{words(i)}\nyes\n{i}\n{words(1000 + i)}"
    assert "Every Monday by mail" in got[103]
    assert got[229] == f"Title x\n{words(500)}\nyes\nx\n{words(501)}"
    assert all(len(got[300 + i].split("\n")) == 20 and f"changed{i}" in got[300 + i] for i in range(30))


def test_copies_of_pages_without_an_article_stay(spark):
    page = "<body><div><p>Sections A to Z</p></div><h2>{0}</h2><p>{1}</p></body>"
    rows = [(i, "http://a.org/", page.format("same", words(1))) for i in range(25)]
    assert set(texts(spark, rows).values()) == {f"Sections A to Z\nsame\n{words(1)}"}
    rows += [(100 + i, "http://a.org/", page.format(f"near {i}", words(1))) for i in range(25)]
    assert all("Sections A to Z" in t and words(1) in t for t in texts(spark, rows).values())
    rows += [(200 + i, "http://a.org/", page.format(f"own {i}", words(50 + i))) for i in range(12)]
    got = texts(spark, rows)
    assert got[3] == f"same\n{words(1)}" and got[104] == f"near 4\n{words(1)}" and got[205] == f"own 5\n{words(55)}"


def test_the_size_of_a_host_decides_nothing(spark):
    """Twelve pages with a menu among 1,500 others of the host."""
    rows = [(i, "http://a.org/", f"<body><div class='m'><p>Menu of sports</p></div><p>{words(i, 12)}</p></body>") for i in range(12)]
    rows += [(100 + i, "http://a.org/", f"<body><p>{words(100 + i, 12)}</p></body>") for i in range(1500)]
    got = texts(spark, rows)
    assert all(got[i] == words(i, 12) for i in range(12)) and got[105] == words(105, 12)


def test_headings_and_quotations_of_articles_stay(spark):
    page = "<article><h1>Dish {0}</h1><h2>Ingredients</h2><p>{1}</p><h2>Method</h2><p>One sentence that ten articles quote.</p><p>{2}</p></article>"
    rows = [(i, "http://a.org/", page.format(i, words(i), words(100 + i))) for i in range(12)]
    got = texts(spark, rows)
    assert got[5] == f"Dish 5\nIngredients\n{words(5)}\nMethod\nOne sentence that ten articles quote.\n{words(105)}"


def test_large_menus_beside_short_texts_go(spark):
    menu = "<div class='x7'>" + "".join(f"<p>Menu line number {k} of the site, long enough</p>" for k in range(20)) + "</div>"
    rows = [(i, "http://a.org/", f"<body>{menu}<p>{words(i, 12)}</p></body>") for i in range(40)]
    assert all(t == words(i, 12) for i, t in texts(spark, rows).items())


@pytest.mark.parametrize("name", ["class='main-nav'", "class='site-footer wide'", "id='comments-area'", "class=left_sidebar"])
def test_names_of_two_parts_on_pages_alone_on_their_host(name):
    assert text(f"<body><p>The main text of the page, long enough</p><div {name}><p>Other text</p></div></body>") == "The main text of the page, long enough"
    assert text(f"<div {name}><article>a</article></div>") == "a"
    assert text("<p>a</p><div class='has-sidebar'>b</div><div class='my-own-menu'>c</div><div class='menubar'>d</div>") == "a\nb\nc\nd"


def brute_force(rows, least):
    """Templates counted by host in plain Python, over the trees that the parser gives."""
    parsed = []
    for i, url, html in rows:
        page, host = Page(html or ""), (url or "").split("://")[1].split("/")[0].lower() if "://" in (url or "") else ""
        within, others = page.subtrees()
        parsed.append((i, host, page, page.main_blocks()[1], within, others))
    seen = Counter((host, k) for _, host, _, _, within, others in parsed for k in {*within, *others} - {0})
    held = {}
    for i, host, page, blocks, within, _ in parsed:
        around = set()
        for _, _, e in blocks:
            while e >= 0:
                around.add(within[e])
                e = page.parents[e]
        held[id(page)] = around - {0}
    own = defaultdict(set)
    for i, host, page, blocks, within, _ in parsed:
        shared = {k for k in held[id(page)] if seen[host, k] >= least}
        left, whole = page.text(shared), page.text(set())
        if left and len(left) >= min(templates.OWN_CHARS, templates.OWN_SHARE * len(whole)):
            for k in shared:
                own[host, k].add(left)
    return sorted((str(i), page.text({k for k in held[id(page)] if len(own[host, k]) >= least})) for i, host, page, *_ in parsed)


def test_templates_against_counting_by_host(spark):
    draw = random.Random(2)
    boxes = [f"<div class='k{k}'><p>Box {k} of {words(k, 5)}</p><ul><li>item</li><li>{k}</li></ul></div>" for k in range(6)]
    rows = []
    for i in range(300):
        parts = draw.sample(boxes, draw.randrange(0, 4)) + [f"<p>{words(1000 + draw.randrange(250), draw.choice([1, 3, 12]))}</p>", "<h2>Common heading</h2>"]
        draw.shuffle(parts)
        inner = "".join(parts)
        html = draw.choice(["<body>{}</body>", "<article>{}</article>", "<main>{}</main><div>x</div>"]).format(inner)
        rows.append((i, draw.choice(["http://a.org/", "http://B.org/x", "https://c.org", None]), html))
    rows += rows[:20] + [(900, "http://a.org/", None), (901, "http://a.org/", "")]
    got = templates.extract_text(site(spark, rows), 5).collect()
    assert sorted((str(r["page_id"]), r["text"]) for r in got) == brute_force(rows, 5)
    few = templates.extract_text(site(spark, rows), 5, max_filter_bytes=64).collect()
    assert sorted(map(str, few)) == sorted(map(str, got))


ALONE = """
import sys, tempfile
sys.path.insert(0, {repo!r})
from millrace.session import local_session
import __spark_entry__ as entry
spark = local_session("2", 2, shared={shared!r})
found = entry.queries()
for name in {names!r}:
    print(name, len(found[name](spark, "/root/testdata/sf0.001").collect()))
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    """The package is on the driver's path only."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    names = ["op6_templates", "op8_warc", "op11_spelling", "op12_toxicity", "op13_phrases"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "alone.py"
    script.write_text(ALONE.format(repo=repo, shared=str(tmp_path), names=names))
    run = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    assert [line.split()[0] for line in run.stdout.splitlines()] == names


# archives

PAGES = [(i, f"http://h{i % 3}.org/ä {i}", f"<p>{'text ' * (i % 50)}{i % 17}</p>\r\n\r\n") for i in range(200)] + [
    (300, None, None), (301, "", ""), (302, "u\r\nX: y", "é😀"), (302, "u\r\nX: y", "é😀"), (None, "n", "<p>0</p>\r\n\r\n"), (303, "b", "x" * 500_000), (None, None, "alone"),
]


def expect(rows, least=0):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == data and j is not None]
        keeper = max(same, default=None)
        refers = keeper if len(data) >= least and keeper is not None and i != keeper else None
        out.append((i, len(data), warc.base32_sha1(data), "response" if refers is None else "revisit", refers))
    return sorted(map(str, out))


def archive(spark, folder, rows, **kw):
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, range int")
    return warc.write_archive(df, folder, **kw)


def records(spark, folder):
    return warc.read_archive(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("least", [0, 60])
def test_round_trip(spark, tmp_path, least):
    manifest = archive(spark, f"{tmp_path}/a", PAGES, roll_bytes=4000, range_bytes=20_000, min_revisit_bytes=least)
    assert sorted(map(str, map(tuple, records(spark, f"{tmp_path}/a").collect()))) == expect(PAGES, least)
    files = {r["name"]: r for r in manifest.collect()}
    assert len(files) > 3 and sum(r["records"] for r in files.values()) == len(PAGES)
    for name, row in files.items():
        assert os.path.getsize(f"{tmp_path}/a/{name}") == row["bytes"]
    payloads = {(r["page_id"], r["payload"]) for r in warc.read_archive(spark, f"{tmp_path}/a", with_payload=True).collect() if r["record_type"] == "response"}
    assert payloads <= {(i, h or "") for i, _, h in PAGES} and (303, "x" * 500_000) in payloads
    assert sorted(os.listdir(f"{tmp_path}/a")) == sorted([*files, "manifest"])


def test_the_same_files_whatever_the_partitions(spark, tmp_path):
    kw = {"roll_bytes": 4000, "range_bytes": 20_000}
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    warc.write_archive(df.repartition(7), f"{tmp_path}/a", **kw)
    warc.write_archive(df.coalesce(1).orderBy("html"), f"{tmp_path}/b", **kw)
    names = [n for n in os.listdir(f"{tmp_path}/a") if n.endswith(".gz")]
    assert names and sorted(names) == sorted(n for n in os.listdir(f"{tmp_path}/b") if n.endswith(".gz"))
    for n in names:
        with open(f"{tmp_path}/a/{n}", "rb") as a, open(f"{tmp_path}/b/{n}", "rb") as b:
            assert a.read() == b.read()


def test_archives_without_pages_and_files_outside_the_manifest(spark, tmp_path):
    archive(spark, f"{tmp_path}/a", [])
    (tmp_path / "a" / "part-00000-00009.warc.gz").write_bytes(gzip.compress(warc.make_record(1, "u", b"x")))
    assert records(spark, f"{tmp_path}/a").collect() == []


def test_damage_is_seen():
    good = warc.make_record(1, "u", b"payload")
    assert warc.parse_record(good)["payload"] == b"payload"
    assert warc.parse_record(warc.make_record(1, "u", b"payload", 2))["refers_to"] == 2
    for bad in (good.replace(b"payload\r\n", b"paYload\r\n"), good[:-1], b"WARC/1.0" + good[8:]):
        with pytest.raises((ValueError, KeyError)):
            warc.parse_record(bad)
    with open(os.devnull, "rb") as _, pytest.raises(ValueError):
        import io

        list(warc.read_members(io.BytesIO(gzip.compress(good)[:-9])))
