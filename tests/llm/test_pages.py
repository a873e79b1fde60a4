"""Urls, html and archives."""

from __future__ import annotations

import gzip
import hashlib
import random
import re

import pytest

from powerflow.llm import html_text, url_filter, warc
from powerflow.llm.html_text import aligned, main_text, parse
from powerflow.llm.queries import URL_RULES
from powerflow.llm.shared_files import new_folder


@pytest.fixture(scope="session")
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id long, url string, html string, id string, size int")

    return make


def test_url_rules(pages):
    cases = {
        "http://A.Com/x": ("a.com", "/x", "com/", "allow"),
        "http://m.example.com/en/1": ("m.example.com", "/en/1", "example.com/en/", "block"),
        "http://b.www.example.com/en/1": ("b.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"),
        "x://a.net/es/?q=/": ("a.net", "/es/", "net/es/", "block"),
        "x://a.net?/es/": ("a.net", "", None, "allow"),
        "x://a.com": ("a.com", "", None, "allow"),
        "a.net/es/": ("", "", None, "allow"),
        "http://É.NET/ES/#x": ("É.net", "/ES/", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    df = pages([(i, url, "") for i, url in enumerate(cases)])
    found = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(df, URL_RULES).collect()}
    assert [found[i] for i in range(len(cases))] == list(cases.values())
    assert url_filter.judge(df.filter("false"), URL_RULES).count() == 0


def test_url_templates_learn_from_rules(pages):
    """Pages of one template are blocked where nearly all of its labelled urls are; others are not."""
    rules = [("a.org", f"/bad/{n}", "block") for n in range(1, 8)] + [("a.org", "/good/1", "allow")]
    rows = [(i, f"http://a.org/bad/{i}", "") for i in range(10, 300)]
    rows += [(i, f"http://a.org/good/{i}", "") for i in range(1000, 1300)]
    found = url_filter.judge(pages([*rows, (1, "http://a.org/bad/99999x", ""), (2, "http://a.org/bad/0", "")]), rules)
    verdicts = {r["id"]: (r["rule"], r["template"], r["verdict"]) for r in found.collect()}
    assert verdicts[2] == (None, "/bad/*", "block") and verdicts[1100][1:] == ("/good/*", "allow")


def test_unruled_urls_of_a_host_differ(pages):
    """Own siblings, other hosts and the host decide in turn; nothing depends on the depth of a path."""
    rules = [("net", "/x/", "block"), ("net", "/y/", "allow"), ("all.org", "/", "block")]
    urls = [f"http://h{h}.net/{top}/{n}" for h in range(30) for n in range(3) for top in "xy"]
    urls += [f"http://a.org/{top}/{n}" for n in range(3) for top in "xyz"]
    deep = "/".join(["d"] * 12)
    urls += [f"http://all.org/{n}/q" for n in range(400)] + [f"http://a.net/{deep}/{name}" for name in ("k", "l", "k")]
    found = {r["path"]: r for r in url_filter.judge(pages([(i, u, "") for i, u in enumerate(urls)]), rules).collect() if r["host"] in ("a.org", "a.net")}
    verdicts = {path: (r["verdict"], r["evidence"]) for path, r in found.items()}
    assert verdicts["/x/1"] == ("block", "other hosts") and verdicts["/y/1"] == ("allow", "other hosts")
    assert verdicts["/z/1"] == ("allow", "all hosts")
    assert found[f"/{deep}/k"]["template"] == f"/{deep}/k" and len(found) == 11


def _purities(templates):
    """Purity of each (host, template) from ``(host, steps, allowed, blocked)`` rows, read off the definition."""
    z, w = url_filter.SAME_Z, url_filter.PRIOR_WEIGHT
    nodes = {}
    for host, steps, allowed, blocked in templates:
        for depth in range(len(steps) + 1):
            node = nodes.setdefault((host, steps[:depth]), [0, 0])
            node[0] += blocked
            node[1] += allowed + blocked
    evidence = {}
    for host, branch in nodes:
        others = [k / n for (h, b), (k, n) in nodes.items() if b == branch and h != host and n]
        evidence[host, branch] = (sum(others), len(others))
    classes, done = {}, []
    for host, branch in nodes:
        classes.setdefault((host, branch[:-1]) if branch else (host, None), []).append((host, branch))
    waiting = list(classes.values())
    while waiting:
        members = waiting.pop()
        counts = {m: (nodes[m][0] + evidence[m][0], nodes[m][1] + evidence[m][1]) for m in members}
        all_a, all_b = (sum(c[i] for c in counts.values()) for i in (0, 1))
        sides = {}
        for m, (a, b) in counts.items():
            side = 0
            if b and all_b - b:
                joint, apart = all_a / all_b, a / b - (all_a - a) / (all_b - b)
                error = max(joint * (1 - joint), 0) ** 0.5 * (1 / b + 1 / (all_b - b)) ** 0.5
                side = (apart > z * error + 1e-6) - (apart < -z * error - 1e-6)
            sides.setdefault(side, []).append(m)
        if set(sides) == {0}:
            done.append(members)
        else:
            waiting.extend(sides.values())
    pool = {m: tuple(sum(nodes[x][i] for x in members) for i in (0, 1)) for members in done for m in members}
    roots = [pool[m] for m in pool if not m[1] and pool[m][1]]
    start = sum(k / n for k, n in roots) / len(roots) if roots else 0.0
    found = {}
    for host, steps, _, _ in templates:
        purity = start
        for depth in range(len(steps) + 1):
            (k, n), (shares, hosts) = pool[host, steps[:depth]], evidence[host, steps[:depth]]
            purity = (k + w * (shares + w * purity) / (hosts + w)) / (n + w)
        found[host, "".join(steps)] = purity
    return found


def test_url_purities_are_those_of_the_definition(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(1500):
        host, top = rng.choice(["", "a", "b", "c", "c", "c", "d"]), rng.choice("pqrstu")
        steps = ["/" + top, "/" + rng.choice("mn"), "/*"][: rng.choice((0, 1, 2, 3, 3, 3))]
        labelled = host in "abc" and top != "u" and rng.random() < 0.6
        blocked = labelled and rng.random() < {"p": 0.95, "q": 0.9, "r": 0.1, "s": 0.5}.get(top, 0.0)
        rows.append((host, f"/{len(rows)}", int(labelled and not blocked), int(blocked), steps, "".join(steps)))
    schema = "host string, path string, allowed long, blocked long, steps array<string>, template string"
    for part in (rows, rows[:40], [r[:2] + (0, 0) + r[4:] for r in rows[:40]], []):
        found = {(r["host"], r["template"]): r for r in url_filter.template_purities(spark.createDataFrame(part, schema)).collect()}
        wanted = _purities([(h, tuple(steps), allowed, blocked) for h, _, allowed, blocked, steps, _ in part])
        assert found.keys() == wanted.keys()
        assert all(abs(r["purity"] - wanted[key]) < 1e-5 for key, r in found.items())


def test_url_templates_are_those_of_the_definition(spark):
    rng = random.Random(8)
    paths = {"", "/", "//", "/a/", "/a", "/a/9/x.html", "/é/1"} | {f"/{rng.choice('ab')}/{rng.choice('uvw')}{rng.randrange(90)}{rng.choice(['', '.html', '/', '/z', '/7'])}" for _ in range(400)}

    def expected(urls):
        found = {path: () for path in urls}
        waiting = [((), [(path, tuple(re.findall(r"/[^/]*", path))) for path in urls])]
        while waiting:
            node, members = waiting.pop()
            members = [(path, rest) for path, rest in members if rest]
            varies = len({rest[0] for _, rest in members}) >= url_filter.MIN_VARIETY * (len(members) + url_filter.COMMON_URLS)
            below = {}
            for path, rest in members:
                wild = [s != "/" and bool((varies and not i and len(members) > 1) or re.match(url_filter.NUMBERED, s)) for i, s in enumerate(rest)]
                steps = [("/*" + "".join(re.findall(r"\.[A-Za-z][A-Za-z0-9]{0,4}$", s))) if w else s for s, w in zip(rest, wild, strict=True)]
                taken = len(rest) if len(members) == 1 else 1
                found[path] += tuple(steps[:taken])
                below.setdefault(node + tuple(steps[:taken]), []).append((path, rest[taken:]))
            waiting.extend(below.items())
        return found

    rows = [(host, path, 0, 0) for host, some in (("h", sorted(paths)), ("i", sorted(paths)[:9])) for path in some]
    df = spark.createDataFrame(rows, "host string, path string, allowed long, blocked long")
    found = {(r["host"], r["path"]): tuple(r["steps"]) for r in url_filter.path_templates(df).collect()}
    wanted = {(host, path): steps for host in "hi" for path, steps in expected([p for h, p, *_ in rows if h == host]).items()}
    assert found == wanted and any("/*" in steps for steps in found.values())


def test_repeated_urls_count_once_for_a_template(pages):
    rules = [("a.org", "/t/1", "block"), ("a.org", "/t/2", "allow")]
    rows = [(i, f"http://a.org/t/{i}", "") for i in range(1, 60)]
    once, often = pages(rows), pages(rows + [rows[0]] * 300)
    found = [{r["id"]: (r["purity"], r["verdict"]) for r in url_filter.judge(df, rules).collect()} for df in (once, often)]
    assert found[0] == found[1] and url_filter.judge(often, rules).count() == 359


def test_main_text():
    html = """<!DOCTYPE html><title>no</title><body><header>Site</header><nav><ul><li>menu</ul></nav>
    <div class="cookie-notice">We use</div><article><h1>A &amp; B&nbsp;c</h1><p>one <b>two</b>three<p>four<br>five
    <aside>side</aside><div class="ad">buy</div><form>mail <input></form><p>six<!-- x --><script>"</p>"</script>
    <section id="comments"><p>first!</p></section></article><p>outside</p><footer>f</footer><p cla"""
    assert main_text(parse(html), []) == "A & B c one twothree four five six"
    assert main_text(parse(""), []) == "" and main_text(parse("plain"), []) == "plain"


def test_markup_does_not_take_main_text():
    """Words that only an article's own sections have, formulas and unclosed elements cost no text."""
    for name in ("social-history", "searchTheory", "related-work", "comment_theory lead"):
        assert main_text(parse(f'<article><p>a</p><div class="{name}"><p>b</p></div><section id={name.split()[0]}>c</section></article>'), []) == "a b c"
    for name in ("ad", "ad-slot-3", "cookie-notice", "x comments", "sidebar-box", "related_posts", "CommentList"):
        assert main_text(parse(f'<article><p>a</p><div class="{name}"><p>b</p></div><p>c</p></article>'), []) == "a c"
    assert main_text(parse("<article><p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b</p></article>"), []) == "a x=1 b"
    assert main_text(parse("<article><p>a <button>Copy</button> b</p><div><select><option>o<option>p</div><p>c</p></article>"), []) == "a b c"
    nested = "<b>" * 20
    assert main_text(parse(f"<article><p>{nested}one<p>two<p>three</article>"), []) == "one two three"
    assert main_text(parse("<article>" + "<div>" * 3000 + "<p>deep" + "</div>" * 3000 + "<p>end" + " word" * 50000), []).startswith("deep end word")


def test_page_differencing():
    frame = "<p>Welcome here</p><div><p>{}</p><p>{}</p></div><p>Read more</p>"
    page, other = parse(frame.format("one", "two")), parse(frame.format("three", "four"))
    assert main_text(page, [other]) == "one two"
    assert main_text(page, [page]) == "Welcome here one two Read more"  # a copy shows no frame
    assert main_text(page, [page, other]) == "one two"


def test_differencing_decides_within_and_beside_articles():
    page, *others = (
        parse(f"<p>Top</p><article><h1>Head {n}</h1><p>text {n}</p><p>Follow us</p></article><p>Imprint</p>") for n in range(3)
    )
    assert main_text(page, others) == "Head 0 text 0"
    assert main_text(page, others[:1]) == "Head 0 text 0 Follow us"  # one page alone may quote the line
    page, other = (parse(f"<p>Top</p><article>More {n}</article><p>{n} long main text</p><p>Imprint</p>") for n in range(2))
    assert main_text(page, [other]) == "More 0 0 long main text"


def test_passages_that_articles_quote_stay():
    page, *others = (
        parse(f"<article><p>By our staff</p><p>text {n}</p><p>quoted by all</p><p>more {n}</p><p>Follow us</p><p>Share</p></article>") for n in range(3)
    )
    assert main_text(page, others) == "text 0 quoted by all more 0"
    other = parse("<article><p>By our staff</p><p>text 9</p></article>")
    assert main_text(page, [*others, other]) == "text 0 quoted by all more 0 Follow us Share"  # two quotes are no frame


def test_aligned_is_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(60):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(25))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = [a[i] for i in sorted(aligned(a, b))]
        rest = iter(b)
        assert len(found) == best[-1][-1] and all(x in rest for x in found)
    assert len(aligned(["x"] * 5000, ["x"] * 5000)) == 5000


def test_lines_that_repeat_often_are_aligned_exactly(monkeypatch):
    rng = random.Random(5)
    for letters, n in (("ab", 400), ("abc", 300), ("x", 200), ("abcdefgh", 600)):
        a, b = ([rng.choice(letters) for _ in range(n + rng.randrange(50))] for _ in range(2))
        best = [0] * (len(b) + 1)
        for x in a:
            row = [0]
            for j, y in enumerate(b):
                row.append(best[j] + 1 if x == y else max(best[j + 1], row[j]))
            best = row
        found = [a[i] for i in sorted(aligned(a, b))]
        rest = iter(b)
        assert len(found) == best[-1] and all(x in rest for x in found)
    for n in range(200):  # pairs of lines and bits give the same indices
        a, b = ([rng.choice("abcd"[: n % 4 + 1]) for _ in range(rng.randrange(60))] for _ in range(2))
        ways = []
        for often in (0, 1 << 30):
            monkeypatch.setattr(html_text, "OFTEN", often)
            ways.append(aligned(a, b))
        assert ways[0] == ways[1]


def test_a_menu_of_repeated_lines_is_deleted_whole():
    """Rows of a frame that repeat a line in other numbers do not hide the frame that follows."""
    frame = ["<p>top", *["<p>row<p>" + cell for cell in "uvw"] * 40, "<p>end"]
    page, other = (parse("<p>row" * n + "".join(frame) + f"<p>the text of {n}") for n in (0, 3))
    assert main_text(page, [other]) == "the text of 0"


def test_extract_pairs_pages_of_a_host(pages):
    rows = [(i, f"http://h.org/a/{i}", f"<p>Top {host}</p><p>text {i}</p>") for i, host in enumerate("hhhh")]
    rows += [(9, "http://z.org/a/1", "<p>Top h</p><p>alone</p>"), (10, None, None), (11, "http://z.org/a/1", "")]
    df = pages(rows)
    found = {r["id"]: r["text"] for r in html_text.extract(df.coalesce(1)).collect()}
    assert len(found) == len(rows) and found[10] == "" and found[11] == ""
    assert html_text.extract(df.filter("false")).count() == 0
    # one range holds all pages here, so that every page has its neighbours
    one = html_text.extract(df).sparkSession
    shuffles = one.conf.get("spark.sql.shuffle.partitions")
    one.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = {r["id"]: r["text"] for r in html_text.extract(df).collect()}
    finally:
        one.conf.set("spark.sql.shuffle.partitions", shuffles)
    assert [found[i] for i in range(4)] == [f"text {i}" for i in range(4)]


def test_neighbours_do_not_depend_on_copies_or_ranges(spark, pages):
    """Copies are passed over, a long frame is no copy, and the cuts between ranges do not show."""
    menu = "".join(f"<p>menu {n}</p>" for n in range(30))
    rows = [(n, f"http://h.org/a/{n:03d}", f"{menu}<p>the text of article {n // 4 * 4}</p>") for n in range(60)]
    rows += [(100 + n, "http://h.org/b", f"{menu}<p>the text of article b</p>") for n in range(3)]
    rows += [(103, "http://h.org/b", f"{menu}<p>the text of article b as of later</p>")]  # versions of one page
    rows += [(200, "http://i.org/1", f"{menu}<p>alone at its host</p>")]
    wanted = {n: f"the text of article {n // 4 * 4}" for n in range(60)} | dict.fromkeys((100, 101, 102), "the text of article b")
    wanted[103] = "the text of article b as of later"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for partitions in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found = {r["id"]: r["text"] for r in html_text.extract(pages(rows)).collect()}
            assert found.pop(200).startswith("menu 0 menu 1 ") and found == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        for name, value in settings.items():
            spark.conf.set(name, value)


def test_neighbours_are_those_of_the_order_whatever_the_blocks(spark, monkeypatch):
    """Also in blocks no larger than the reach."""
    frames = {n: [f"frame {n % 3}", f"text {n}", f"frame {n % 5}", "frame"] for n in range(40)}
    places = {n: (f"h{n // 9}", f"/a/{n:02d}") for n in frames}
    rows = []
    for n, lines in frames.items():
        shape = b"".join((2 * len(line)).to_bytes(4, "little") for line in lines)
        rows.append((*places[n], bytes([n]), html_text._hashes(lines), shape))
    contents = spark.createDataFrame(rows, "host string, place string, digest binary, lines binary, shape binary")
    wanted = {}
    for n, lines in frames.items():
        near = [m for m in (n - 1, n + 1, n - 2, n + 2) if places.get(m, ("",))[0] == places[n][0]]
        near.sort(key=lambda m: -html_text._common_prefix(places[m][1], places[n][1]))
        kept = html_text.kept_lines(lines, [len(line) for line in lines], [False] * 4, [frames[m] for m in near])
        wanted[n] = sum(128 >> i for i in kept)
    for size in (2, 3, 256):
        monkeypatch.setattr(html_text, "BLOCK_PLACES", size)
        assert {r["digest"][0]: r["kept"][0] for r in html_text.lines_kept(contents).collect()} == wanted


def test_lines_of_pages_near_are_not_shuffled(spark):
    """Four pages' lines beside each page's own are five times as much to write."""
    contents = spark.createDataFrame([("h", f"/{n}", bytes([n]), b"", b"") for n in range(9)], "host string, place string, digest binary, lines binary, shape binary")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
        plan = html_text.lines_kept(contents)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Window" in plan and "Exchange" not in plan[: plan.index("Window")]


def test_archives_round_trip(spark, pages):
    big = "é" * 600
    rows = [
        (1, "http://a/1", big), (5, "http://a/ 5\n", big), (3, None, big), (None, "http://a/n", big), (2, "http://a/2", "small"),
        (4, "http://a/4", "small"), (6, "http://a/6", None), (7, "http://a/7", ""), (8, "http://a/8", "\r\n\r\nx"),
    ]
    df = pages(rows)
    folder = new_folder(spark, "test-warc")
    manifest = warc.write_archives(df, folder, file_bytes=1500)
    back = warc.read_archives(spark, folder, manifest).collect()
    assert len(back) == len(rows) and manifest.count() > 2
    html = {r[0]: (r[2] or "").encode() for r in rows}
    for r in back:
        data = html[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        revisit = r["page_id"] in (1, 3, None)
        assert r["record_type"] == ("revisit" if revisit else "response") and r["refers_to"] == (5 if revisit else None)
        assert r["payload"] == (None if revisit else data.decode())
    again = new_folder(spark, "test-warc")
    second = warc.write_archives(df.repartition(3), again, file_bytes=1500)
    assert sorted(map(tuple, manifest.collect())) == sorted(map(tuple, second.collect()))
    name = manifest.first()["file"]
    with gzip.open(f"{folder}/{name}") as file:
        assert file.read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    again = new_folder(spark, "test-warc")
    assert warc.read_archives(spark, again, warc.write_archives(df.filter("false"), again)).count() == 0


def test_damage_is_found(spark, pages):
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(b"WARC/1.1\r\nWARC-Record-ID: x\r\nWARC-Block-Digest: sha1:A\r\nContent-Length: 1\r\n\r\nab")
