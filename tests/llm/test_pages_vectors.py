"""Main text of pages, product codes, whitening."""

import hashlib
import random
import re
from fractions import Fraction
from html import unescape

import duckdb
import numpy as np
import pytest

from blockloom.llm import dom, quantize, whitening, wrappers
from blockloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def brute_match(a, b):
    """The weight of simple tree matching by its definition, on (label, children)."""
    if a[0] != b[0]:
        return 0
    w = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1]):
        for j, y in enumerate(b[1]):
            w[i + 1][j + 1] = max(w[i][j + 1], w[i + 1][j], w[i][j] + brute_match(x, y))
    return 1 + w[-1][-1]


def lines(tree, depth=0):
    return [f"{depth} {tree[0]}"] + [x for c in tree[1] for x in lines(c, depth + 1)]


def test_tree_matching_is_the_largest():
    rng = random.Random(5)

    def tree(depth):
        return (rng.choice("abc") if depth < 4 else "r", [tree(depth - 1) for _ in range(rng.randint(0, 3 if depth else 0))])

    for _ in range(150):
        a, b = tree(4), tree(4)
        found = dom.match("\n".join(lines(a)), "\n".join(lines(b)))
        assert len(found) == brute_match(a, b)
        la, lb = lines(a), lines(b)
        assert all(la[i] == lb[j] for i, j in found.items())  # same label and depth
        assert sorted(found.items()) == sorted(found.items(), key=lambda x: x[1]) and len(set(found.values())) == len(found)  # in order, one to one


def text_of(html):
    return " ".join(t for _, t in wrappers._blocks(dom.Page(html)))


@pytest.mark.parametrize(
    "html,want",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b<br>c", "a b c"),
        ("<p>a<b>b</b>c &lt;d&gt; &am</p>", "abc <d> &am"),
        ("<body><nav>x</nav><article><h1>t</h1><p>one\n two&nbsp;three</p></article><footer>f</footer>", "t one two three"),
        ("<body><article><p>a</p><div class='ad'>buy</div><aside>s</aside><p>b</p><section class='comments'><article><p>c</p></article></section></article>", "a b"),
        ("<body><form><article><p>a<input><button>go</button></p></article>search</form>", "a"),
        ("<script>var t='</p><article>';</script><style>p{}</style><article><p>a<!-- <p>b</p> -->c</article>", "ac"),
        ("<head><title>t</title><body><div id='cookie-notice'>ok?</div><div class='main-content with-sidebar'><p>a</p></div><div class='sidebar-left'>x</div>", "a"),
        ("<header>site</header><article><header><h1>t</h1></header><p>a</p></article>", "t a"),
        ("<main><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul></main>", "a b c d e"),
        ("<div><a href=x>home</a> <a href=y>news</a></div><div><p>text with <a href=z>link</a> in it</p></div>", "text with link in it"),
        ("<article></article><div><p>elsewhere</p></div>", "elsewhere"),
        ("<article><p title='a>b'>x</p><span class='ad'>buy <span>now</span></span><p hidden>h</p><p style='display: none'>n</p>y</article>", "x y"),
        ("<article><p>a</div></p>b</article> <!-- open", "a b"),
    ],
)
def test_reading_of_markup(html, want):
    assert text_of(html) == want


def test_deep_and_long_pages_are_read_whole():
    deep = "<div>" * 20000 + "x" + "</div>" * 20000 + "<p>y"
    assert text_of(deep) == "x y"
    words = [f"w{i}" for i in range(100000)]
    assert text_of("<article>" + "".join(f"<p>{w}</p><ul><li>{w}</ul>" for w in words) + "</article>").split() == [w for w in words for _ in "ab"]
    page = dom.Page("<article>" + "".join(f"<p>{w}<div><b>{w}</b><table><tr><td>{w}</table></div>" * 3 + "<h2>h</h2>" * (i % 3) for i, w in enumerate(words[:3000])))
    assert page.skeleton.count("\n") < 300


def test_main_text_of_the_given_pages(spark):
    """In these tables the main text is the article element."""
    got = {r["page_id"]: r for r in QUERIES["op11_main_text"](spark, SF).collect()}
    rows = duckdb.execute(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, url, html in rows:
        inner = re.sub(r"</?(p|h1|br)>", " ", re.search(r"<article>(.*?)</article>", html, re.S)[1]).replace("<b>", "")
        want = " ".join(unescape(inner).split())
        assert (got[i]["url"], got[i]["text"], got[i]["n_chars"]) == (url, want, len(want))


def planted(host, n, rng):
    """Pages without telling names: constant blocks around one to four paragraphs, an optional block on every third."""
    words = lambda k: " ".join(f"w{rng.randrange(10**6)}" for _ in range(k))
    out = []
    for i in range(n):
        body = [words(30 + j) for j in range(rng.randint(1, 4))]
        note = "<div><p>You read an article of the series</p></div>" if i % 3 == 0 else ""
        html = f"<body><div><p>Welcome to {host}</p><p>Log in here</p></div><div>{note}<h2>{body[0][:40]}</h2>{''.join(f'<p>{b}</p>' for b in body)}</div><div><p>All rights reserved</p></div>"
        out.append((f"https://{host}/{i}", html, " ".join([body[0][:40].rstrip(), *body])))
    return out


def test_templates_are_induced_from_pages_of_a_host(spark):
    rng = random.Random(3)
    many, few = planted("many.example", 60, rng), planted("few.example", 3, rng)
    copies = planted("copies.example", 1, rng) * 20  # one article twenty times is no template
    rows = [(i, u, h) for i, (u, h, _) in enumerate([*many, *few, *copies])]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(60)] == [w for *_, w in many]
    for i, (_, _, w) in enumerate([*few, *copies], 60):  # too few different pages: nothing is taken for a template
        assert got[i].startswith("Welcome to") and w in got[i] and got[i].endswith("All rights reserved")


def test_odd_pages(spark):
    rows = [(None, None, None, 1), (1, None, "<p>a</p>", 2), (1, "x", "", 3), (2, "http://h/", "<p>a</p>", 4), (2, "http://h/", "<p>a</p>", 5), (3, "HTTP://u:p@H:80/", "<article>" + "word " * 300000, 6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted((r["page_id"] or -1, r["url"] or "", r["text"][:9], r["n_chars"]) for r in wrappers.extract(df).collect())
    assert got == [(-1, "", "", 0), (1, "", "a", 1), (1, "x", "", 0), (2, "http://h/", "a", 1), (2, "http://h/", "a", 1), (3, "HTTP://u:p@H:80/", "word word", 1499999)]
    assert wrappers.host_of(rows[-1][1]) == "h"
    assert wrappers.extract(df.limit(0)).collect() == []


def frequent_and_rare_keys_agree(spark, monkeypatch, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    one = sorted(map(tuple, wrappers.extract(df).collect()))
    monkeypatch.setattr(wrappers, "HOT_SHARE", 3)
    assert sorted(map(tuple, wrappers.extract(df).collect())) == one


def test_shuffled_and_broadcast_lookups_agree(spark, monkeypatch):
    rng = random.Random(9)
    pages = [*planted("a.example", 40, rng), *planted("b.example", 12, rng), *planted("c.example", 7, rng)]
    frequent_and_rare_keys_agree(spark, monkeypatch, [(i, u, h) for i, (u, h, _) in enumerate(pages)])


def codes(rows, d):
    """The contract of the product codes in plain Python: rows of (vec_id, label, integers)."""
    cut = [range(j * d // 8, (j + 1) * d // 8) for j in range(8)]
    first = [x for _, _, x in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:16]]
    books = [[[x[i] for i in p] for x in first] for p in cut]

    def best(x, j):
        return min((sum((x[i] - v) ** 2 for i, v in zip(cut[j], e)), k) for k, e in enumerate(books[j]))

    for _ in range(6):
        own = [[best(x, j)[1] for _, _, x in rows] for j in range(8)]
        for j, p in enumerate(cut):
            for k in range(len(books[j])):
                mine = [x for (_, _, x), o in zip(rows, own[j]) if o == k]
                if mine:
                    books[j][k] = [sum(x[i] for x in mine) // len(mine) for i in p]
    out = []
    for i, label, x in rows:
        found = [best(x, j) for j in range(8)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(e for e, _ in found)))
    labels = {}
    for _, label, _, e in out:
        labels[label] = labels.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [(i, c, e, labels[label], sha) for i, label, c, e in out]


def test_codes_equal_the_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(ORACLE_SQL["op12_vector_codes"])
    names = [c[0] for c in want.description]
    df = QUERIES["op12_vector_codes"](spark, SF)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("scale", [1.0, 1e-3, 3e5, 1e12])
def test_codes_equal_brute_force(spark, scale, monkeypatch):
    rng = np.random.default_rng(2)
    base = (rng.integers(-40, 40, (90, 8)) / 8.0 * scale).tolist()
    rows = [(i % 80, i % 5 if i % 7 else None, base[i], "x") for i in range(90)] + [(None, 1, base[3], "y"), (5, 2, base[4], "z")]
    odd = [(200, 1, None, ""), (201, 1, [float("nan")] * 8, ""), (202, 1, [1.0, None] * 4, ""), (203, None, [float("inf")] * 8, ""), (204, 1, [1.0] * 9, "")]
    df = spark.createDataFrame(rows + odd, "vec_id long, label int, embedding array<double>, code string").repartition(3)
    ints = [(i, label, [int(Fraction(v) * 4096 // 1) for v in x]) for i, label, x, _ in rows]
    wide = lambda v: v if v < 1 << 63 else None
    key = lambda r: tuple((x is None, x or 0) for x in r)
    want = sorted(((i, c, wide(e), wide(s), h) for i, c, e, s, h in codes(ints, 8)), key=key)
    assert sorted(map(tuple, quantize.compress(df).collect()), key=key) == want
    monkeypatch.setattr(quantize, "HOT_SHARE", 3)
    assert sorted(map(tuple, quantize.compress(df).collect()), key=key) == want


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, 0, [0.5] * 16), (1, None, [0.5] * 16), (2, 0, [-0.5] * 16)], "vec_id int, label int, embedding array<float>")
    got = quantize.compress(df).collect()
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == [(1, "00" * 8, 0, 0)] * 2 + [(2, "02" * 8, 0, 0)]
    assert quantize.compress(df.limit(0)).collect() == [] and whitening.whiten(df.limit(0)).collect() == []
    assert quantize.compress(df.where("embedding is null")).collect() == []


def test_spectral_division_equals_eigh():
    rng = np.random.default_rng(1)
    for n, e in ((1, [2.0]), (2, [1.0, 1.0]), (7, range(7)), (64, rng.random(64)), (64, [*rng.random(5), *[0.0] * 59]), (90, 10.0 ** -np.linspace(0, 10, 90)), (40, np.repeat([1, 2, 3, 4], 10))):
        q, _ = np.linalg.qr(rng.standard_normal((n, n)))
        a = (q * np.array(list(e), float)) @ q.T
        a = (a + a.T) / 2
        values, vectors = whitening.eigenvectors(a)
        top = np.abs(a).max()
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * top
        assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13 and np.abs(a @ vectors - vectors * values).max() < 1e-13 * top
    a = rng.standard_normal((50, 50))
    a = a + a.T
    u, _, vt = np.linalg.svd(a)
    assert np.abs(whitening.polar(a) - u @ vt).max() < 1e-12


def white(x):
    """Deviations and covariance of integer rows, exactly."""
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    deviation = [sum((n * v - t) ** 2 for v, t in zip(r, s)) for r in x]
    cov = [[float(Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3)) for j in range(d)] for i in range(d)]
    return deviation, np.array(cov), s


@pytest.mark.parametrize("scale,d", [(1.0, 40), (1e-2, 5), (1e7, 5)])
def test_whitening_equals_exact_arithmetic(spark, scale, d):
    rng = np.random.default_rng(4)
    c = (rng.standard_normal((70, d)) * np.linspace(3, 1, d) * scale).tolist()
    rows = [(i if i % 9 else None, v, 1) for i, v in enumerate(c)] + [(3, c[3], 2)]
    odd = [(200, None, 1), (201, [float("nan")] * d, 1), (202, [None] * d, 1), (203, [1.0] * (d + 1), 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, component int").repartition(3)
    x = [[int(np.floor(64 * v)) + 1000000 for v in r] for _, r, _ in rows]
    deviation, cov, s = white(x)
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    got = whitening.whiten(df).collect()
    k = min(32, d)
    assert len(got) == k * len(rows)
    wide = lambda v: v if v < 1 << 63 else -1
    assert sorted(r["deviation"] if r["deviation"] is not None else -1 for r in got if r["component"] == 1) == sorted(map(wide, deviation))
    for j in range(k):
        mine = sorted(r["whitened"] for r in got if r["component"] == j + 1)
        want = (np.array([[v - float(Fraction(t, len(x))) for v, t in zip(r, s)] for r in x]) @ q[:, j]) / np.sqrt(e[j])
        assert np.abs(np.abs(mine) - np.abs(sorted(want))).max() < 1e-6 or np.abs(np.array(mine) + np.sort(want)[::-1]).max() < 1e-6
        assert abs(next(r["explained"] for r in got if r["component"] == j + 1) - e[j] / np.trace(cov)) < 1e-9
    assert {r["n"] for r in got} == {71} and 0 <= got[0]["identity_error"] < 1e-9


def test_components_without_variance_are_null(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0])], "vec_id int, embedding array<float>")
    got = whitening.whiten(df).collect()
    assert [r["whitened"] is None for r in sorted(got, key=lambda r: r["component"])] == [False] * 3 + [True] * 3
    assert {round(r["explained"], 12) for r in got} == {0.0, 1.0} and got[0]["identity_error"] < 1e-9
    one = whitening.whiten(df.where("vec_id = 1")).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 2
