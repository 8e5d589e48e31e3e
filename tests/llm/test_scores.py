"""Toxicity, mixing, secrets and pages against brute-force versions, and on odd tables."""

import collections
import hashlib
import math
import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from wakeline.llm import html_extract as pages
from wakeline.llm import mixing, secrets, toxicity


# ---- toxicity -------------------------------------------------------------------------------------------------------------


def toxic_corpus(words, n=600):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        w = words(rng.randint(5, 60))
        bad = i % 6 == 0
        if bad:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randint(0, len(w)), rng.choice(["blorgh", "zaxxer", "zaxxing", "Zaxxish"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, words):
    rows, labels = toxic_corpus(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learnt = spark.createDataFrame([x for x in labels if x[0] % 4], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, learnt).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    held = [(y, got[i].score >= 0.3) for i, y in labels if i % 4 == 0]
    assert sum(p for y, p in held if y) >= 0.95 * sum(y for y, _ in held)
    assert not any(p for y, p in held if not y)
    proof = got[0].evidence
    assert proof and all(e.label == 1 and e.id != 0 for e in proof) and proof[0].cosine >= proof[-1].cosine > 0
    kept = toxicity.reject_toxic(docs.withColumn("id", F.lit("x")), learnt)
    assert kept.columns == ["doc_id", "text", "id"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.score < 0.3}


def test_the_index_finds_the_nearest():
    rng = random.Random(8)

    def unit():
        v = {t: rng.random() for t in rng.sample(range(40), rng.randint(1, 12))}
        n = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / n for t, x in v.items()}

    vectors = [unit() for _ in range(500)]
    index = toxicity.BlockMaxIndex(vectors, 16)
    for q in [unit() for _ in range(60)]:
        exact = sorted(((-sum(x * v.get(t, 0) for t, x in q.items()), i) for i, v in enumerate(vectors)))
        got = index.nearest(q, 10, but=[exact[0][1]])
        want = [(-s, i) for s, i in exact[1:] if s < 0][:10]
        assert [i for _, i in got] == [i for _, i in want]
        assert all(abs(a - b) < 1e-9 for (a, _), (b, _) in zip(got, want))


def test_toxicity_scores_by_brute_force(spark, words):
    import numpy as np

    rows, labels = toxic_corpus(words, 240)
    rows += [(1000 + i, rows[i][1]) for i in range(0, 40, 2)] + [(2000, None), (2001, "")]  # copies of examples
    learnt = {i: y for i, y in labels if i % 4}
    got = {r.doc_id: r.score for r in toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(learnt.items()), "doc_id long, toxic int")).collect()}
    bag = {i: collections.Counter(t for w in re.findall(r"\w+", (x or "").lower()) for t in toxicity.word_terms(w)) for i, x in rows}
    text = dict(rows)
    toxic, clean = [i for i in learnt if learnt[i]], [i for i in learnt if not learnt[i]]

    def ratio(t):
        table = np.array([[sum(t in bag[i] for i in s), sum(t not in bag[i] for i in s)] for s in (toxic, clean)], float)
        if table[0, 0] / len(toxic) <= table[1, 0] / len(clean):
            return 0
        share = (table[0, 0] + table[1, 0]) / len(learnt)
        return 2 * sum(n * math.log(n / (len(s) * share)) for n, s in zip(table[:, 0], (toxic, clean)) if n)

    terms = sorted(t for t in {t for i in toxic for t in bag[i]} if ratio(t) >= toxicity.LEAST_GAIN)
    idf = {t: math.log((1 + len(rows)) / (1 + sum(t in b for b in bag.values()))) + 1 for t in terms}

    def vector(i):
        v = np.array([(1 + math.log(bag[i][t])) * idf[t] if bag[i][t] else 0.0 for t in terms])
        return v / (np.linalg.norm(v) or 1)

    rate = (len(toxic) + 0.5) / (len(learnt) + 1)
    some = sorted((i for i in learnt if vector(i).any()), key=lambda i: ([k for k, t in enumerate(terms) if bag[i][t]], [bag[i][t] for t in terms if bag[i][t]], i))

    def vote(i):
        near = sorted(((-round(float(vector(i) @ vector(j)), 12), k, j) for k, j in enumerate(some) if text[j] != text[i]))
        near = [(-s, j) for s, _, j in near if s < 0][: toxicity.NEIGHBOURS]
        w = [1 / (1.05 - s) for s, _ in near]
        return (sum(x for x, (_, j) in zip(w, near) if learnt[j]) + toxicity.PRIOR_VOTES * rate) / (sum(w) + toxicity.PRIOR_VOTES)

    knots = toxicity.isotonic(np.array([vote(i) for i in some]), np.array([learnt[i] for i in some]))
    rest = [learnt[i] for i in learnt if not vector(i).any()]
    empty = (sum(rest) + rate) / (len(rest) + 1)
    assert terms and some
    for i, _ in rows:
        assert abs(got[i] - (np.interp(vote(i), *knots) if vector(i).any() else empty)) < 1e-6, i


def test_calibration_rises():
    import numpy as np

    rng = np.random.default_rng(9)
    raw = rng.random(400)
    xs, ys = toxicity.isotonic(raw, (rng.random(400) < raw).astype(int))
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= 0).all() and abs(np.interp(0.5, xs, ys) - 0.5) < 0.2


def test_toxicity_on_odd_tables(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (5, 0), (8, None), (None, 1), (7, 0), (77, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score < 0.3 for r in rows)
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.reject_toxic(odd, labels).count() == odd.count()


# ---- mixing ---------------------------------------------------------------------------------------------------------------


def mixed(rows, repeats, cover=False):
    """mix_sources by its definition: rows are (doc_id, text, source)."""
    tokens = {i: len((t or "").split()) for i, t, _ in rows}
    of = {i: s for i, _, s in rows}
    total = collections.Counter()
    for i, s in of.items():
        total[s] += tokens[i]
    full = {s: n for s, n in total.items() if n}
    every = sum(full.values())

    def weights(a):
        z = sum(n**a for n in full.values())
        return {s: n**a / z for s, n in full.items()}

    def good(a):
        r = [w * every / full[s] for s, w in weights(a).items()]
        return max(r) / (min(r) if cover else 1) <= repeats + 1e-9

    low, high = 0.0, 1.0
    if good(0.0):
        high = 0.0
    else:
        for _ in range(30):
            mid = (low + high) / 2
            low, high = (low, mid) if good(mid) else (mid, high)
    w = weights(high)
    budget_all = int(1 / min(w[s] / n for s, n in full.items())) if cover else every
    number = lambda *x: int(hashlib.md5("|".join(["mix", *x]).encode()).hexdigest()[:15], 16)
    out = {}
    for s in total:
        key = "" if s is None else "=" + s
        mine = [i for i in of if of[i] == s]
        if not total[s]:
            out |= {i: 1 for i in mine}
            continue
        budget = math.floor(round(w[s], 9) * budget_all)
        budget = max(budget, total[s]) if cover else budget
        passes, room = divmod(budget, total[s])
        count = max(1, -(-total[s] // mixing.BLOCK_TOKENS))
        blocks = collections.defaultdict(list)
        for i in mine:
            blocks[number(key, str(i)) % count].append(i)
        used, taken = 0, set()
        for b in sorted(blocks, key=lambda b: (number(key, "block", str(b)), b)):
            n = sum(tokens[i] for i in blocks[b])
            if used + n <= room:
                used += n
                taken |= set(blocks[b]) if room else set()
                continue
            for i in sorted(blocks[b], key=lambda i: (number(key, "document", str(i)), str(i))):
                used += tokens[i]
                if used > room or not room:
                    break
                taken.add(i)
            break
        out |= {i: passes + (i in taken) for i in mine}
    return out, high


@pytest.mark.parametrize(("repeats", "cover"), [(1.3, False), (4.0, False), (2.0, True)])
def test_mixing(spark, words, monkeypatch, repeats, cover):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 300)
    rng = random.Random(10)
    sources = ["a"] * 60 + ["b"] * 25 + ["c"] * 10 + ["d"] * 4 + [None]
    rows = [(i, " ".join(words(rng.randint(0, 60))), rng.choice(sources)) for i in range(400)]
    want, alpha = mixed(rows, repeats, cover)
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), repeats=repeats, cover=cover).collect()
    assert {r.doc_id: r.mix_copies for r in got} == want
    if cover:
        assert min(want.values()) == 1
    taken = sum(r.mix_copies * r.mix_tokens for r in got)
    assert 0 < alpha < 1 or alpha == 0
    assert cover or abs(taken - sum(r.mix_tokens for r in got)) < 400


def test_target_entropy(spark):
    sources = spark.createDataFrame([("a", 8000), ("b", 1500), ("c", 500)], "mix_source string, tokens long")
    target = 0.9
    a = mixing.exponent(sources, 1e9, target)
    w = [n**a for n in (8000, 1500, 500)]
    w = [x / sum(w) for x in w]
    assert abs(-sum(x * math.log(x) for x in w) - target) < 1e-6


def test_mixing_on_odd_tables(spark, odd, none):
    rows = mixing.mix_sources(odd, repeats=2.0).collect()
    assert len(rows) == odd.count() and {r.mix_source for r in rows} == {None, "s"}
    assert mixing.mix_sources(none).count() == 0
    clash = odd.withColumns({c: F.lit("x") for c in ("room", "blocks", "edge", "last", "weight", "turn", "place", "__id", "Passes")})
    got = mixing.mix_sources(clash, repeats=2.0)
    assert {tuple(r) for r in got.select("room", "blocks", "edge", "last", "weight", "turn", "place", "__id", "Passes").collect()} == {("x",) * 9}
    assert sorted(r.mix_copies for r in got.select("mix_copies").collect()) == sorted(r.mix_copies for r in rows)
    empty = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [r.mix_copies for r in mixing.mix_sources(empty).collect()] == [1, 1]


# ---- secrets --------------------------------------------------------------------------------------------------------------


def base_spans(x):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", x, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", x) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", x) if len(m[0]) >= 32]
    return sorted(out)


def test_base_spans(spark):
    rng = random.Random(11)
    bits = ["password=", "Token : '", "API_KEY\"=", "apikey:", "secret==", "abc", "12345678", "AKIA", "AKIAABCDEFGHIJKL", "é😀", " ", "\n", "0123456789abcdef" * 2, "deadbeef", "x.y/z+w", "PASSWD  =  ", "token=secret : abcdefghij", "ſecret=12345678"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(600)]
    rows = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        assert [tuple(x) for x in r.base] == base_spans(texts[r.doc_id])
        assert [x for x in r.spans if x.kind != "random"] == r.base


def test_the_battery_tells_random_from_words(spark, words):
    rng = random.Random(12)
    draw = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    texts = []
    for i in range(600):
        t = " ".join("".join(words(5)) for _ in range(5))
        t += {0: " " + draw(40, string.ascii_letters + string.digits + "+/"), 1: " /usr/local/share/documentation/readme-first-12", 2: " " + "ab-" * 14}.get(i % 10, "")
        texts.append(t)
    rows = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = collections.Counter(r.doc_id % 10 for r in rows if r.spans)
    assert found[0] >= 36 and sum(found.values()) - found[0] <= 1
    for r in rows:
        for x in r.spans:
            assert texts[r.doc_id][x.s : x.e] in texts[r.doc_id].split(" ")


@pytest.mark.parametrize("paths", [0, 3000])
def test_a_random_key_is_found_in_a_small_table_and_among_paths(spark, words, paths):
    rng = random.Random(13)
    keys = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n)) for n in (24, 32, 40)]
    texts = [f"see {k} here" for k in keys]
    texts += ["/" + "/".join(words(rng.randint(5, 8))) + f"/v{i % 7}" for i in range(paths)] + ["/usr/share/doc/common-files/a-b-c"] * paths
    rows = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {texts[r.doc_id][x.s : x.e] for r in rows for x in r.spans}
    assert found == set(keys)


def test_one_random_token_in_each_of_many_documents(spark, words):
    rng = random.Random(14)
    kinds = [string.ascii_letters + string.digits, string.ascii_lowercase, string.ascii_uppercase, string.ascii_uppercase + "234567", string.ascii_letters + string.digits + "+/"]
    keys = ["".join(rng.choice(kinds[i % 5]) for _ in range(40)) for i in range(300)]
    texts = [" ".join([*words(20), k, *words(20), "".join(words(12))]) for k in keys]
    rows = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = [(texts[r.doc_id][x.s : x.e], keys[r.doc_id]) for r in rows for x in r.spans]
    assert sum(a == b for a, b in found) >= 285 and sum(a != b for a, b in found) <= 3


def test_a_row_with_very_many_matches(spark):
    rng = random.Random(15)
    hexes = ["%040x" % rng.getrandbits(160) for _ in range(20_000)]
    text = "é ".join(hexes) + " token=abcdefghij_" + "k3j9" * 9
    began = time.perf_counter()
    got = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(x) for x in got.base] == base_spans(text) and len(got.base) == 20_001 and got.spans == got.base
    assert time.perf_counter() - began < 60


def test_tokens_that_overlap_are_left_out(spark):
    rng = random.Random(16)
    for _ in range(5):
        draw = lambda n: [(a, a + rng.randint(1, 6)) for a in sorted(rng.sample(range(400), n))]
        tokens, others = draw(150), draw(20)
        df = spark.createDataFrame([([(*t, "x") for t in tokens], others)], "tokens array<struct<s:int,e:int,t:string>>, others array<struct<s:int,e:int>>")
        got = df.select(F.expr(secrets.apart("tokens", "others")).alias("x")).first().x
        assert [(x.s, x.e) for x in got] == [t for t in tokens if not any(o[0] < t[1] and t[0] < o[1] for o in others)]


def fisher(token):
    """The battery by its definition, in plain Python."""
    kind = next(k for k in secrets._ALPHABETS.values() if set(token) <= set(k) and (len(k) not in (16, 32) or re.search("[0-9]", token)))
    v, k, n = [kind.index(c) for c in token], len(kind), len(token)
    chi, df = sum((c - n / k) ** 2 / (n / k) for c in (v.count(x) for x in range(k))), k - 1
    up = [x >= k / 2 for x in v]
    n1, n0 = sum(up), n - sum(up)
    runs = 1 + sum(a != b for a, b in zip(up, up[1:]))
    mean, var = 1 + 2 * n1 * n0 / n, 2 * n1 * n0 * (2 * n1 * n0 - n) / (n * n * (n - 1))
    m = sum(v) / n
    r = sum((a - m) * (b - m) for a, b in zip(v, v[1:])) / sum((x - m) ** 2 for x in v)
    z = [((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)), abs(runs - mean) / math.sqrt(var), abs(r) * math.sqrt(n)]
    tail = [0.5 * math.erfc(x / math.sqrt(2)) for x in z]
    return -2 * sum(math.log(p) for p in (tail[0], min(1, 2 * tail[1]), min(1, 2 * tail[2])))


def test_the_battery_by_its_definition(spark):
    rng = random.Random(17)
    tokens = ["".join(rng.choice(a) for _ in range(rng.randint(20, 80))) for a in secrets._ALPHABETS.values() for _ in range(30)]
    tokens = [t for t in tokens if re.search("[0-9]", t) or re.fullmatch("[a-z]+|[A-Z]+", t)]
    df = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", F.expr(secrets.randomness("t")).alias("x"))
    for r in df.collect():
        assert abs(r.x - fisher(r.t)) < 0.02 * max(1, fisher(r.t)), r.t


def test_secrets_on_odd_tables(odd, none):
    rows = secrets.find_secrets(odd).collect()
    assert len(rows) == odd.count()
    assert [[tuple(x) for x in r.base] for r in rows if r.doc_id == 7] == [[(0, 0, 17, "assign")]] * 2
    assert secrets.find_secrets(none).count() == 0


# ---- pages ----------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>";</script></head><body class="home"><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
<{main}><h1>Title {i}</h1><p>First &amp; &lt;b&gt; &#233;  text<br>of {i}<p>Second <b>bold</b> part{i}<form><input><p>Name</p></form><div class="ad">Buy</div>
<ul><li>one</li><li>two</li></ul><section id="comments"><p>Nice</p></section></{main}><aside>Side</aside><footer>&copy; me</footer></body></html>"""


def truth(i):
    return "\n\n".join([f"Title {i}", f"First & <b> é text of {i}", f"Second bold part{i}", "one", "two"])


@pytest.mark.parametrize("main", ["article", "main", 'div class="story"'])
def test_pages(spark, main):
    rows = [(i, f"https://{'one' if i < 6 else 'two'}.example.org/{i}", PAGE.format(main=main, i=i).replace(f"</{main}>", f"</{main.split()[0]}>")) for i in range(8)]
    got = {r.page_id: r for r in pages.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: r.text for i, r in got.items()} == {i: truth(i) for i in range(8)}
    assert all(r.slot for r in got.values())


@pytest.mark.parametrize("mark", ['class="post comments-open"', 'title="the hidden valley"', 'data-id="comment-count-7"', 'class="share-price-table"', 'id="advice"', "data-hidden=no class='news-letters'"])
def test_names_that_only_look_like_no_article(mark):
    assert pages.extract(f"<body><article><div {mark}><p>kept</p></div></article></body>")[0] == "kept"
    assert pages.extract(f"<body><div {mark}><h1>T</h1><p>kept</p></div></body>")[0] == "T\n\nkept"


@pytest.mark.parametrize("mark", ['class="cookie-notice"', 'class="siteFooter"', "id=comments", "hidden", 'role="navigation"', 'class="x sidebar-left"', "class='related-posts'"])
def test_names_that_are_no_article(mark):
    assert pages.extract(f"<body><article><p>kept</p><div {mark}><p>gone</p></div></article></body>")[0] == "kept"


def test_a_named_container_around_the_only_article():
    assert pages.extract("<div class='sidebar-right'><article><p>a</p></article></div>")[0] == "a"
    assert pages.extract("<article><p>a</p></article><div class=comments><article><p>b</p></article></div>")[0] == "a"


def test_all_slots_of_nested_and_of_plain_markup(spark):
    nested = "<body><nav><p>n{0}</p></nav><article><div class=title><h1>T{0}</h1></div><div class=body><p>one {0}</p></div><p class=n>Read our letters</p><div class=more><p>two {0}</p></div></article></body>"
    plain = "<body><div class=top>The Daily</div><div class=head><h1>T{0}</h1></div><div class=text><p>Some long text of page {0}</p><p>More long text of {0}</p></div><div class=end>All rights reserved by us, all of them and for ever</div></body>"
    rows = [(i, f"http://{'n' if i < 5 else 'p'}/{i}", (nested if i < 5 else plain).format(i)) for i in range(10)]
    got = {r.page_id: r for r in pages.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(5):
        assert got[i].text == f"T{i}\n\none {i}\n\nRead our letters\n\ntwo {i}" and got[i].slot == "body>article"
        assert got[i + 5].text == f"T{i + 5}\n\nSome long text of page {i + 5}\n\nMore long text of {i + 5}" and got[i + 5].slot == "body"
    copies = spark.createDataFrame([(i, "http://c/1", nested.format(1)) for i in range(9)], "page_id long, url string, html string")
    assert {r.text for r in pages.html_extract(copies).collect()} == {"T1\n\none 1\n\nRead our letters\n\ntwo 1"}


def test_templates_against_brute_force(spark):
    rng = random.Random(18)
    fixed = [f"fixed {i}" for i in range(8)]
    rows = []
    for i in range(60):
        parts = [f for f in fixed if rng.random() < (0.95 if f < "fixed 5" else 0.4)]
        if rng.random() < 0.2:
            parts = parts[::-1]
        for _ in range(6):
            parts.insert(rng.randint(0, len(parts)), f"own {i} {rng.random()}")
        rows.append((i, f"http://h{i % 4}/", "<body>" + "".join(f"<p>{x}</p>" for x in parts)))
    got = {r.page_id: r.text.split("\n\n") for r in pages.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, url, page in rows:
        mine = re.findall("<p>(.*?)</p>", page)
        host = [re.findall("<p>(.*?)</p>", x) for _, u, x in rows if u == url]
        often = {t for t in mine if sum(t in x for x in host) >= max(3, len(host) / 2)}
        assert [x for x in mine if x not in often] == [x for x in got[i] if x not in often]
        place = {t: sum(x.index(t) / (2 + len(x)) for x in host if t in x) / sum(t in x for x in host) for t in often}
        at = [(place[t], t) for t in mine if t in often]
        best = [1] * len(at)
        for k in range(len(at)):
            best[k] = 1 + max([best[j] for j in range(k) if at[j] < at[k]], default=0)
        assert len(mine) - len(got[i]) == max(best, default=0)


def extracted(spark, htmls, host="t"):
    rows = [(i, f"http://{host}/{i}", x) for i, x in enumerate(htmls)]
    got = {r.page_id: r.text.split("\n\n") for r in pages.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    return [got[i] for i in range(len(rows))]


@pytest.mark.parametrize("tag", ["article", "main"])
def test_the_template_decides_on_marked_pages_too(spark, tag):
    """A marked element that the host's template fills is no article; one with an open slot is, whole."""
    promo = f"<{tag} class=club><p>Become a member of our club today</p></{tag}>"
    story = "<div class=story><h1>T{0}</h1><p>The story of page {0}, told at some length</p></div>"
    assert extracted(spark, [f"<body>{promo}{story.format(i)}</body>" for i in range(5)]) == [[f"T{i}", f"The story of page {i}, told at some length"] for i in range(5)]
    marked = f"<{tag}><h2>Our story</h2><p>Own text of page {{0}}, told at some length</p></{tag}>"
    assert extracted(spark, [f"<body>{promo}{marked.format(i)}</body>" for i in range(5)]) == [["Our story", f"Own text of page {i}, told at some length"] for i in range(5)]
    assert extracted(spark, [f"<body>{promo}</body>"] * 5 + [f"<body>{promo}{promo}</body>"]) == [["Become a member of our club today"]] * 5 + [["Become a member of our club today"] * 2]


def test_slots_are_extracted_whole(spark):
    page = "<body><div class=top>The Daily</div><div class=wrap><div class='post-{0}'><h1>T{0}</h1><p>{1}</p></div><div class='more-{0}'><p>last {0}</p></div></div><div class=end>All rights reserved</div></body>"
    long = "some long text " * 10
    want = [[f"T{i}", f"{long}{i}", f"last {i}"] for i in range(5)]
    assert extracted(spark, [page.format(i, long + str(i)) for i in range(5)]) == want
    # a class of the body that names the page hides no template
    assert extracted(spark, [page.replace("<div class=wrap>", "").replace("</div></div><div class=end>", "</div><div class=end>").replace("<body", "<body class='home postid-{0}'").format(i, long + str(i)) for i in range(5)]) == want


def test_roles_in_the_gaps_of_the_root_class(spark):
    """Texts that recur are template in each gap where most pages have them, and nowhere else; a root class out of order is cut."""
    rng = random.Random(19)
    htmls, own, swapped = [], [], []
    for i in range(24):
        mine = iter([f"own {i} {k}" for k in range(40)])
        some = lambda n: [x for _ in range(n) for x in (next(mine), "Share this")]
        parts = ["Top", "Rule", *some(rng.randint(2, 4)), "Middle", "Rule", *some(rng.randint(2, 4)), "Bottom", next(mine), "Rule"]
        parts += [next(mine)] + ["Share this"] * (i == 7)
        ends = ["X", next(mine), "Y"]
        parts += ends[::-1] if i == 11 else ends
        htmls.append("<body>" + "".join(f"<p>{x}</p>" for x in parts))
        own.append([x for x in parts if x.startswith("own") or i == 7 and x == "Share this"])
        swapped.append(i == 11)
    for i, got in enumerate(extracted(spark, htmls)):
        if i == 7:
            assert [x for x in got if x != "Share this"] == [x for x in own[i] if x != "Share this"] and got.count("Share this") == 1
        elif swapped[i]:
            assert [x for x in got if x not in "XY"] == own[i] and len(got) == len(own[i]) + 1
        else:
            assert got == own[i]


def test_a_page_along_the_root_class():
    import tracemalloc

    assert pages.along([9, 1, 2, 9, 1, 3], [1, 2, 1, 3]) == {1: 0, 2: 1, 4: 2, 5: 3}
    assert pages.along([1, 3, 2, 4], [1, 2, 3, 4]) in ({0: 0, 1: 2, 3: 3}, {0: 0, 2: 1, 3: 3})
    assert pages.along([1, 1, 2, 1], [1, 2, 1, 1]) == {0: 0, 2: 1, 3: 2}
    root = [x for k in range(20_000) for x in (1, 10 + k)]
    page = [*root[:-4], root[-1], 1, root[-3], 1]  # the last two of those that come once are swapped
    tracemalloc.start()
    got = pages.along(page, root)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    assert all(page[i] == root[k] for i, k in got.items()) and sorted(got.values()) == [got[i] for i in sorted(got)]
    assert len(got) >= len(root) - 3


def test_memory_of_deep_nesting_is_in_proportion():
    import tracemalloc

    tracemalloc.start()
    assert pages.extract("<div>" * 20_000 + "deep")[0] == "deep"
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_pages_by_the_generator(spark, sf):
    import html

    done = {r.page_id: r.text for r in pages.html_extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    for page in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"(?s)<article>(.*)</article>", page.html)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?p>|</?h1>", inner)]
        assert done[page.page_id] == "\n\n".join(b for b in blocks if b)


def test_pages_on_odd_tables(spark):
    rows = [(1, None, None), (None, "x", ""), (2, "http://h/1", "plain &amp; text"), (2, "http://h/1", "plain &amp; text"), (3, "", "<p>a<p>b</p"), (4, "//h", "<article>open <b>never closed"), (5, "http://h", "<" * 5000), (6, "http://h", "<div>" * 3000 + "deep"), (7, "http://h", "</div></article>x<script>y"), (8, "http://h", "<article class='a><p>one</p><p title=\"t>two</p></article>")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, page int, host string")
    out = collections.defaultdict(list)
    for r in pages.html_extract(df).collect():
        out[r.page_id].append(r.text)
    assert out[1] == out[None] == [""] and out[2] == ["plain & text"] * 2 and out[3] == ["a\n\nb"] and out[4] == ["open never closed"]
    assert out[6] == ["deep"] and out[7] == ["x"] and len(out[5]) == 1 and out[8] == ["one\n\ntwo"]
    assert pages.html_extract(df.limit(0)).count() == 0
