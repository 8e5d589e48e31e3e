"""Operators on texts against brute-force versions, and on odd tables."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import line_dedup as lines
from wakeline.llm.common import hash_words
from wakeline.llm.jaccard_join import RECALL, TREES, jaccard_join, prefix_depth, similar, spare_trees
from wakeline.llm.line_dedup import line_dedup
from wakeline.llm.substring_dedup import substring_dedup


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def kept_lines(rows):
    """Line dedup by its definition."""
    first, places = {}, []
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            n = tuple(line.split())
            if n:
                places.append((i, k, n))
                first.setdefault(n, (i, k))

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) < len(b):
            a, b = b, a
        return len(a) == len(b) + 1 and any(a[:j] + a[j + 1 :] == b for j in range(len(a)))

    long = [n for n in first if len(n) >= lines.MIN_WORDS]
    late = {n for n in long if any(first[m] < first[n] and near(m, n) for m in long)}
    gone = {(i, k) for i, k, n in places if (i, k) > first[n] or n in late}
    return {i: "\n".join(x for k, x in enumerate((t or "").split("\n")) if (i, k) not in gone) for i, t in rows}


def test_line_dedup(spark, words):
    rng = random.Random(1)
    base = [words(rng.randint(1, 9)) for _ in range(40)]
    texts = []
    for _ in range(60):
        part = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(base))
            kind = rng.random()
            if kind < 0.2:
                w[rng.randrange(len(w))] = "new" + str(rng.randint(0, 3))
            elif kind < 0.3:
                w.insert(rng.randint(0, len(w)), "more")
            elif kind < 0.4 and len(w) > 1:
                w.pop(rng.randrange(len(w)))
            part.append("  ".join(w) if kind > 0.9 else " ".join(w))
        texts.append("\n".join(part))
    got = {r.doc_id: r.text for r in line_dedup(table(spark, texts)).collect()}
    assert got == kept_lines(list(enumerate(texts)))


def test_line_dedup_with_repeated_words_and_equal_bags(spark):
    texts = ["a a b a a\na b a a a", "a a a b a a", "b a a a a a", "c d e f g h\nh g f e d c\nc d e f g", "c d e f g h i"]
    got = {r.doc_id: r.text for r in line_dedup(table(spark, texts)).collect()}
    assert got == kept_lines(list(enumerate(texts)))


def test_line_dedup_with_a_very_long_line_and_clashing_columns(spark, words):
    w = words(3000)
    texts = [" ".join(w), " ".join(w[:1999] + w[2000:]), " ".join([*w[:700], "other", *w[701:]]), " ".join(w[::-1])]
    rows = [(i, t, i, "t", "r", i, "n") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __text int, __did string, __gone string, lines_in long, __LINES string")
    got = {r.doc_id: r for r in line_dedup(df).collect()}
    assert {i: r.text for i, r in got.items()} == kept_lines(list(enumerate(texts)))
    assert all(r["__text"] == i and (r["__did"], r["__gone"], r["__LINES"]) == ("t", "r", "n") and r.lines_in == 1 for i, r in got.items())


def test_line_dedup_on_odd_tables(spark, odd, none):
    rows = line_dedup(odd).collect()
    assert len(rows) == odd.count() and rows[0].__fields__[: len(odd.columns)] == odd.columns
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert by_id[1][0].text == "a b c d e f\nline two here is it\n"
    assert sorted((r.text or "-") for r in by_id[None]) == ["", "-"] or sorted(map(str, (r.text for r in by_id[None]))) == ["", "None"]
    assert by_id[6][0].text == "" and len(by_id[5][0].text) > 100_000
    assert [r.text for r in by_id[7]] == ["password=12345678 é漢字😀 \x1f&amp;"] * 2
    assert by_id[9][0].text == "" and by_id[4][0].text == " \t\n " and by_id[3][0].lines_in == 0
    assert line_dedup(none).count() == 0


def jaccard_classes(rows, width=5, threshold=0.8):
    sets = {}
    for i, t in rows:
        w = (t or "").split()
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
    links = {i: {j for j in sets if j != i and sets[i] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])} for i in sets}
    root = {}
    for i in sorted(sets):
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        root[i] = min(seen)
    return {i: (root[i], len(links[i]), len({sets[j] for j in links[i]} - {sets[i]}), root[i] == i) for i in sets}


def near_copies(words, groups, rng):
    texts = []
    for _ in range(groups):
        base = words(rng.randint(3, 120))
        for _ in range(rng.randint(1, 5)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = words(1)[0]
            texts.append(" ".join(w))
    rng.shuffle(texts)
    return texts


def test_jaccard_join(spark, words):
    texts = near_copies(words, 60, random.Random(2)) + ["", "one", "one", "two words"]
    got = {r.doc_id: tuple(r)[1:] for r in jaccard_join(table(spark, texts)).collect()}
    assert got == jaccard_classes(list(enumerate(texts)))


def test_jaccard_join_with_large_clusters_in_blocks(spark, words):
    rng = random.Random(3)
    base = words(100)
    texts = []
    for _ in range(60):
        w = list(base)
        w[rng.randrange(100)] = words(1)[0]
        texts.append(" ".join(w))
    got = {r.doc_id: tuple(r)[1:] for r in jaccard_join(table(spark, texts), block_texts=16).collect()}
    assert got == jaccard_classes(list(enumerate(texts)))


def test_prefixes_shorten_until_the_recall_is_met():
    depth = prefix_depth(0.8)
    assert (1 - 0.8**depth) ** TREES <= 1 - RECALL < (1 - 0.8 ** (depth + 1)) ** TREES
    assert prefix_depth(0.99) == 8 and prefix_depth(0.1) == 1
    n = spare_trees(0.8, depth)
    missed = lambda n: (1 - 0.8**depth) ** (TREES - n) * (1 - 0.8 ** (depth + 1)) ** n
    assert 0 < n < TREES and missed(n) <= 1 - RECALL < missed(n + 1)


def test_recall_over_many_pairs_right_at_the_threshold(spark, words):
    texts = []
    for i in range(400):
        w = [f"{x}{i}" for x in words(84)]
        texts += [" ".join(w[:76]), " ".join(w[:4] + w[4 : 68]), " ".join(w[8:84])]
    want = jaccard_classes(list(enumerate(texts)))
    got = {r.doc_id: tuple(r)[1:] for r in jaccard_join(table(spark, texts)).collect()}
    links = sum(x[1] for x in want.values())
    assert links > 800 and sum(x[1] for x in got.values()) >= 0.999 * links


def test_pairs_right_at_the_threshold():
    m = np.arange(1, 5001)
    for shared, united, want in ((4 * m, 5 * m, True), (4 * m - 1, 5 * m, False), (4 * m, 5 * m + 1, False)):
        hits = [similar(np.array([[s]], np.float32), np.array([u]), np.array([s]), 0.8)[0, 0] for s, u in zip(shared, united)]
        assert set(hits) == {want}


def test_jaccard_join_right_at_the_threshold(spark):
    texts = []
    for m in (1, 2, 3, 5, 6, 7, 8, 13, 26, 54, 100, 333, 1000):
        w = [f"w{m}x{i}" for i in range(5 * m + 4)]
        texts += [" ".join(w), " ".join(w[: 4 * m + 4]), " ".join(w[: 4 * m + 3])]  # 4m of 5m shingles, and one fewer
    got = {r.doc_id: tuple(r)[1:] for r in jaccard_join(table(spark, texts)).collect()}
    assert got == jaccard_classes(list(enumerate(texts)))


def test_jaccard_join_on_odd_tables(odd, none):
    rows = jaccard_join(odd).collect()
    assert len(rows) == odd.count()
    got = {(r.doc_id, r.class_id): r for r in rows}
    assert got[6, 5].n_links == 1 and not got[6, 5].kept and got[5, 5].kept
    assert got[9, 8].n_links == 1 and got[9, 8].n_texts == 0
    assert got[2, 2].n_links == 0 and got[3, 3].kept
    assert jaccard_join(none).count() == 0


def stripped(rows, window=13):
    first, out = {}, {}
    for i, t in sorted(rows):
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


@pytest.mark.parametrize("window", [13, 9])
def test_substring_dedup(spark, words, window):
    rng = random.Random(4)
    passages = [words(rng.randint(8, 60)) for _ in range(12)]
    texts = []
    for _ in range(80):
        w = words(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            w += p[a : len(p) - rng.randint(0, 5)] + words(rng.randint(0, 9))
        texts.append(rng.choice([" ", "\n", "\t "]).join(w))
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup(table(spark, texts), window=window).collect()}
    assert got == stripped(list(enumerate(texts)), window)


def test_any_shift_of_two_texts_shares_an_anchor():
    from wakeline.llm.substring_dedup import COVER, PERIOD

    for i in range(PERIOD):
        for j in range(PERIOD):
            assert any((i + k) % PERIOD in COVER and (j + k) % PERIOD in COVER for k in range(PERIOD))


def thue_morse(n):
    """Two different words that plain polynomial hashes modulo a power of two cannot tell apart."""
    w = "a"
    while len(w) < n:
        w += w.translate(str.maketrans("ab", "ba"))
    return w, w.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_made_to_collide(spark, n):
    a, b = thue_morse(n)
    data = np.frombuffer(f"{a} {b}".encode(), np.uint8)
    for h in (hash_words(data, np.array([0, len(data)]), True)[i] for i in (0, 4)):
        assert h[0] != h[1]
    head = " ".join(f"w{i}" for i in range(12))
    texts = [f"{head} {a}", f"{head} {b}", f"{head} {a}"]
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup(table(spark, texts)).collect()}
    assert got == stripped(list(enumerate(texts)))
    got = {r.doc_id: tuple(r)[1:] for r in jaccard_join(table(spark, [f"w x y z {a}", f"w x y z {b}"])).collect()}
    assert got == {0: (0, 0, 0, True), 1: (1, 0, 0, True)}


def test_windows_of_which_one_hash_is_equal():
    from wakeline.llm import substring_dedup as sub

    w = np.array([[5, 1], [7, 9], [5, 2], [5, 1], [7, 9], [5, 3]], np.uint64)
    order, start = sub._sorted(w)
    assert w[order[start]].tolist() == [[5, 1], [5, 2], [5, 3], [7, 9]] and order.tolist() == [0, 3, 2, 5, 1, 4]
    at, hit = sub._find(w[order[start]], np.array([[5, 3], [5, 4], [7, 9], [8, 0], [5, 1]], np.uint64))
    assert hit.tolist() == [True, False, True, False, True] and at[hit].tolist() == [2, 3, 0]


def test_substring_dedup_on_odd_tables(spark, odd, none):
    rows = substring_dedup(odd).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert got[6].n_removed == got[6].n_words == 60_000 and got[6].kept == "" and got[5].n_removed == 0
    assert got[2].n_words == 0 and got[2].kept == "" and got[4].kept == ""
    assert substring_dedup(none).count() == 0
    same = spark.createDataFrame([(1, " ".join(map(str, range(20))))] * 2 + [(None, " ".join(map(str, range(20))))], "doc_id long, text string")
    assert sorted(r.n_removed for r in substring_dedup(same).collect()) == [0, 0, 20]
    huge = spark.createDataFrame([(1, "x" * 700_000 + " y")], "doc_id long, text string")
    assert substring_dedup(huge).select(F.sha2("kept", 256)).first()[0] == hashlib.sha256(b"x" * 700_000 + b" y").hexdigest()
